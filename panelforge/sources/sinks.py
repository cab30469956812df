"""Sinks that can be written again without harm (SNK-08, SNK-09, SRV-03, STR-04).

* ``BatchSink``: a ``foreachBatch`` sink that takes every micro-batch exactly once. A batch's rows are
  written to a folder of its own, then a ledger entry with the batch id says that it is complete. A
  batch that is replayed after its entry is a no-op; one that was cut off before it is
  overwritten. Readers take the batches of the ledger only.
* ``KeyedTable``: the latest row per key. Rows lie in buckets by a hash of the key; an upsert rewrites the
  buckets that it touches, under a new version, and then writes a manifest that names each
  bucket's version. Readers go by the last complete manifest, so they see the table before
  the upsert or after it, never a part; untouched buckets are neither read nor written.

Folders are listed with Hadoop's file system, so any store that Spark writes to will do.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def complete_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers n of the folders ``<path>/<prefix><n>`` whose write has ended (Spark's success mark is there)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for s in fs.listStatus(root):
        name = s.getPath().getName()
        if name.startswith(prefix) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            found.append(int(name[len(prefix):]))
    return sorted(found)


@dataclass
class BatchSink:
    """Rows of micro-batches under ``path``; one sink per streaming query (batch ids are the query's)."""

    spark: SparkSession
    path: str

    def _data(self, batch_id: int) -> str:
        return f"{self.path}/data/batch={batch_id}"

    def committed(self) -> list[int]:
        return complete_folders(self.spark, f"{self.path}/ledger", "batch=")

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        """Take a batch; False if it was complete already."""
        if batch_id in self.committed():
            return False
        batch.write.mode("overwrite").parquet(self._data(batch_id))
        self.commit(batch_id)
        return True

    def commit(self, batch_id: int) -> None:
        entry = self.spark.range(1).select(F.lit(batch_id).alias("batch_id"), F.current_timestamp().alias("committed"))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/batch={batch_id}")

    def foreach_batch(self, work: Callable[[DataFrame], DataFrame] = lambda x: x) -> Callable[[DataFrame, int], None]:
        """The function for ``foreachBatch``: ``work`` on the batch, then the sink."""
        def fn(batch: DataFrame, batch_id: int) -> None:
            if batch_id not in self.committed():  # a replayed batch isn't even worked out
                self.write(work(batch), batch_id)

        return fn

    def read(self) -> DataFrame:
        """The rows of all complete batches, with their batch id as ``_batch``."""
        done = self.committed()
        if not done:
            raise ValueError(f"{self.path} has no complete batch")
        spark = self.spark
        df = spark.read.option("basePath", f"{self.path}/data").parquet(*[self._data(b) for b in done])
        return df.withColumnRenamed("batch", "_batch")


@dataclass
class KeyedTable:
    """Latest row per ``key`` along ``order`` (greatest wins; ties by the other columns), in ``buckets`` buckets under ``path``."""

    spark: SparkSession
    path: str
    key: list[str]
    order: list[str]
    buckets: int = 64

    def _bucket(self):
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.key]), F.lit(self.buckets)).cast("int")

    def _versions(self) -> dict[int, int]:
        """Version of each bucket by the last complete manifest (at most a row per bucket)."""
        done = complete_folders(self.spark, f"{self.path}/manifests", "version=")
        if not done:
            return {}
        rows = self.spark.read.parquet(f"{self.path}/manifests/version={done[-1]}").collect()
        return {r["bucket"]: r["at"] for r in rows}

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The table (or some of its buckets); None if nothing was written there."""
        found = {b: v for b, v in self._versions().items() if buckets is None or b in buckets}
        if not found:
            return None
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(found.items())]
        return self.spark.read.parquet(*paths)

    def _latest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.key]
        order = F.struct(*[F.col(f"`{c}`") for c in [*self.order, *[c for c in rest if c not in self.order]]])
        last = rows.groupBy(*[F.col(f"`{k}`") for k in self.key]).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias("_l"))
        return last.select(*[F.col(f"`{k}`") for k in self.key], "_l.*").select(*[F.col(f"`{c}`") for c in rows.columns])

    def upsert(self, rows: DataFrame) -> list[int]:
        """Merge ``rows``; returns the buckets that were touched (none for no rows)."""
        versions = self._versions()
        new = self._latest(rows).withColumn("bucket", self._bucket()).persist()
        try:
            touched = sorted(r[0] for r in new.select("bucket").distinct().collect())  # at most ``buckets`` rows
            if not touched:
                return []
            version = max(complete_folders(self.spark, f"{self.path}/manifests", "version="), default=0) + 1
            before = self.read(touched)
            merged = new.drop("bucket")
            if before is not None:
                merged = self._latest(before.unionByName(merged))
            merged.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={version}")
            manifest = sorted((versions | dict.fromkeys(touched, version)).items())
            self.spark.createDataFrame(manifest, "bucket int, at int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifests/version={version}")
            return touched
        finally:
            new.unpersist()
