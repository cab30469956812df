"""Helpers shared by the training-data operators.

Row-wise operators run as ``mapInArrow`` over the input partitions: they need
no shuffle, their memory is one Arrow batch of bounded bytes plus a bounded cache, and a lost
executor only costs the tasks it was running. Text columns are handed over as
UTF-8 bytes, so no Python string is built unless an operator needs one.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.session import checkpoint_dir, cut_lineage

#: Rows and bytes of a batch that are worked on at a time (one row at least); bounds the Python objects alive.
ROWS, SLICE_BYTES = 512, 2 << 20
#: Bytes of an Arrow batch between Spark and Python, in both processes of every running task.
BATCH_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    One is made only on a one-machine master (tests); on a cluster a missing
    setting is an error.
    """
    if checkpoint_dir(spark) is None and spark.sparkContext.master.startswith("local["):
        checkpoint_dir(spark, tempfile.mkdtemp(prefix="panelforge-ckpt-"))
    folder = checkpoint_dir(spark)
    if folder is None:
        raise RuntimeError("spark.checkpoint.dir is not set")
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: lineage ends there and survives lost executors."""
    shared_folder(df.sparkSession)
    return cut_lineage(df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bound of an Arrow batch to ``BATCH_BYTES`` (its default holds 64 MB of whole texts)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) != BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``ROWS`` rows and ``SLICE_BYTES`` bytes of texts (or one row)."""
    n = batch.num_rows
    size = np.zeros(n, dtype=np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type) or pa.types.is_large_binary(c.type):
            size += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    at = 0
    while at < n:
        before = int(ends[at - 1]) if at else 0
        to = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
        to = max(at + 1, min(n, at + ROWS, to))
        yield batch.slice(at, to - at)
        at = to


def as_bytes(column) -> list:
    """Values of an Arrow string column as UTF-8 bytes (None stays None)."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def map_rows(df: DataFrame, schema: T.StructType | str, work: Callable[[], Callable[[list[list]], Iterable[tuple]]]) -> DataFrame:
    """``mapInArrow`` with a function over lists of columns.

    ``work()`` is called once per task (automata, tokenizers, caches) and
    returns ``f(columns) -> rows``; string columns arrive as bytes. Batches
    are handed over in slices of bounded rows and bytes.
    """
    small_batches(df.sparkSession)
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = None
        for batch in batches:
            for part in slices(batch):
                columns = [as_bytes(c) if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) else c.to_pylist() for c in part.columns]
                f = f or work()
                rows = list(f(columns))
                if rows:
                    cols = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(cols, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, out)


def append_columns(df: DataFrame, inputs: list[str], added: str, work: Callable[[], Callable[..., Iterable[tuple]]], drop: tuple = ()) -> DataFrame:
    """``df`` with the columns of the DDL ``added``; columns of ``df`` of the same name are replaced.

    ``work()`` is called once per task and returns ``f(*inputs) -> one tuple
    per row``. Other columns pass as Arrow arrays, never as Python objects;
    those in ``drop`` do not come back.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(df.sparkSession)
    new = T.StructType.fromDDL(added)
    lower = {f.name.lower() for f in new.fields} | {d.lower() for d in drop}
    kept = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in lower]
    at = [df.columns.index(c) for c in inputs]
    out = T.StructType([*(df.schema.fields[i] for i in kept), *new.fields])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = None
        for batch in batches:
            for part in slices(batch):
                f = f or work()
                cols = [as_bytes(part.column(i)) if pa.types.is_string(part.column(i).type) or pa.types.is_large_string(part.column(i).type) else part.column(i).to_pylist() for i in at]
                made = zip(*f(*cols), strict=True)
                arrays = [part.column(i) for i in kept] + [pa.array(c, type=t.type) for c, t in zip(made, list(arrow)[len(kept) :], strict=True)]
                yield pa.RecordBatch.from_arrays([a.cast(t.type) if a.type != t.type else a for a, t in zip(arrays, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, out)


def running_total(df: DataFrame, order: list, amount: str, out: str) -> DataFrame:
    """Exclusive running total of ``amount`` (long, not null) along ``order``, without a one-task window.

    Rows are range-partitioned and sorted by ``order`` (which should be unique
    per row, so that no range is hot) and checkpointed: that fixes their
    partitions and their order. One aggregate gives the total of each
    partition, a few rows; each partition then adds the totals before it.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fixed = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    totals = fixed.groupBy(F.spark_partition_id().alias("_p")).agg(F.sum(amount).alias("_s")).collect()
    base, at = {}, 0
    for r in sorted(totals, key=lambda r: r["_p"]):
        base[r["_p"]], at = at, at + r["_s"]
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([*fixed.schema.fields, T.StructField(out, T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = base.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            x = b.column(fixed_at).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(x) + at
            yield pa.RecordBatch.from_arrays([*(c.cast(t.type) for c, t in zip(b.columns, arrow, strict=False)), pa.array(ends - x)], schema=arrow)
            at = int(ends[-1]) if len(ends) else at

    fixed_at = fixed.columns.index(amount)
    return fixed.mapInArrow(run, schema)


def crc_mod(column, n: int):
    """crc32 of an id as text, modulo n: the folds of the labelled operators (null ids: fold null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def bounded(df: DataFrame, key: str, limit: int, count: int) -> DataFrame:
    """About ``limit`` rows of ``df`` (all of them up to that), the same ones on every run: a hash range of ``key``."""
    if count <= limit:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 20)) < F.lit(int((1 << 20) * limit / count)))
