"""Spark session helpers.

The package never creates a machine-local scratch folder on its own: the
checkpoint folder comes from ``spark.checkpoint.dir`` of the session (a
shared folder on a cluster). Only when that setting is absent -- as in unit
tests on one machine -- may a caller pass a fallback.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "panelforge", extra: dict | None = None, driver_memory: str = "16g") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            conf["spark.driver.memory"] = driver_memory  # local mode: the driver JVM runs the tasks
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Return the shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir`` (or the folder already set on the
    SparkContext). ``fallback`` is applied only when neither is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    target = conf_dir or fallback
    if target:
        sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, fallback: str | None = None) -> DataFrame:
    """Materialise ``df`` as a reliable checkpoint in the shared folder.

    Reliable checkpoints survive executor loss (unlike local checkpoints).
    Raises when the session has no checkpoint folder and no fallback.
    """
    if checkpoint_dir(df.sparkSession, fallback) is None:
        raise RuntimeError("spark.checkpoint.dir is not set; cannot checkpoint")
    return df.checkpoint(eager=True)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table under the session's shared
    ``spark.checkpoint.dir`` and read it back (survives executor loss; also avoids
    ``Dataset.checkpoint``'s constraint rewrite, which is exponential for wide aliased
    projections). Without a checkpoint folder (single-machine use) persist and count."""
    base = checkpoint_dir(df.sparkSession)
    if base:
        path = f"{base.rstrip('/')}/panelforge-{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


def fix_partitions(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the session's shared folder: partitions, and the order of rows in them, stay as they are.

    A folder of its own is made only on a one-machine master without the setting
    (tests); on a cluster a missing ``spark.checkpoint.dir`` is an error. Constraint
    propagation, exponential in wide aliased projections, is off meanwhile.
    """
    spark = df.sparkSession
    if checkpoint_dir(spark) is None and spark.sparkContext.master.startswith("local["):
        checkpoint_dir(spark, tempfile.mkdtemp(prefix="panelforge-ckpt-"))
    key = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return cut_lineage(df)
    finally:
        spark.conf.set(key, before)
