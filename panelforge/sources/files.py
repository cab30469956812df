"""File sources and sinks (SRC-01..08, SNK-01..10).

Every reader takes an explicit schema (no inference); malformed input is
counted or skipped, never silently coerced. Writers overwrite or append whole
datasets with Spark's writers -- nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..session import materialize

CORRUPT = "_corrupt_record"
#: Bytes that opening a file counts for when documents are scanned: a task reads hundreds of small ones, not a few.
OPEN_BYTES = 1 << 16

METRICS_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("uses_scaled", T.BooleanType()),
    T.StructField("train_time_s", T.DoubleType()),
    *[T.StructField(f"{s}_{m}", T.DoubleType())
      for s in ("train", "validation", "test") for m in ("r2", "mae", "rmse", "mape", "pred_time")],
    T.StructField("timestamp", T.StringType()),
])

METADATA_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("n_features", T.IntegerType()),
    T.StructField("training_rows", T.IntegerType()),
    T.StructField("hyperparameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("train_time_s", T.DoubleType()),
    T.StructField("prediction_time_s", T.DoubleType()),
    T.StructField("random_state", T.IntegerType()),
    T.StructField("uses_scaled_data", T.BooleanType()),
])


class SourceError(ValueError):
    pass


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, require_rows: bool = True) -> DataFrame:
    """SRC-01: header CSV with an explicit schema; fails when the path is missing or empty."""
    try:
        df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    except Exception as e:  # path does not exist
        raise SourceError(f"cannot read {path}: {str(e).splitlines()[0]}") from e
    if require_rows and df.isEmpty():
        raise SourceError(f"{path} has no rows")
    return df


def read_typed(spark: SparkSession, path: str, require_rows: bool = True) -> DataFrame:
    """SRC-02: a stage output in Parquet (types travel with the data)."""
    df = spark.read.parquet(path)
    if require_rows and df.isEmpty():
        raise SourceError(f"{path} has no rows")
    return df


def read_permissive(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> tuple[DataFrame, DataFrame]:
    """SRC-03: fault-tolerant scan: (good rows, one-row report of corrupt rows)."""
    reader = spark.read.schema(_with_corrupt(schema)).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT)
    if fmt == "csv":
        reader = reader.option("header", True)
    # Spark parses the corrupt-record column only together with the data columns: keep the
    # parsed rows (spilling to disk when large) so the report can count it on its own
    df = reader.format(fmt).load(path).persist(StorageLevel.MEMORY_AND_DISK)
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    report = df.agg(F.count(F.lit(1)).alias("rows"), F.count(CORRUPT).alias("corrupt_rows"))
    return good, report


def read_json_records(spark: SparkSession, directory: str, schema: T.StructType, suffix: str,
                      key: str | None = None) -> DataFrame:
    """SRC-04/05: one JSON object per file matching ``*<suffix>``; files that are malformed or hold
    anything else (an array, a number) are skipped, a missing directory is an empty table. With
    ``key`` a missing key defaults to the file stem. The files are read once, many to a task, and kept as a table."""
    try:
        raw = spark.read.option("pathGlobFilter", f"*{suffix}").text(directory, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    partitions = [c for c in raw.columns if c != "value"]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    doc = F.from_json("value", _with_corrupt(schema), options)
    own = F.ltrim(F.translate("value", "\t\r\n", "   ")).startswith("{")
    df = raw.select(F.when(own, doc).alias("_doc"), *partitions, F.col("_metadata.file_name").alias("_file"))
    df = df.where(F.col("_doc").isNotNull() & F.col(f"_doc.{CORRUPT}").isNull()).select("_doc.*", *partitions, "_file").drop(CORRUPT)
    if key:
        stem = F.regexp_replace(F.col("_file"), r"(_metrics|_metadata)?\.json$", "")
        df = df.withColumn(key, F.coalesce(F.col(key), stem))
    # files are dealt to tasks when the scan runs, so it runs here
    cost = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(cost)
    spark.conf.set(cost, str(OPEN_BYTES))
    try:
        return materialize(df.drop("_file"))
    finally:
        spark.conf.set(cost, before)


def read_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """SRC-06: the table, or an empty table of the schema when it is absent/unreadable."""
    try:
        return spark.read.schema(schema).format(fmt).option("header", True).load(path)
    except Exception:
        return spark.createDataFrame([], schema)


def read_leaderboard(spark: SparkSession, path: str, fmt: str = "json",
                     required=("model", "deployment_status")) -> DataFrame:
    """SRC-07: a leaderboard written as JSON records or CSV; required columns and rows."""
    df = spark.read.option("header", True).option("inferSchema", False).format(fmt).load(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SourceError(f"leaderboard lacks {missing}")
    if df.isEmpty():
        raise SourceError("leaderboard is empty")
    return df


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------

def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, file_per: str | None = None) -> None:
    """SNK-01/02: overwrite a dataset (optionally partitioned, e.g. by model and split).

    ``file_per`` (SNK-03) names a key: each key gets a file of its own with one row (rows that share a key overwrite
    each other), without the key. All files lie in one folder, which one call lists, and tasks move
    them into place (commit algorithm 2): the driver does nothing file by file."""
    if file_per:
        tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
        df = df.dropDuplicates([file_per]).drop(file_per).repartition(tasks)
    w = df.write.mode("overwrite").format(fmt)
    if file_per:
        w = w.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_records(df: DataFrame, path: str) -> None:
    """SNK-03: append metric / metadata records as JSON lines (map values are strings)."""
    df.write.mode("append").json(path)


def write_leaderboard(lb: DataFrame, path: str) -> None:
    """SNK-04: the exported leaderboard as CSV and JSON."""
    write_table(lb, f"{path}/csv", "csv")
    write_table(lb, f"{path}/json", "json")


def write_document(doc: DataFrame, path: str) -> None:
    """SNK-05/06/07: nested documents (one JSON object per row)."""
    doc.write.mode("overwrite").json(path)
