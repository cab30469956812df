"""Readers, writers, schema checks and documents on good, bad and missing input."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from panelforge.functions import calendar as C
from panelforge.operators import clean as CL
from panelforge.operators import explain as X
from panelforge.operators import joins as J
from panelforge.operators import rank as R
from panelforge.operators import scale as SC
from panelforge.operators import validate as V
from panelforge.sources import files as IO
from panelforge.streaming import pipeline

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("d", T.DateType()), T.StructField("v", T.DoubleType())])


def folder():
    return tempfile.mkdtemp(prefix="pf-io-")


def put(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)


def test_csv_and_parquet_round_trips(spark):
    df = spark.createDataFrame([(1, None, 0.5), (2, None, None)], SCHEMA).withColumn("d", F.lit("2024-02-29").cast("date"))
    for fmt, read in (("csv", lambda p: IO.read_csv_table(spark, p, SCHEMA)), ("parquet", lambda p: IO.read_typed(spark, p))):
        path = f"{folder()}/t"
        IO.write_table(df, path, fmt)
        got = read(path)
        V.require_same_schema(df, got)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    path = f"{folder()}/p"
    scored = spark.createDataFrame([("m", "train", 1.0), ("m", "test", 2.0), ("n", "train", 3.0)], "model string, split string, prediction double")
    IO.write_table(scored, path, partition_by=["model", "split"])  # predictions, a folder per model and split
    assert sorted(os.listdir(f"{path}/model=m"))[-2:] == ["split=test", "split=train"]
    assert spark.read.parquet(path).where("model = 'm' and split = 'test'").first().prediction == 2.0
    with pytest.raises(IO.SourceError):
        IO.read_csv_table(spark, f"{folder()}/none", SCHEMA)
    IO.write_table(df.limit(0), path, "parquet")
    with pytest.raises(IO.SourceError, match="no rows"):
        IO.read_typed(spark, path)
    assert IO.read_typed(spark, path, require_rows=False).count() == 0


def test_corrupt_rows_are_counted(spark):
    path = folder()
    put(path, "a.csv", "k,d,v\n1,2024-01-01,2.5\nx,2024-01-01,1\n3,not a date,1\n4,2024-01-02,\n")
    good, report = IO.read_permissive(spark, path, SCHEMA)
    assert (report.first().rows, report.first().corrupt_rows) == (4, 2) and sorted(r.k for r in good.collect()) == [1, 4]


def test_json_documents_that_are_no_objects_are_skipped(spark):
    path = folder()
    put(path, "A_metrics.json", json.dumps({"model_name": "A", "train_r2": 0.5}))
    put(path, "B_metrics.json", json.dumps([{"model_name": "B1", "train_r2": 0.1}, {"model_name": "B2"}]))
    put(path, "C_metrics.json", "{broken")
    put(path, "D_metrics.json", " \n {\n  \"train_r2\": 0.25\n }\n")
    put(path, "E_metrics.json", "3")
    put(path, "F_metrics.json", "")
    put(path, "G_other.json", "{}")
    got = IO.read_json_records(spark, path, IO.METRICS_SCHEMA, "_metrics.json", key="model_name")
    assert sorted((r.model_name, r.train_r2) for r in got.collect()) == [("A", 0.5), ("D", 0.25)]
    none = IO.read_json_records(spark, f"{path}/none", IO.METRICS_SCHEMA, "_metrics.json")
    assert none.count() == 0 and none.schema == IO.METRICS_SCHEMA


def test_documents_lie_in_one_folder_and_are_read_many_to_a_task(spark):
    path, n = f"{folder()}/docs", 200
    rows = [(f"m{i}", float(i), i) for i in range(n)]
    IO.write_table(spark.createDataFrame(rows + rows[:7], "model_name string, train_r2 double, part bigint"), path, "json", file_per="part")
    files = [f for f in os.listdir(path) if f.endswith(".json") and os.path.getsize(f"{path}/{f}")]
    assert not any(os.path.isdir(f"{path}/{f}") for f in os.listdir(path)) and len(files) == n  # a file per key, no folder per key
    assert json.load(open(f"{path}/{files[0]}")).keys() == {"model_name", "train_r2"}
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    group, tracker = folder(), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, "read")
    try:
        got = IO.read_json_records(spark, path, IO.METRICS_SCHEMA, ".json", key="model_name")
        assert sorted((r.model_name, r.train_r2) for r in got.collect()) == sorted(r[:2] for r in rows)
        stages = [x for j in tracker.getJobIdsForGroup(group) for x in tracker.getJobInfo(j).stageIds]
        assert stages and max(tracker.getStageInfo(x).numTasks for x in stages) <= 16  # 50 with four files to a task
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.files.maxPartitionBytes", before["spark.sql.files.maxPartitionBytes"])
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before["spark.sql.files.openCostInBytes"]


@pytest.mark.parametrize(("query", "name"), [("metrics_files", "metrics"), ("leaderboard_metadata", "metadata")])
def test_document_queries_make_no_folder_per_supplier(spark, sf, monkeypatch, query, name):
    made, scratch = [], pipeline.scratch
    monkeypatch.setattr(pipeline, "scratch", lambda s, x: made.append(scratch(s, x)) or made[-1])
    rows = E.queries()[query](spark, sf).collect()
    at = made[0].removeprefix("file:")
    assert f"panelforge-{name}-" in at and len(rows) > 5
    assert not any(os.path.isdir(f"{at}/{f}") for f in os.listdir(at)) and len([f for f in os.listdir(at) if f.endswith(".json")]) >= 5


def test_optional_tables_and_leaderboards(spark):
    path = folder()
    assert IO.read_optional(spark, f"{path}/none", SCHEMA).count() == 0
    lb = spark.createDataFrame([(1, "A", 0.9, "Production Ready"), (2, "B", 0.8, "Experimental")], "rank int, model string, engineering_score double, deployment_status string")
    IO.write_leaderboard(R.export_view(lb), path)
    for fmt in ("json", "csv"):
        got = IO.read_leaderboard(spark, f"{path}/{fmt}", fmt)
        assert R.select_production(got.withColumn("rank", F.col("rank").cast("int"))).first().model == "A"
    assert R.select_best(lb).first().model == "A"
    with pytest.raises(ValueError, match="no production-ready"):
        R.select_production(lb.where("rank = 2"))
    IO.write_table(lb.drop("deployment_status"), f"{path}/bad", "json")
    with pytest.raises(IO.SourceError, match="lacks"):
        IO.read_leaderboard(spark, f"{path}/bad")


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, None)], SCHEMA)
    V.require_columns(df, ["k", "v"])
    with pytest.raises(V.SchemaError, match="x"):
        V.require_columns(df, ["k", "x"])
    with pytest.raises(V.SchemaError, match="empty"):
        V.require_rows(df.limit(0))
    V.require_date_type(df, "d")
    with pytest.raises(V.SchemaError, match="not a date"):
        V.require_date_type(df, "v")
    assert V.column_set_diff(df, ["k", "z"]) == (["z"], ["d", "v"])
    with pytest.raises(V.SchemaError):
        V.require_same_schema(df, df.select("d", "k", "v"))
    assert V.residual_nulls(df, ["k", "v"]).first().asDict() == {"k": 0, "v": 1}
    with pytest.raises(ValueError, match="weights"):
        R.engineering_scores(spark.createDataFrame([], "model string, generalization_gap double"), {"validation_r2": 0.5})
    assert CL.drop_columns(df, "v", "absent").columns == ["k", "d"]
    text = spark.createDataFrame([("1.5",), ("NaN",), ("x",), (None,)], "s string")
    assert [r[0] for r in text.select(CL.to_double("s")).collect()] == [1.5, None, None, None]
    dates = spark.createDataFrame([("2024-01-31",), (" 2024-02-01 ",)], "s string")
    assert [str(r[0]) for r in dates.select(C.parse_date_strict("s")).collect()] == ["2024-01-31", "2024-02-01"]
    with pytest.raises(Exception, match="CANNOT_PARSE|CAST_INVALID|DateTime"):
        spark.createDataFrame([("no",)], "s string").select(C.parse_date_strict("s")).collect()


def test_documents_and_lookups(spark):
    imp = spark.createDataFrame([("A", "tree", f"f{i}", 1.0 / i, i, 50.0 / i, 50.0) for i in range(1, 13)], "model string, family string, feature string, importance double, rank int, importance_pct double, cumulative_pct double")
    doc = X.importance_document(imp, "gain").first()
    assert doc.n_features == 12 and [x["rank"] for x in doc.features] == list(range(1, 13)) and doc.method == "gain"
    path = f"{folder()}/doc"
    IO.write_document(X.importance_document(imp, "gain"), path)
    assert spark.read.json(path).first().model == "A"
    lb = spark.createDataFrame([("A", 0.9, 0.8), ("B", 0.7, 0.6)], "model string, validation_r2 double, engineering_score double")
    got = {r.model: r for r in X.dashboard_document(imp, lb).collect()}
    assert got["A"].summary == "model A; top feature f1; share 50.00 %" and got["A"].top10 == [f"f{i}" for i in range(1, 11)]
    assert got["B"].summary is None and got["B"].top_feature is None
    params = {"a": (1.5, 2.0), "b": (None, 1.0)}
    assert SC.params_from_table(SC.scaler_table(spark, params)) == params
    facts = spark.createDataFrame([("x", 1)], "c string, n int")
    full = J.complete_entities(spark.createDataFrame([("x",), ("y",)], "c string"), facts, "c", {"n": 0})
    assert sorted(map(tuple, full.collect())) == [("x", 1), ("y", 0)]
