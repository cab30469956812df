"""Streaming and model queries cover every row, sensor, year and model."""

import datetime

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from panelforge.operators import models as MD
from panelforge.plans import q_models as M
from panelforge.sources.tables import li_panel
from test_catalog_stream import test_stream_features_equal_batch as features_equal_batch


def test_stream_daily_counts_every_sensor(spark, sf):
    got = {(r.city, r.day, r.sensor): r for r in E.queries()["stream_daily"](spark, sf).collect()}
    rows = duckdb.sql(f"""
        SELECT 'E' || user_id % 26, CAST(ts AS DATE), CASE event_type WHEN 'click' THEN 'pm25' WHEN 'view' THEN 'pm10' WHEN 'purchase' THEN 'no2' WHEN 'error' THEN 'co' ELSE 'o3' END,
               count(value), avg(value), max(value)
        FROM '{sf}/events.parquet' WHERE value IS NOT NULL AND (event_type <> 'click' OR value <> 0) GROUP BY ALL""").fetchall()
    assert {r[:3] for r in rows} == set(got)
    for *key, n, mean, top in rows:
        r = got[tuple(key)]
        assert r.readings == n and abs(r["mean"] - mean) < 0.06 and abs(r["max"] - top) < 0.06


def test_stream_features_of_two_years(spark, tmp_path):
    names = ("click", "view", "purchase", "error", "signup")
    start = datetime.datetime(2023, 12, 18)
    rows = [(start + datetime.timedelta(days=d, hours=u, minutes=k), u, names[k], float(d + u + k))
            for d in (*range(40), *range(366, 400)) for u in range(3) for k in range(5)]
    spark.createDataFrame(rows, "ts timestamp, user_id bigint, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    features_equal_batch(spark, str(tmp_path))


def test_requests_of_the_whole_panel(spark, sf):
    asked = M.li_requests(spark, sf).select("entity", "date").collect()
    panel = li_panel(spark, sf).select("entity", F.col("day").cast("string").alias("date")).collect()
    assert sorted(asked) == sorted(panel)


def test_importances_of_every_model(spark, sf, monkeypatch):
    small = {m.name: m for m in MD.default_registry()}
    small["RandomForest"].factory = MD._forest(2, 3)
    small["GradientBoosting"].factory = MD._gbt(2, 2)
    monkeypatch.setattr(M, "_registry", lambda: small)
    got = E.queries()["importances"](spark, sf).groupBy("model").count().collect()
    assert {r.model for r in got} == set(small) and len({r["count"] for r in got}) == 1
