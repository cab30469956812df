"""Streams and their sinks: late rows, timers, expiry, restart, replayed batches, upserts."""

import datetime as dt
import json
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import windows as W
from panelforge.sources.sinks import BatchSink, KeyedTable
from panelforge.streaming import pipeline as P

D0 = dt.date(2022, 1, 1)
SCHEMA = "entity string, day date, v double"


def land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def take(spark, path, out, ckpt, **options):
    src = spark.readStream.schema(SCHEMA).parquet(path)
    P.run_available_now(P.stateful_features(src, "entity", "day", "v", **options), out, ckpt)


def cells(rows):
    return sorted(tuple("" if x is None or x != x else round(x, 6) if isinstance(x, float) else str(x) for x in r) for r in rows)


def test_no_row_of_two_years_is_lost_or_uncounted(spark):
    """Rows come in any order inside the watermark, some days late: features of the others are those of the batch."""
    path, out, ckpt = (tempfile.mkdtemp(prefix="pf-s-") for _ in range(3))
    rng = np.random.default_rng(2)
    rows = [(e, D0 + dt.timedelta(days=d), None if rng.random() < 0.1 else float(rng.normal())) for e in ("a", "b") for d in range(730) if e == "a" or d % 3]
    late = [("a", D0 + dt.timedelta(days=100), 1.0), ("b", D0 + dt.timedelta(days=200), 2.0), ("b", D0 + dt.timedelta(days=200), 3.0)]
    cuts = [D0 + dt.timedelta(days=x) for x in (250, 500, 731)]
    left = list(rows)
    for i, cut in enumerate(cuts):
        # what lies up to four days ahead comes with the part before
        part = [r for r in left if r[1] < cut and not (i < 2 and r[1] >= cut - dt.timedelta(days=4) and rng.random() < 0.5)]
        left = [r for r in left if r not in part]
        land(spark, path, [part[k] for k in rng.permutation(len(part))] + (late if i == 2 else []))
        take(spark, path, out, ckpt, watermark="5 days")
    land(spark, path, [(None, D0 + dt.timedelta(days=800), None)])
    take(spark, path, out, ckpt, watermark="5 days")
    got = spark.read.parquet(out)
    assert cells(got.where("kind = 'late'").select("entity", "day", "v").collect()) == cells(late)
    feats = W.lag_features({"v": [1, 2, 3, 7]}) + W.rolling_features("v")
    want = W.window_features(spark.createDataFrame(rows, SCHEMA), "entity", ["day"], feats)
    sent = got.where("kind = 'features'").drop("kind")
    assert cells(sent.select(*want.columns).collect()) == cells(want.collect())
    assert got.count() == len(rows) + len(late)


def test_state_of_silent_entities_expires(spark):
    path, out, ckpt = (tempfile.mkdtemp(prefix="pf-s-") for _ in range(3))
    day = lambda k: D0 + dt.timedelta(days=k)
    for rows in ([("a", day(0), 1.0), ("b", day(0), 5.0)], [("b", day(10), 6.0)], [("b", day(60), 7.0)], [("a", day(61), 2.0), ("b", day(100), 8.0)], [("b", day(120), None)]):
        land(spark, path, rows)
        take(spark, path, out, ckpt, watermark="1 day", expire_days=40)
    got = spark.read.parquet(out)
    assert [(r.entity, r.day) for r in got.where("kind = 'expired'").collect() if r.entity == "a"][:1] == [("a", day(0))]
    again = got.where("kind = 'features' and entity = 'a'").orderBy("day").collect()
    assert [(r.v, r.v_lag_1) for r in again] == [(1.0, None), (2.0, None)]  # the history was dropped


def test_readings_are_deduplicated_by_sensor(spark):
    path, out, ckpt = (tempfile.mkdtemp(prefix="pf-s-") for _ in range(3))

    def report(station, when, **values):
        sensors = [{"parameter": {"name": k}, "latest": {"value": v}} for k, v in values.items()]
        return json.dumps({"city": "c", "results": [{"name": station, "datetimeLast": {"local": when}, "sensors": sensors}]})

    docs = [report("s", "2024-01-01T10:00:00", pm25=10.0), report("s", "2024-01-01T10:00:00", pm10=20.0), report("s", "2024-01-01T10:00:00", pm25=10.0),
            report("s", "2024-01-01T11:00:00", pm25=30.0), report("t", "2024-01-01T10:00:00", pm25=50.0)]
    spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.mode("append").text(path)
    sink = BatchSink(spark, out)
    P.run_available_now(P.daily_sensor_aggregates(P.sensor_stream(spark, path)), out, ckpt, "update", sink.foreach_batch())
    got = {r.sensor: (r.readings, r["mean"], r["max"]) for r in P.latest_rows(sink.read(), ["city", "day", "sensor"]).collect()}
    assert got == {"pm25": (3, 30.0, 50.0), "pm10": (1, 20.0, 20.0)}
    P.run_available_now(P.station_stream(spark, path).select("station", "pm25", "pm10"), f"{out}/rows", f"{ckpt}/rows")
    assert spark.read.parquet(f"{out}/rows").count() == 4


def test_a_query_that_stops_half_way_goes_on_exactly_once(spark):
    path, out, ckpt = (tempfile.mkdtemp(prefix="pf-s-") for _ in range(3))
    for k in range(4):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(path)
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)
    calls = []

    def work(batch):
        calls.append(1)
        return batch.withColumn("twice", F.col("id") * 2)

    class Cut(BatchSink):
        def commit(self, batch_id):
            if batch_id == 2:
                raise RuntimeError("cut off")  # the rows are written, the entry isn't
            super().commit(batch_id)

    with pytest.raises(Exception, match="cut off"):
        P.run_available_now(stream(), out, ckpt, "append", Cut(spark, out).foreach_batch(work))
    sink = BatchSink(spark, out)
    assert sink.committed() == [0, 1] and sink.read().count() == 20  # the half-written batch isn't seen
    P.run_available_now(stream(), out, ckpt, "append", sink.foreach_batch(work))
    assert sorted(r.twice for r in sink.read().collect()) == [2 * k for k in range(40)]
    before = len(calls)
    sink.foreach_batch(work)(spark.range(99), 1)  # replayed after its entry
    assert len(calls) == before and sink.read().count() == 40 and sink.write(spark.range(99), 3) is False


def test_upserts_touch_their_buckets_and_are_seen_whole(spark, monkeypatch):
    rng = np.random.default_rng(6)
    t = KeyedTable(spark, tempfile.mkdtemp(prefix="pf-k-"), ["k"], ["ts"], buckets=8)
    assert t.read() is None and t.upsert(spark.createDataFrame([], "k int, ts int, v string")) == []
    best = {}
    for n in (200, 3, 1, 60):
        rows = [(int(rng.integers(0, 80)), int(rng.integers(0, 1000)), f"v{i}") for i in range(n)]
        touched = t.upsert(spark.createDataFrame(rows, "k int, ts int, v string"))
        assert len(touched) <= min(8, n)
        for k, ts, v in rows:
            best[k] = max(best.get(k, (-1, "")), (ts, v))
        assert {r.k: (r.ts, r.v) for r in t.read().collect()} == best and t.read().columns == ["k", "ts", "v"]
    # an upsert that fails before its manifest changes nothing for readers
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("cut off")))
    new = spark.range(1).selectExpr("cast(1 AS int) AS k", "5000 AS ts", "'new' AS v")
    with pytest.raises(RuntimeError, match="cut off"):
        t.upsert(new)
    monkeypatch.undo()
    assert {r.k: (r.ts, r.v) for r in t.read().collect()} == best
    t.upsert(new)
    assert t.read().where("k = 1").first().v == "new"
