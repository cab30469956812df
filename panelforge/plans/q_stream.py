"""Catalogue: streaming queries (STR-01..03), run with an availableNow trigger over files
landed under the session's checkpoint folder; results are read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import materialize
from ..sources.sinks import BatchSink, KeyedTable
from ..sources.tables import ev_panel, table
from ..streaming import pipeline as P
from .q_windows import EV
from .registry import query, round_doubles

_SENSOR_OF = {"click": "pm25", "view": "pm10", "purchase": "no2", "error": "co", "signup": "o3"}


def event_payloads(spark, sf):
    """Stand-in landed documents: each event is one station report (city = user bucket,
    station = user, one sensor named after the event type)."""
    ev = table(spark, sf, "events").select("ts", "user_id", "event_type", "value")
    name = F.create_map(*[x for k, v in _SENSOR_OF.items() for x in (F.lit(k), F.lit(v))])[F.col("event_type")]
    station = F.struct(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("name"),
        F.struct(F.lit("X").alias("name")).alias("country"),
        F.struct(F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude")
                 ).alias("coordinates"),
        F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("local")).alias("datetimeLast"),
        F.array(F.struct(F.struct(name.alias("name")).alias("parameter"),
                         F.struct(F.col("value").alias("value")).alias("latest"))).alias("sensors"),
    )
    city = F.concat(F.lit("E"), (F.col("user_id") % 26).cast("string"))
    return ev.select(F.to_json(F.struct(city.alias("city"), F.array(station).alias("results"))).alias("value"))


_DAILY_SQL = """
WITH e AS (SELECT 'E' || (user_id % 26) AS city, user_id, ts, event_type, round(any_value(value), 2) AS v
  FROM events GROUP BY user_id, ts, event_type),
r AS (SELECT city, CAST(ts AS DATE) AS day,
  CASE event_type WHEN 'click' THEN 'pm25' WHEN 'view' THEN 'pm10' WHEN 'purchase' THEN 'no2' WHEN 'error' THEN 'co' WHEN 'signup' THEN 'o3' END AS sensor,
  CASE WHEN event_type = 'click' AND v = 0 THEN NULL ELSE v END AS v FROM e)
SELECT city, day, sensor, count(v) AS readings, round(avg(v), 6) AS mean, round(max(v), 6) AS max
FROM r WHERE sensor IS NOT NULL AND v IS NOT NULL GROUP BY ALL
"""


@query("stream_daily", _DAILY_SQL)
def stream_daily(spark, sf):
    """STR-01/02: landed station reports -> readings, one per (station, time, sensor) -> daily aggregates per city and
    sensor (update mode through the exactly-once sink; the latest emitted row per (city, day, sensor) is the result)."""
    land, out, ckpt = P.scratch(spark, "land"), P.scratch(spark, "daily"), P.scratch(spark, "ckpt")
    event_payloads(spark, sf).write.mode("overwrite").text(land)
    agg = P.daily_sensor_aggregates(P.sensor_stream(spark, land), "city", 6)  # means of few readings lie on ties at one digit
    sink = BatchSink(spark, out)
    P.run_available_now(agg, out, ckpt, "update", sink.foreach_batch())
    return P.latest_rows(sink.read(), ["city", "day", "sensor"])


_FEATURES_SQL = EV + """
SELECT entity, day, round(aqi, 6) AS aqi, round(lag(aqi, 1) OVER w, 6) AS aqi_lag_1, round(lag(aqi, 2) OVER w, 6) AS aqi_lag_2,
  round(lag(aqi, 3) OVER w, 6) AS aqi_lag_3, round(lag(aqi, 7) OVER w, 6) AS aqi_lag_7,
  round(avg(aqi) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS aqi_roll_mean_3,
  round(avg(aqi) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS aqi_roll_mean_7,
  round(stddev_samp(aqi) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS aqi_roll_std_7,
  round(max(aqi) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS aqi_roll_max_7,
  round(min(aqi) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS aqi_roll_min_7
FROM p WINDOW w AS (PARTITION BY entity ORDER BY day)
"""


@query("stream_features", _FEATURES_SQL)
def stream_features(spark, sf):
    """STR-03: per-entity lag / rolling features from a file stream of daily panel rows: the older half lands and is
    taken, then the newer half and a closing row that moves the watermark past the last day; the stream goes on from its checkpoint."""
    land, out, ckpt = P.scratch(spark, "panel"), P.scratch(spark, "feat"), P.scratch(spark, "ckpt")
    panel = materialize(ev_panel(spark, sf).select("entity", "day", "aqi"))
    first, last = panel.agg(F.min("day"), F.max("day")).first()
    half = first + (last - first) / 2
    closing = spark.range(1).select(F.lit(None).cast(panel.schema["entity"].dataType).alias("entity"), F.date_add(F.lit(last), 30).alias("day"), F.lit(None).cast("double").alias("aqi"))
    for part in (panel.where(F.col("day") <= F.lit(half)), panel.where(F.col("day") > F.lit(half)).unionByName(closing)):
        part.write.mode("append").parquet(land)
        src = spark.readStream.schema(panel.schema).parquet(land)
        P.run_available_now(P.stateful_features(src, "entity", "day", "aqi"), out, ckpt, "append")
    return round_doubles(spark.read.parquet(out).where("kind = 'features'").drop("kind"))


_LATEST_SQL = """
SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, CAST(max(o_orderdate) AS DATE) AS o_orderdate,
  round(max_by(o_totalprice, (o_orderdate, o_orderkey)), 6) AS o_totalprice
FROM orders GROUP BY o_custkey
"""


@query("latest_upsert", _LATEST_SQL)
def latest_upsert(spark, sf):
    """SNK-09 / SRV-03: the latest order of each customer, kept by upserts: all orders but the last years', then those."""
    table_ = KeyedTable(spark, P.scratch(spark, "latest"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice")
    new = F.year("o_orderdate") >= 1998
    table_.upsert(o.where(~new))
    table_.upsert(o.where(new))
    return round_doubles(table_.read())
