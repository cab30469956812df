"""Stand-in inputs built from the driver's tables.

These only shape table rows into the schemas the jobs expect (a landed
station payload, a serving request); they do none of the jobs' work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows as W
from .tables import ev_panel, table


def station_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed JSON document per supplier: the city is the supplier's nation, the
    station is the supplier, sensor readings are scaled account balances."""
    s = table(spark, sf_dir, "supplier").select("s_name", "s_nationkey", "s_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    bal = F.abs(F.col("s_acctbal"))

    def sensor(name, value):
        return F.struct(F.struct(F.lit(name).alias("name")).alias("parameter"),
                        F.struct(value.cast("double").alias("value")).alias("latest"))

    station = F.struct(
        F.col("s_name").alias("name"),
        F.struct(F.col("n_name").alias("name")).alias("country"),
        F.struct(F.col("s_nationkey").cast("double").alias("latitude"),
                 (-F.col("s_nationkey")).cast("double").alias("longitude")).alias("coordinates"),
        F.struct(F.lit("2024-01-01T00:00:00").alias("local")).alias("datetimeLast"),
        F.array(
            sensor("PM2.5", bal / 19),
            sensor("PM10", bal / 7),
            sensor("NO2", F.when(F.col("s_acctbal") >= 0, bal / 31)),
            sensor("CO", F.col("s_acctbal") / 1001),
        ).alias("sensors"),
    )
    return j.select(F.to_json(F.struct(F.col("n_name").alias("city"), F.array(station).alias("results"))).alias("value"))


def expected_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities a station run must report: every nation and every region name."""
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("city"))
    r = table(spark, sf_dir, "region").select(F.col("r_name").alias("city"))
    return n.unionByName(r).distinct()


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving requests from the EV panel: today's measured channels as a map (NULL
    channels are simply absent), the previous 7 target values oldest first, and the
    previous channel scalars."""
    p = ev_panel(spark, sf_dir)
    feats = [W.Feature(f"_h{k}", "lag", "aqi", k) for k in range(1, 8)] + [
        W.Feature("pm25_yesterday", "lag", "pm25", 1),
        W.Feature("pm25_3days_ago", "lag", "pm25", 3),
        W.Feature("pm10_yesterday", "lag", "pm10", 1),
        W.Feature("co_yesterday", "lag", "co", 1),
    ]
    p = W.add_window_features(p, "entity", ["day"], feats)
    entries = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in ("pm25", "pm10", "no2", "co")])
    present = F.filter(entries, lambda e: e["value"].isNotNull())
    return p.select(
        "entity",
        "day",
        F.concat(F.lit("E"), F.col("entity").cast("string")).alias("city"),
        F.col("day").cast("string").alias("date"),
        F.map_from_entries(present).alias("pollutants"),
        F.array(*[F.col(f"_h{k}") for k in range(7, 0, -1)]).alias("aqi_history"),
        "pm25_yesterday", "pm25_3days_ago", "pm10_yesterday", "co_yesterday",
        F.col("aqi").alias("actual"),
    )


def supplier_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-supplier metric records in the shape of model metric records: R2-like values are
    squared quantity/price correlations over three shipping periods, errors and times are
    scaled line statistics. One aggregation over lineitem, joined to supplier names."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    d = F.col("l_shipdate").cast("date")
    q, p = F.col("l_quantity"), F.col("l_extendedprice")

    def r2(cond):
        return F.pow(F.corr(F.when(cond, q), F.when(cond, p)), 2)

    g = li.groupBy("l_suppkey").agg(
        r2(d <= F.lit("1998-12-31").cast("date")).alias("train_r2"),
        r2((d > F.lit("1998-12-31").cast("date")) & (d <= F.lit("1999-12-31").cast("date"))).alias("validation_r2"),
        r2(d > F.lit("1999-12-31").cast("date")).alias("test_r2"),
        (F.avg("l_discount") * 100).alias("validation_mae"),
        (F.stddev_pop("l_extendedprice") / 1000).alias("validation_rmse"),
        (F.avg("l_tax") * 100).alias("validation_mape"),
        (F.count(F.lit(1)) / 2.0).alias("train_time_s"),
        (F.avg("l_discount") * 20).alias("validation_pred_time"),
        F.sum(p * (1 - F.col("l_discount"))).alias("revenue"),
        F.avg("l_quantity").alias("avg_qty"),
    )
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return g.join(s, g.l_suppkey == s.s_suppkey).select(
        F.col("s_name").alias("model"), "s_suppkey", "s_nationkey", F.lit(False).alias("uses_scaled"),
        "train_r2", "validation_r2", "test_r2", "validation_mae", "validation_rmse", "validation_mape",
        "train_time_s", "validation_pred_time", "revenue", "avg_qty",
    )


SUPPLIER_RECORDS_SQL = """
SELECT s_name AS model, s_suppkey, s_nationkey,
  power(corr(CASE WHEN CAST(l_shipdate AS DATE) <= DATE '1998-12-31' THEN l_quantity END,
             CASE WHEN CAST(l_shipdate AS DATE) <= DATE '1998-12-31' THEN l_extendedprice END), 2) AS train_r2,
  power(corr(CASE WHEN CAST(l_shipdate AS DATE) > DATE '1998-12-31' AND CAST(l_shipdate AS DATE) <= DATE '1999-12-31' THEN l_quantity END,
             CASE WHEN CAST(l_shipdate AS DATE) > DATE '1998-12-31' AND CAST(l_shipdate AS DATE) <= DATE '1999-12-31' THEN l_extendedprice END), 2) AS validation_r2,
  power(corr(CASE WHEN CAST(l_shipdate AS DATE) > DATE '1999-12-31' THEN l_quantity END,
             CASE WHEN CAST(l_shipdate AS DATE) > DATE '1999-12-31' THEN l_extendedprice END), 2) AS test_r2,
  avg(l_discount) * 100 AS mae, stddev_pop(l_extendedprice) / 1000 AS rmse, avg(l_tax) * 100 AS mape,
  count(*) / 2.0 AS train_time_s, avg(l_discount) * 20 AS val_pred_time_s,
  sum(l_extendedprice * (1 - l_discount)) AS revenue, avg(l_quantity) AS avg_qty
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
GROUP BY s_name, s_suppkey, s_nationkey
"""
