"""Readers for the driver's parquet tables and the panels derived from them.

Panels are built with one aggregation each. The LI panel pre-aggregates
``lineitem`` per order (partial sums and counts per return flag) before it
meets ``orders``, so the widest table is combined map-side and shuffled once
on the join key; the customer side is a plain equi-join that AQE may turn
into a broadcast at run time when it is small.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def ev_panel(spark: SparkSession, sf_dir: str, n_entities: int = 26) -> DataFrame:
    """Daily panel from ``events``: entity x day -> pm25, pm10, no2, co, aqi.

    Each channel is the mean event value of one event type on that day.
    """
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    channel_of = {"click": "pm25", "view": "pm10", "purchase": "no2", "error": "co", "signup": "aqi"}
    aggs = [
        F.avg(F.when(F.col("event_type") == lit_type, F.col("value"))).alias(name)
        for lit_type, name in channel_of.items()
    ]
    return (
        ev.where(F.col("event_type").isin(list(channel_of)))
        .groupBy(
            (F.col("user_id") % n_entities).cast("int").alias("entity"),
            F.col("ts").cast("date").alias("day"),
        )
        .agg(*aggs)
    )


EV_PANEL_SQL = """
SELECT CAST(user_id % 26 AS INTEGER) AS entity, CAST(ts AS DATE) AS day,
       avg(CASE WHEN event_type = 'click' THEN value END) AS pm25,
       avg(CASE WHEN event_type = 'view' THEN value END) AS pm10,
       avg(CASE WHEN event_type = 'purchase' THEN value END) AS no2,
       avg(CASE WHEN event_type = 'error' THEN value END) AS co,
       avg(CASE WHEN event_type = 'signup' THEN value END) AS aqi
FROM events
WHERE event_type IN ('click', 'view', 'purchase', 'error', 'signup')
GROUP BY 1, 2
"""


def li_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily panel from ``lineitem x orders x customer``.

    entity = customer nation, day = order date; a/n/r = mean extended price of
    items with return flag A/N/R, q = mean quantity of all items.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice", "l_quantity")
    per_order = li.groupBy("l_orderkey").agg(
        *[
            x
            for flag in "ANR"
            for x in (
                F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_extendedprice"))).alias(f"s_{flag}"),
                F.count(F.when(F.col("l_returnflag") == flag, F.col("l_extendedprice"))).alias(f"c_{flag}"),
            )
        ],
        F.sum("l_quantity").alias("s_q"),
        F.count("l_quantity").alias("c_q"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = per_order.join(orders, per_order.l_orderkey == orders.o_orderkey).join(
        cust, orders.o_custkey == cust.c_custkey
    )
    return joined.groupBy(
        F.col("c_nationkey").cast("int").alias("entity"),
        F.col("o_orderdate").cast("date").alias("day"),
    ).agg(
        *[F.try_divide(F.sum(f"s_{f}"), F.sum(f"c_{f}")).alias(f.lower()) for f in "ANR"],
        F.try_divide(F.sum("s_q"), F.sum("c_q")).alias("q"),
    )


LI_PANEL_SQL = """
SELECT CAST(c_nationkey AS INTEGER) AS entity, CAST(o_orderdate AS DATE) AS day,
       avg(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS a,
       avg(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END) AS n,
       avg(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS r,
       avg(l_quantity) AS q
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2
"""
