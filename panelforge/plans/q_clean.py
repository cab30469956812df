"""Catalogue: cleaning, calendar, index, dedup and split queries (M1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import index as IDX
from ..operators import clean as CL
from ..operators import split as SP
from ..operators.joins import join_small
from ..sources.tables import ev_panel, li_panel, table
from ..spec import LI_CUTOFFS
from .q_windows import EV, LI
from .registry import query, round_doubles

_CAL_SQL = LI + """
SELECT entity, day, CAST(year(day) AS INTEGER) AS Year, CAST(month(day) AS INTEGER) AS Month,
  CAST(day(day) AS INTEGER) AS DayOfMonth, CAST(isodow(day) - 1 AS INTEGER) AS DayOfWeek,
  CAST(isodow(day) >= 6 AS INTEGER) AS IsWeekend
FROM p
"""


@query("calendar", _CAL_SQL)
def calendar(spark, sf):
    p = li_panel(spark, sf).select("entity", "day")
    return p.select("entity", "day", *C.calendar_columns("day"))


_SEASON_SQL = LI + """
SELECT entity, day, CAST(month(day) AS INTEGER) AS Month,
  CASE WHEN month(day) IN (12, 1, 2) THEN 'Winter' WHEN month(day) IN (3, 4, 5) THEN 'Summer'
       WHEN month(day) IN (6, 7, 8, 9) THEN 'Monsoon' ELSE 'Post-Monsoon' END AS Season
FROM p
"""


@query("season_lookup", _SEASON_SQL)
def season_lookup(spark, sf):
    p = li_panel(spark, sf).select("entity", "day")
    return p.select("entity", "day", F.month("day").alias("Month"), C.season_expr(F.month("day")).alias("Season"))


_PERIOD_SQL = LI + """
SELECT entity, day, CAST(coalesce(day BETWEEN DATE '1998-03-01' AND DATE '1998-07-31', false) AS INTEGER) AS in_period
FROM p
"""


@query("period_flag", _PERIOD_SQL)
def period_flag(spark, sf):
    p = li_panel(spark, sf).select("entity", "day")
    return p.select("entity", "day", C.period_flag("day", "1998-03-01", "1998-07-31").alias("in_period"))


_CYC_SQL = LI + """
SELECT entity, day,
  round(sin(2 * pi() * month(day) / 12), 6) AS Month_sin, round(cos(2 * pi() * month(day) / 12), 6) AS Month_cos,
  round(sin(2 * pi() * (isodow(day) - 1) / 7), 6) AS DayOfWeek_sin,
  round(cos(2 * pi() * (isodow(day) - 1) / 7), 6) AS DayOfWeek_cos
FROM p
"""


@query("cyclical", _CYC_SQL)
def cyclical(spark, sf):
    p = li_panel(spark, sf).select("entity", "day")
    p = p.select("entity", "day", F.month("day").alias("Month"), F.weekday("day").alias("DayOfWeek"))
    out = C.add_cyclical(p).drop("Month", "DayOfWeek")
    return round_doubles(out)


_INDEX_TRAIN_SQL = EV + """
, b AS (SELECT min(pm25) AS l1, max(pm25) AS h1, min(pm10) AS l2, max(pm10) AS h2,
               min(no2) AS l3, max(no2) AS h3, min(co) AS l4, max(co) AS h4 FROM p)
SELECT entity, day, round(0.4 * ((pm25 - l1) / (h1 - l1)) + 0.3 * ((pm10 - l2) / (h2 - l2))
  + 0.2 * ((no2 - l3) / (h3 - l3)) + 0.1 * ((co - l4) / (h4 - l4)), 6) AS pollution_index
FROM p, b
"""


@query("composite_index_train", _INDEX_TRAIN_SQL)
def composite_index_train(spark, sf):
    p = ev_panel(spark, sf)
    w = {"pm25": 0.4, "pm10": 0.3, "no2": 0.2, "co": 0.1}
    return IDX.composite_index(p, w).select("entity", "day", "pollution_index")


_INDEX_SERVE_SQL = EV + """
SELECT entity, day, round(0.0
  + coalesce(least(1.0, greatest(0.0, (pm25 - 0.0) / 1000.0)), 0.0) * 0.4
  + coalesce(least(1.0, greatest(0.0, (pm10 - 0.0) / 2000.0)), 0.0) * 0.3
  + coalesce(least(1.0, greatest(0.0, (no2 - 0.0) / 330.0)), 0.0) * 0.2
  + coalesce(least(1.0, greatest(0.0, (co - 0.0) / 175.0)), 0.0) * 0.1, 6) AS serving_index
FROM p
"""


@query("composite_index_serving", _INDEX_SERVE_SQL)
def composite_index_serving(spark, sf):
    p = ev_panel(spark, sf)
    w = {"pm25": 0.4, "pm10": 0.3, "no2": 0.2, "co": 0.1}
    bounds = {"pm25": (0.0, 1000.0), "pm10": (0.0, 2000.0), "no2": (0.0, 330.0), "co": (0.0, 175.0)}
    return p.select("entity", "day", IDX.serving_index(w, bounds).alias("serving_index"))


_REINDEX_SQL = EV + """
SELECT entity, day, round(pm25, 6) AS pm25, CAST(NULL AS DOUBLE) AS temperature,
  CAST(NULL AS DOUBLE) AS humidity, round(aqi, 6) AS aqi
FROM p
"""


@query("placeholders_reindex", _REINDEX_SQL)
def placeholders_reindex(spark, sf):
    p = CL.add_placeholders(ev_panel(spark, sf), ["temperature", "humidity"])
    out = CL.reindex(p, [("entity", "int"), ("day", "date"), ("pm25", "double"), ("temperature", "double"),
                         ("humidity", "double"), ("aqi", "double")])
    return round_doubles(out)


def _dup_input(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_quantity")


@query("dedup_exact", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_quantity FROM lineitem")
def dedup_exact(spark, sf):
    return CL.remove_exact_duplicates(_dup_input(spark, sf))


_DUP_SQL = """
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows, CAST(coalesce(sum(c), 0) AS BIGINT) AS total_rows
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_suppkey, l_returnflag, l_linestatus, l_quantity)
"""


@query("dup_profile", _DUP_SQL)
def dup_profile(spark, sf):
    return CL.duplicate_count(_dup_input(spark, sf))


_LOGICAL_SQL = """
WITH k AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1)
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, round(o_totalprice, 6) AS o_totalprice
FROM orders SEMI JOIN k ON orders.o_custkey = k.o_custkey AND CAST(orders.o_orderdate AS DATE) = k.d
"""


@query("logical_dups", _LOGICAL_SQL)
def logical_dups(spark, sf):
    """SET-03: every row whose (customer, day) key occurs more than once."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"), "o_totalprice"
    )
    keys = o.groupBy("o_custkey", "d").count().where("count > 1").select("o_custkey", "d")
    return round_doubles(join_small(o, keys, ["o_custkey", "d"], "left_semi"))


_LOGICAL_SUM_SQL = """
SELECT CAST(count(*) AS BIGINT) AS duplicated_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_involved
FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE) HAVING count(*) > 1)
"""


@query("logical_dup_summary", _LOGICAL_SUM_SQL)
def logical_dup_summary(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("d"))
    k = o.groupBy("o_custkey", "d").count().where("count > 1")
    return k.agg(F.count(F.lit(1)).alias("duplicated_keys"),
                 F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("rows_involved"))


_SPLIT_SQL = LI + """
SELECT entity, day, CASE WHEN day <= DATE '1998-12-31' THEN 'train' WHEN day <= DATE '1999-12-31' THEN 'validation'
  WHEN day <= DATE '2001-08-01' THEN 'test' END AS split
FROM p WHERE day <= DATE '2001-08-01'
"""


@query("chrono_split", _SPLIT_SQL)
def chrono_split(spark, sf):
    p = li_panel(spark, sf).select("entity", "day")
    return SP.chronological_split(p, "day", LI_CUTOFFS)


_SPLIT_SUM_SQL = LI + """
, s AS (SELECT day, CASE WHEN day <= DATE '1998-12-31' THEN 'train' WHEN day <= DATE '1999-12-31' THEN 'validation'
  WHEN day <= DATE '2001-08-01' THEN 'test' END AS split FROM p)
SELECT split, count(*) AS rows, min(day) AS first, max(day) AS last FROM s WHERE split IS NOT NULL GROUP BY split
"""


@query("split_summary", _SPLIT_SUM_SQL)
def split_summary(spark, sf):
    p = SP.chronological_split(li_panel(spark, sf).select("entity", "day"), "day", LI_CUTOFFS)
    return SP.split_summary(p, "day")


def _miss_sql() -> str:
    parts = []
    for c in ("a", "n", "r", "q"):
        sel = [f"'{c}' AS feature"]
        for s, pfx in (("train", "train"), ("validation", "valid"), ("test", "test")):
            sel.append(f"CAST(count_if(split = '{s}' AND {c} IS NULL) AS BIGINT) AS {pfx}_missing")
            sel.append(
                f"CASE WHEN count_if(split = '{s}') > 0 THEN round(count_if(split = '{s}' AND {c} IS NULL)"
                f" / count_if(split = '{s}') * 100, 3) ELSE 0.0 END AS {pfx}_pct"
            )
        parts.append("SELECT " + ", ".join(sel) + " FROM s")
    return LI + """, s AS (SELECT *, CASE WHEN day <= DATE '1998-12-31' THEN 'train' WHEN day <= DATE '1999-12-31'
  THEN 'validation' WHEN day <= DATE '2001-08-01' THEN 'test' END AS split FROM p)
""" + "\nUNION ALL\n".join(parts)


@query("missing_by_split", _miss_sql())
def missing_by_split(spark, sf):
    p = SP.chronological_split(li_panel(spark, sf), "day", LI_CUTOFFS)
    return SP.missing_by_split(p, ["a", "n", "r", "q"])


def _raw_dates(spark, sf):
    """Stand-in raw text dates: ISO text for finished orders, day/month/year text otherwise."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    raw = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    return o.select("o_orderkey", raw.alias("raw"))


_RAW_DATES_SQL = """
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
  ELSE strftime(o_orderdate, '%d/%m/%Y') END AS raw FROM orders)
"""


@query("date_parse", _RAW_DATES_SQL + "SELECT o_orderkey, raw, CAST(try_strptime(trim(raw), '%Y-%m-%d') AS DATE) AS parsed FROM r")
def date_parse(spark, sf):
    r = _raw_dates(spark, sf)
    return r.select("o_orderkey", "raw", C.parse_date("raw").alias("parsed"))


_DATE_RANGE_SQL = _RAW_DATES_SQL + """
, d AS (SELECT raw, CAST(try_strptime(trim(raw), '%Y-%m-%d') AS DATE) AS parsed FROM r)
SELECT min(parsed) AS first_date, max(parsed) AS last_date,
  CAST(datediff('day', min(parsed), max(parsed)) AS INTEGER) AS span_days,
  CAST(datediff('day', min(parsed), max(parsed)) // 365 AS INTEGER) AS span_years,
  CAST(datediff('day', min(parsed), max(parsed)) % 365 AS INTEGER) AS span_rem_days,
  CAST(count_if(raw IS NOT NULL AND parsed IS NULL) AS BIGINT) AS invalid_dates
FROM d
"""


@query("date_range", _DATE_RANGE_SQL)
def date_range(spark, sf):
    """AGG-05 + VAL-12: range, span (years + days) and unparseable count."""
    from ..operators.quality import date_range as dr

    return dr(_raw_dates(spark, sf), "raw")
