"""Catalogue: profiling queries (M2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..sources.tables import ev_panel, li_panel, table
from .q_windows import EV, LI
from .registry import query, round_doubles

EV_COLS = ["entity", "day", "pm25", "pm10", "no2", "co", "aqi"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_MISS_COL_SQL = EV + ", w AS (SELECT count(*) AS n, " + ", ".join(
    f"count_if({c} IS NULL) AS m_{c}" for c in EV_COLS
) + " FROM p)\n" + _union([
    f"SELECT '{c}' AS column_name, CAST(m_{c} AS BIGINT) AS missing, "
    f"CASE WHEN n > 0 THEN round(m_{c} / n * 100, 2) ELSE 0.0 END AS missing_pct, "
    f"(CASE WHEN n > 0 THEN round(m_{c} / n * 100, 2) ELSE 0.0 END) > 30 AS high FROM w"
    for c in EV_COLS
])


@query("missing_by_column", _MISS_COL_SQL)
def missing_by_column(spark, sf):
    return Q.missing_by_column(ev_panel(spark, sf), EV_COLS)


_ROWNULL_SQL = EV + """
, a AS (SELECT count(*) AS rows,
  sum((entity IS NULL)::BIGINT + (day IS NULL)::BIGINT + (pm25 IS NULL)::BIGINT + (pm10 IS NULL)::BIGINT
      + (no2 IS NULL)::BIGINT + (co IS NULL)::BIGINT + (aqi IS NULL)::BIGINT) AS mc,
  count_if(entity IS NULL OR day IS NULL OR pm25 IS NULL OR pm10 IS NULL OR no2 IS NULL OR co IS NULL OR aqi IS NULL) AS ra,
  count_if(pm25 IS NULL AND pm10 IS NULL AND no2 IS NULL AND co IS NULL) AS rall FROM p)
SELECT CAST(rows * 7 AS BIGINT) AS total_cells, CAST(coalesce(mc, 0) AS BIGINT) AS missing_cells,
  CASE WHEN rows * 7 > 0 THEN round(coalesce(mc, 0) / (rows * 7) * 100, 2) ELSE 0.0 END AS missing_pct,
  CAST(ra AS BIGINT) AS rows_any_null,
  CASE WHEN rows > 0 THEN round(ra / rows * 100, 2) ELSE 0.0 END AS rows_any_pct,
  CAST(rall AS BIGINT) AS rows_all_channels_null
FROM a
"""


@query("row_null_profile", _ROWNULL_SQL)
def row_null_profile(spark, sf):
    return Q.row_null_profile(ev_panel(spark, sf), ["pm25", "pm10", "no2", "co"], EV_COLS)


_EXPECTED = [0, 3, 7, 24, 99]

_ENTITY_SQL = LI + """
, e AS (SELECT CAST(x AS INTEGER) AS entity FROM (VALUES (0), (3), (7), (24), (99)) t(x)),
g AS (SELECT entity, count(*) AS rows, min(day) AS first, max(day) AS last, count(a) AS target_count,
  count_if(a IS NULL) AS target_missing, avg(a) AS target_mean, min(a) AS target_min, max(a) AS target_max,
  stddev_samp(a) AS target_std, quantile_cont(a, 0.5) AS target_median,
  count_if(a IS NULL) AS a_missing, count_if(n IS NULL) AS n_missing, count_if(r IS NULL) AS r_missing
  FROM p WHERE entity IN (SELECT entity FROM e) GROUP BY entity)
SELECT e.entity, CAST(coalesce(g.rows, 0) AS BIGINT) AS rows, g.first, g.last,
  CAST(g.target_count AS BIGINT) AS target_count, CAST(g.target_missing AS BIGINT) AS target_missing,
  round(g.target_mean, 6) AS target_mean, round(g.target_min, 6) AS target_min, round(g.target_max, 6) AS target_max,
  round(g.target_std, 6) AS target_std, CAST(g.a_missing AS BIGINT) AS a_missing,
  CAST(g.n_missing AS BIGINT) AS n_missing, CAST(g.r_missing AS BIGINT) AS r_missing,
  round(g.target_median, 6) AS target_median, CAST(datediff('day', g.first, g.last) AS INTEGER) AS span_days,
  round(g.a_missing / g.rows * 100, 1) AS a_pct, round(g.n_missing / g.rows * 100, 1) AS n_pct,
  round(g.r_missing / g.rows * 100, 1) AS r_pct, g.rows IS NOT NULL AS found
FROM e LEFT JOIN g ON e.entity = g.entity
"""


@query("entity_profile", _ENTITY_SQL)
def entity_profile(spark, sf):
    out = Q.entity_profile(li_panel(spark, sf), "entity", "day", "a", ["a", "n", "r"], _EXPECTED)
    return round_doubles(out.select(
        "entity", "rows", "first", "last", "target_count", "target_missing", "target_mean", "target_min",
        "target_max", "target_std", "a_missing", "n_missing", "r_missing", "target_median", "span_days",
        "a_pct", "n_pct", "r_pct", "found",
    ))


_DIST_SQL = LI + """
SELECT count(a) AS n, CAST(count_if(a IS NULL) AS BIGINT) AS missing, round(avg(a), 6) AS mean,
  round(quantile_cont(a, 0.5), 6) AS median, round(stddev_samp(a), 6) AS std,
  round(skewness(a), 6) AS skewness, round(kurtosis(a), 6) AS kurtosis,
  CASE WHEN skewness(a) > 0 THEN 'right' WHEN skewness(a) IS NOT NULL THEN 'left' END AS skew_direction
FROM p
"""


@query("distribution", _DIST_SQL)
def distribution(spark, sf):
    return round_doubles(Q.distribution(li_panel(spark, sf), "a"))


_PCT_SQL = LI + "\n" + _union([
    f"SELECT CAST({p} AS INTEGER) AS pct, round(quantile_cont(q, {p / 100}), 6) AS value FROM p"
    for p in Q.PERCENTILES
])


@query("percentiles", _PCT_SQL)
def percentiles(spark, sf):
    return round_doubles(Q.percentiles(li_panel(spark, sf), "q"))


_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM"]

_CAT_SQL = """
SELECT o_orderpriority AS category, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM orders) * 100, 1) AS pct,
  CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 END AS INTEGER) AS ord
FROM orders GROUP BY o_orderpriority
"""


@query("category_freq", _CAT_SQL)
def category_freq(spark, sf):
    o = table(spark, sf, "orders").select("o_orderpriority")
    return Q.category_frequency(o, "o_orderpriority", _ORDER)


_IQR_SQL = LI + """
, u AS (""" + _union([f"SELECT '{c}' AS column_name, {c} AS v FROM p" for c in "anrq"]) + """),
qs AS (SELECT column_name, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM u GROUP BY 1)
SELECT u.column_name, round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3,
  round(any_value(q3 - q1), 6) AS iqr, round(any_value(q1 - 1.5 * (q3 - q1)), 6) AS lower,
  round(any_value(q3 + 1.5 * (q3 - q1)), 6) AS upper,
  CAST(count_if(v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers,
  CASE WHEN count(v) > 0 THEN round(count_if(v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) / count(v) * 100, 2)
       ELSE 0.0 END AS outlier_pct
FROM u JOIN qs ON u.column_name = qs.column_name GROUP BY u.column_name
"""


@query("iqr_outliers", _IQR_SQL)
def iqr_outliers(spark, sf):
    return round_doubles(Q.iqr_outliers(li_panel(spark, sf), ["a", "n", "r", "q"]))


def _corr_sql(body: str) -> str:
    rows = _union([
        f"SELECT '{c}' AS column_name, CASE WHEN regr_count(aqi, {c}) > 10 THEN round(corr(aqi, {c}), 4) END AS r FROM p"
        for c in ("pm25", "pm10", "no2", "co")
    ])
    return EV + f", c AS ({rows})\n" + body


_CORR_SQL = _corr_sql("""
SELECT column_name, r,
  CASE WHEN abs(r) >= 0.7 THEN 'Strong' WHEN abs(r) >= 0.4 THEN 'Moderate' WHEN abs(r) >= 0.2 THEN 'Weak'
       WHEN r IS NOT NULL THEN 'Negligible' END AS strength,
  CASE WHEN r > 0 THEN 'positive' WHEN r IS NOT NULL THEN 'negative' END AS direction,
  CAST(coalesce(floor(abs(r) * 20), 0) AS INTEGER) AS bar
FROM c
""")


@query("corr_target", _CORR_SQL)
def corr_target(spark, sf):
    return Q.correlations(ev_panel(spark, sf), "aqi", ["pm25", "pm10", "no2", "co"])


_SCREEN_SQL = _corr_sql(
    "SELECT column_name, r, CASE WHEN abs(r) >= 0.4 THEN 'keep' ELSE 'caution' END AS decision FROM c"
)


@query("corr_screen", _SCREEN_SQL)
def corr_screen(spark, sf):
    return Q.screen_features(Q.correlations(ev_panel(spark, sf), "aqi", ["pm25", "pm10", "no2", "co"]))


_SUMMARY_SQL = EV + """
SELECT entity, count(aqi) AS readings, round(avg(aqi), 1) AS mean, round(max(aqi), 1) AS max FROM p GROUP BY entity
"""


@query("entity_summary", _SUMMARY_SQL)
def entity_summary(spark, sf):
    return Q.entity_summary(ev_panel(spark, sf), "entity", "aqi")


_OVERVIEW_SQL = LI + "SELECT count(*) AS rows, 6 AS columns FROM p"


@query("overview", _OVERVIEW_SQL)
def overview(spark, sf):
    return Q.overview(li_panel(spark, sf)).select("rows", "columns")
