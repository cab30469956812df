"""Catalogue: scaling, KNN imputation and policy fills (M4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bands as B
from ..operators import clean as CL
from ..operators import impute as I
from ..operators import scale as SC
from ..operators import split as SP
from ..sources.tables import ev_panel, li_panel, table
from ..spec import LI_CUTOFFS, SUBINDEX_BANDS
from .q_windows import EV, LI
from .registry import query, round_doubles

_T1 = LI_CUTOFFS[0]

_SCALE_SQL = LI + f"""
, s AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(n) AS mn, stddev_pop(n) AS sn, avg(r) AS mr,
  stddev_pop(r) AS sr, avg(q) AS mq, stddev_pop(q) AS sq FROM p WHERE day <= DATE '{_T1}')
SELECT entity, day,
  round((a - ma) / CASE WHEN sa IS NULL OR sa = 0 THEN 1.0 ELSE sa END, 6) AS a,
  round((n - mn) / CASE WHEN sn IS NULL OR sn = 0 THEN 1.0 ELSE sn END, 6) AS n,
  round((r - mr) / CASE WHEN sr IS NULL OR sr = 0 THEN 1.0 ELSE sr END, 6) AS r,
  round((q - mq) / CASE WHEN sq IS NULL OR sq = 0 THEN 1.0 ELSE sq END, 6) AS q
FROM p, s
"""


@query("standard_scale", _SCALE_SQL)
def standard_scale(spark, sf):
    """SCL-01: mean / population std fitted on the train split, applied to every row."""
    p = li_panel(spark, sf)
    train = SP.chronological_split(p, "day", LI_CUTOFFS).where("split = 'train'")
    params = SC.fit_scaler(train, ["a", "n", "r", "q"])
    return round_doubles(SC.apply_scaler(p, params))


_PARAMS_SQL = LI + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(CASE WHEN stddev_pop({c}) IS NULL OR stddev_pop({c}) = 0 "
    f"THEN 1.0 ELSE stddev_pop({c}) END, 6) AS scale FROM p WHERE day <= DATE '{_T1}'"
    for c in "anrq"
)


@query("scaler_params", _PARAMS_SQL)
def scaler_params(spark, sf):
    """SCL-03: the fitted parameter table."""
    p = li_panel(spark, sf)
    train = SP.chronological_split(p, "day", LI_CUTOFFS).where("split = 'train'")
    return round_doubles(SC.scaler_table(spark, SC.fit_scaler(train, ["a", "n", "r", "q"])))


KNN_COLS = ["a", "n", "r", "q", "Year", "Month", "DayOfMonth", "DayOfWeek"]


def _knn_input(spark, sf):
    p = li_panel(spark, sf)
    return p.select(
        "entity", "day", "a", "n", "r", "q",
        F.year("day").cast("double").alias("Year"), F.month("day").cast("double").alias("Month"),
        F.dayofmonth("day").cast("double").alias("DayOfMonth"), F.weekday("day").cast("double").alias("DayOfWeek"),
    )


def _knn_sql() -> str:
    cols = KNN_COLS
    nb = " + ".join(f"(CASE WHEN x.{c} IS NOT NULL AND t.{c} IS NOT NULL THEN 1 ELSE 0 END)" for c in cols)
    ss = " + ".join(f"coalesce((x.{c} - t.{c}) * (x.{c} - t.{c}), 0.0)" for c in cols)
    cells = "\nUNION ALL\n".join(
        f"SELECT xe, xd, '{c}' AS j, d, te, td, t_{c} AS y FROM pr WHERE x_{c} IS NULL AND t_{c} IS NOT NULL"
        for c in ("a", "n", "r")
    )
    fill = ", ".join(
        f"round(coalesce(f.{c}, (SELECT v FROM imp WHERE xe = f.entity AND xd = f.day AND j = '{c}'), "
        f"(SELECT avg({c}) FROM t)), 6) AS {c}" for c in ("a", "n", "r")
    )
    return LI + f"""
, f AS (SELECT entity, day, a, n, r, q, CAST(year(day) AS DOUBLE) AS Year, CAST(month(day) AS DOUBLE) AS Month,
   CAST(day(day) AS DOUBLE) AS DayOfMonth, CAST(isodow(day) - 1 AS DOUBLE) AS DayOfWeek FROM p),
t AS (SELECT * FROM f WHERE day <= DATE '{_T1}'),
x AS (SELECT * FROM f WHERE a IS NULL OR n IS NULL OR r IS NULL),
pr AS (SELECT x.entity AS xe, x.day AS xd, t.entity AS te, t.day AS td, x.a AS x_a, x.n AS x_n, x.r AS x_r,
   t.a AS t_a, t.n AS t_n, t.r AS t_r, CASE WHEN ({nb}) > 0 THEN sqrt({len(cols)}.0 / ({nb}) * ({ss})) END AS d
   FROM x, t),
c AS ({cells}),
rk AS (SELECT *, row_number() OVER (PARTITION BY xe, xd, j ORDER BY d, te, td) AS rn FROM c WHERE d IS NOT NULL),
imp AS (SELECT xe, xd, j, avg(y) AS v FROM rk WHERE rn <= 5 GROUP BY xe, xd, j)
SELECT f.entity, f.day, {fill}, round(f.q, 6) AS q FROM f
"""


@query("knn_impute", _knn_sql())
def knn_impute(spark, sf):
    """IMP-01: k=5 NaN-Euclidean KNN imputation fitted on the train split, applied to all
    rows (unscaled distance over channels and calendar parts)."""
    f = I.materialize(_knn_input(spark, sf))  # read by the fit (twice) and the transform (twice)
    train = f.where(F.col("day") <= F.lit(_T1).cast("date"))
    model = I.fit_knn(train, ["entity", "day"], KNN_COLS, k=5)
    out = model.transform(f)
    return round_doubles(out.select("entity", "day", "a", "n", "r", "q"))


_FFILL_SQL = EV + """
SELECT entity, day,
  round(coalesce(last_value(pm25 IGNORE NULLS) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(pm25 IGNORE NULLS) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS pm25,
  round(coalesce(last_value(co IGNORE NULLS) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(co IGNORE NULLS) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS co
FROM p
"""


@query("ffill_bfill", _FFILL_SQL)
def ffill_bfill(spark, sf):
    """POL-01 with 7-day chunks, so fills cross chunk borders through the carry table."""
    p = ev_panel(spark, sf).select("entity", "day", "pm25", "co")
    return round_doubles(I.ffill_bfill(p, "entity", ["day"], ["pm25", "co"], chunk_days=7))


_MEDFILL_SQL = LI + """
, m AS (SELECT entity, date_trunc('month', day) AS mo, quantile_cont(a, 0.5) AS ma, quantile_cont(n, 0.5) AS mn
        FROM p GROUP BY 1, 2),
e AS (SELECT entity, avg(a) AS ea, avg(n) AS en FROM p GROUP BY 1)
SELECT p.entity, p.day, round(coalesce(p.a, m.ma, e.ea), 6) AS a, round(coalesce(p.n, m.mn, e.en), 6) AS n
FROM p JOIN m ON p.entity = m.entity AND date_trunc('month', p.day) = m.mo JOIN e ON p.entity = e.entity
"""


@query("monthly_median_fill", _MEDFILL_SQL)
def monthly_median_fill(spark, sf):
    p = li_panel(spark, sf).select("entity", "day", "a", "n")
    return round_doubles(I.monthly_median_fill(p, "entity", "day", ["a", "n"]))


_RATIO_SQL = EV + "SELECT entity, day, round(CASE WHEN pm10 = 0 THEN NULL ELSE pm25 / pm10 END, 6) AS pm_ratio FROM p"


@query("ratio_feature", _RATIO_SQL)
def ratio_feature(spark, sf):
    """POL-06: ratio of two channels; a zero or NULL divisor gives NULL."""
    p = ev_panel(spark, sf)
    return round_doubles(p.select("entity", "day", F.try_divide("pm25", "pm10").alias("pm_ratio")))


_TARGET_FILL_SQL = EV + """
SELECT entity, day, round(aqi, 6) AS aqi_raw,
  CAST(round(coalesce(aqi, CASE WHEN round(pm25, 2) IS NULL OR round(pm25, 2) < 0 THEN NULL
  """ + " ".join(
    f"WHEN round(pm25, 2) <= {c_hi} THEN round_even({(i_hi - i_lo) / (c_hi - c_lo)!r} * (greatest(round(pm25, 2), {c_lo}) - {c_lo}) + {float(i_lo)}, 0)"
    for c_lo, c_hi, i_lo, i_hi in SUBINDEX_BANDS
) + """ ELSE 500.0 END), 6) AS DOUBLE) AS aqi
FROM p WHERE NOT (aqi IS NULL AND pm25 IS NULL AND pm10 IS NULL AND no2 IS NULL AND co IS NULL)
"""


@query("policy_target_fill", _TARGET_FILL_SQL)
def policy_target_fill(spark, sf):
    """POL-04: drop rows with target and all channels NULL; a missing target is recomputed as
    the PM2.5 sub-index of the day's reading."""
    p = CL.remove_empty_rows(ev_panel(spark, sf), "aqi", ["pm25", "pm10", "no2", "co"])
    filled = F.coalesce(F.col("aqi"), B.subindex(F.round("pm25", 2)).cast("double"))
    return round_doubles(p.select("entity", "day", F.col("aqi").alias("aqi_raw"), filled.alias("aqi")))


_CLEAN_SQL = """
SELECT o_orderkey, o_custkey, d, round(target, 6) AS target FROM (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, o_totalprice / 1000 AS target,
    row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS rn
  FROM orders WHERE o_orderdate IS NOT NULL AND (o_totalprice / 1000 IS NULL OR o_totalprice / 1000 BETWEEN 0 AND 500)
) WHERE rn = 1
"""


@query("policy_clean", _CLEAN_SQL)
def policy_clean(spark, sf):
    """POL-05: drop NULL dates and out-of-range targets, keep the first row per (entity, day)."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"),
        (F.col("o_totalprice") / 1000).alias("target"),
    )
    out = CL.policy_clean(o, "o_custkey", "d", "target", 0.0, 500.0, order_cols=["o_orderkey"])
    return round_doubles(out)


_LONG_SQL = LI + """
SELECT entity, day, round(lag(q, 14) OVER w, 6) AS q_lag_14, round(lag(q, 30) OVER w, 6) AS q_lag_30,
  round(avg(q) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), 6) AS q_roll_mean_14,
  round(avg(q) OVER (w ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 6) AS q_roll_mean_30
FROM p WINDOW w AS (PARTITION BY entity ORDER BY day)
"""


@query("long_lags", _LONG_SQL)
def long_lags(spark, sf):
    """POL-07: lags 14 / 30 and rolling means 14 / 30 (look-back longer than a 20-day chunk)."""
    from ..operators import windows as W

    feats = W.lag_features({"q": [14, 30]}) + W.rolling_features("q", means=(14, 30), stats_n=None)
    out = W.add_window_features(li_panel(spark, sf), "entity", ["day"], feats)
    return round_doubles(out.select("entity", "day", *[f.name for f in feats]))


@query("two_way_split", LI + """
SELECT entity, day, CASE WHEN day <= DATE '1999-12-31' THEN 'train' ELSE 'test' END AS split
FROM p WHERE day <= DATE '2000-12-31'
""")
def two_way_split(spark, sf):
    """POL-09: the alternative two-way chronological split."""
    return SP.two_way_split(li_panel(spark, sf).select("entity", "day"), "day", "1999-12-31", "2000-12-31")


_COMBINE_SQL = LI + """
, w AS (SELECT CAST(c_nationkey AS INTEGER) AS entity, CAST(o_orderdate AS DATE) AS day,
  avg(o_totalprice) / 997 AS temperature FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT p.entity, p.day, round(p.q, 6) AS q, round(w.temperature, 6) AS temperature
FROM p LEFT JOIN w ON p.entity = w.entity AND p.day = w.day
"""


@query("combine_sources", _COMBINE_SQL)
def combine_sources(spark, sf):
    """POL-08: history rows + live rows (the panel before / after 2000-12-31) combined, and the
    weather placeholder filled from an enrichment table (mean order value per nation and day)."""
    p = CL.add_placeholders(li_panel(spark, sf).select("entity", "day", "q"), ["temperature"])
    hist = p.where(F.col("day") <= F.lit("2000-12-31").cast("date"))
    live = p.where(F.col("day") > F.lit("2000-12-31").cast("date")).drop("temperature")
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    enrich = o.join(c, o.o_custkey == c.c_custkey).groupBy(
        F.col("c_nationkey").cast("int").alias("entity"), F.col("o_orderdate").cast("date").alias("day")
    ).agg((F.avg("o_totalprice") / 997).alias("temperature"))
    out = CL.combine_sources(hist, live, enrich, ["entity", "day"], ["temperature"])
    return round_doubles(out.select("entity", "day", "q", "temperature"))
