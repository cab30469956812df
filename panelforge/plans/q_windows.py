"""Catalogue: panels and window features (M0/M1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as W
from ..sources.tables import EV_PANEL_SQL, LI_PANEL_SQL, ev_panel, li_panel, table
from ..spec import EV_PANEL, LI_PANEL
from .registry import query, round_doubles

EV = f"WITH p AS ({EV_PANEL_SQL})\n"
LI = f"WITH p AS ({LI_PANEL_SQL})\n"


def _r(cols: list[str], d: int = 6) -> str:
    return ", ".join(f"round({c}, {d}) AS {c}" for c in cols)


@query("panel_ev", EV + f"SELECT entity, day, {_r(['pm25', 'pm10', 'no2', 'co', 'aqi'])} FROM p")
def panel_ev(spark, sf):
    return round_doubles(ev_panel(spark, sf))


@query("panel_li", LI + f"SELECT entity, day, {_r(['a', 'n', 'r', 'q'])} FROM p")
def panel_li(spark, sf):
    return round_doubles(li_panel(spark, sf))


_LAGS_SQL = EV + """
SELECT entity, day, round(aqi, 6) AS aqi,
  round(lag(aqi, 1) OVER w, 6) AS aqi_lag_1, round(lag(aqi, 2) OVER w, 6) AS aqi_lag_2,
  round(lag(aqi, 3) OVER w, 6) AS aqi_lag_3, round(lag(aqi, 7) OVER w, 6) AS aqi_lag_7,
  round(lag(pm25, 1) OVER w, 6) AS pm25_lag_1, round(lag(pm25, 3) OVER w, 6) AS pm25_lag_3,
  round(lag(pm10, 1) OVER w, 6) AS pm10_lag_1, round(lag(co, 1) OVER w, 6) AS co_lag_1
FROM p WINDOW w AS (PARTITION BY entity ORDER BY day)
"""


@query("lags", _LAGS_SQL)
def lags(spark, sf):
    p = ev_panel(spark, sf)
    feats = W.lag_features({"aqi": [1, 2, 3, 7], "pm25": [1, 3], "pm10": [1], "co": [1]})
    out = W.add_window_features(p, EV_PANEL.entity, EV_PANEL.order_cols, feats)
    return round_doubles(out.select("entity", "day", "aqi", *[f.name for f in feats]))


_ROLL_MEAN_SQL = LI + """
SELECT entity, day, round(q, 6) AS q,
  round(avg(q) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS q_roll_mean_3,
  round(avg(q) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS q_roll_mean_7,
  round(avg(a) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS a_roll_mean_7
FROM p
"""


@query("rolling_mean", _ROLL_MEAN_SQL)
def rolling_mean(spark, sf):
    p = li_panel(spark, sf)
    feats = W.rolling_features("q", means=(3, 7), stats_n=None) + W.rolling_features("a", means=(7,), stats_n=None)
    out = W.add_window_features(p, LI_PANEL.entity, LI_PANEL.order_cols, feats)
    return round_doubles(out.select("entity", "day", "q", *[f.name for f in feats]))


_ROLL_STATS_SQL = EV + """
SELECT entity, day,
  round(stddev_samp(aqi) OVER f, 6) AS aqi_roll_std_7,
  round(max(aqi) OVER f, 6) AS aqi_roll_max_7,
  round(min(aqi) OVER f, 6) AS aqi_roll_min_7
FROM p WINDOW f AS (PARTITION BY entity ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
"""


@query("rolling_std_min_max", _ROLL_STATS_SQL)
def rolling_std_min_max(spark, sf):
    p = ev_panel(spark, sf)
    feats = W.rolling_features("aqi", means=(), stats_n=7)
    out = W.add_window_features(p, EV_PANEL.entity, EV_PANEL.order_cols, feats)
    return round_doubles(out.select("entity", "day", *[f.name for f in feats]))


_DELTAS_SQL = LI + """
SELECT entity, day,
  round(q - lag(q) OVER w, 6) AS q_change,
  round(a - lag(a) OVER w, 6) AS a_change,
  round(n - lag(n) OVER w, 6) AS n_change
FROM p WINDOW w AS (PARTITION BY entity ORDER BY day)
"""


@query("deltas", _DELTAS_SQL)
def deltas(spark, sf):
    p = li_panel(spark, sf)
    feats = W.change_features(["q", "a", "n"])
    out = W.add_window_features(p, LI_PANEL.entity, LI_PANEL.order_cols, feats)
    return round_doubles(out.select("entity", "day", *[f.name for f in feats]))


_FEATURE_BLOCK_SQL = LI + """
SELECT entity, day,
  round(lag(q, 1) OVER w, 6) AS q_lag_1, round(lag(q, 2) OVER w, 6) AS q_lag_2,
  round(lag(q, 3) OVER w, 6) AS q_lag_3, round(lag(q, 7) OVER w, 6) AS q_lag_7,
  round(lag(a, 1) OVER w, 6) AS a_lag_1, round(lag(a, 3) OVER w, 6) AS a_lag_3,
  round(lag(n, 1) OVER w, 6) AS n_lag_1, round(lag(r, 1) OVER w, 6) AS r_lag_1,
  round(avg(q) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS q_roll_mean_3,
  round(avg(q) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS q_roll_mean_7,
  round(stddev_samp(q) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS q_roll_std_7,
  round(max(q) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS q_roll_max_7,
  round(min(q) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS q_roll_min_7,
  round(q - lag(q) OVER w, 6) AS q_change, round(a - lag(a) OVER w, 6) AS a_change,
  round(n - lag(n) OVER w, 6) AS n_change
FROM p WINDOW w AS (PARTITION BY entity ORDER BY day)
"""


@query("feature_block", _FEATURE_BLOCK_SQL)
def feature_block(spark, sf):
    """The full lag / rolling / delta block of the pipeline on the LI panel."""
    p = li_panel(spark, sf)
    feats = W.standard_features("q", {"a": [1, 3], "n": [1], "r": [1]}, ["q", "a", "n"])
    out = W.add_window_features(p, LI_PANEL.entity, LI_PANEL.order_cols, feats)
    return round_doubles(out.select("entity", "day", *[f.name for f in feats]))


_RAW_WINDOWS_SQL = """
SELECT l_suppkey, l_orderkey, l_linenumber,
  round(lag(l_quantity, 1) OVER w, 6) AS l_quantity_lag_1,
  round(lag(l_quantity, 7) OVER w, 6) AS l_quantity_lag_7,
  round(avg(l_extendedprice) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS l_extendedprice_roll_mean_7,
  round(stddev_samp(l_extendedprice) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS l_extendedprice_roll_std_7,
  round(l_quantity - lag(l_quantity) OVER w, 6) AS l_quantity_change
FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber)
"""


@query("raw_lineitem_windows", _RAW_WINDOWS_SQL)
def raw_lineitem_windows(spark, sf):
    """Row-offset windows on raw lineitem per supplier (the sf0.1 scale run)."""
    li = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice"
    )
    feats = [
        W.Feature("l_quantity_lag_1", "lag", "l_quantity", 1),
        W.Feature("l_quantity_lag_7", "lag", "l_quantity", 7),
        W.Feature("l_extendedprice_roll_mean_7", "mean", "l_extendedprice", 7),
        W.Feature("l_extendedprice_roll_std_7", "std", "l_extendedprice", 7),
        W.Feature("l_quantity_change", "change", "l_quantity"),
    ]
    out = W.add_window_features(li, "l_suppkey", ["l_shipdate", "l_orderkey", "l_linenumber"], feats)
    return round_doubles(out.select("l_suppkey", "l_orderkey", "l_linenumber", *[f.name for f in feats]))


_CROSS_SQL = EV + """
SELECT entity, day, round(aqi, 6) AS aqi, round(prev, 6) AS aqi_prev FROM (
  SELECT entity, day, aqi, lag(aqi) OVER (PARTITION BY entity ORDER BY day) AS prev FROM p
) WHERE aqi >= 150 AND prev < 150
"""


@query("threshold_crossing", _CROSS_SQL)
def threshold_crossing(spark, sf):
    p = ev_panel(spark, sf)
    out = W.threshold_crossings(p, "entity", ["day"], "aqi", 150.0)
    return round_doubles(out.select("entity", "day", "aqi", "aqi_prev"))


_MEDIAN_SQL = EV + """
SELECT entity, day,
  round(quantile_cont(pm25, 0.5) OVER (PARTITION BY entity ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6)
    AS pm25_roll_median_7
FROM p
"""


@query("rolling_median", _MEDIAN_SQL)
def rolling_median(spark, sf):
    """POL-02: rolling 7-row median (current row included)."""
    p = ev_panel(spark, sf)
    feats = [W.Feature("pm25_roll_median_7", "median", "pm25", 7)]
    out = W.add_window_features(p, "entity", ["day"], feats)
    return round_doubles(out.select("entity", "day", "pm25_roll_median_7"))
