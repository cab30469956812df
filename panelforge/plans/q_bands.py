"""Catalogue: bands, categories, advisories, station ingest, request validation (M3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import bands as B
from ..operators import validate as V
from ..sources import standins as S
from ..sources.stations import complete_cities, stations_from_payload
from ..sources.tables import table
from ..spec import ADVISORIES, SUBINDEX_BANDS
from .q_windows import EV
from ..operators.joins import range_lookup
from ..operators.ordering import global_rank
from ..operators.rank import interpretability_join
from .registry import query, round_doubles


def _subindex_sql(v: str, gaps: str) -> str:
    parts = []
    for c_lo, c_hi, i_lo, i_hi in SUBINDEX_BANDS:
        slope = (i_hi - i_lo) / (c_hi - c_lo)
        if gaps == "reference":
            parts.append(f"WHEN {v} >= {c_lo} AND {v} <= {c_hi} THEN round_even({slope!r} * ({v} - {c_lo}) + {float(i_lo)}, 0)")
        else:
            parts.append(
                f"WHEN {v} <= {c_hi} THEN round_even({slope!r} * (greatest({v}, {c_lo}) - {c_lo}) + {float(i_lo)}, 0)"
            )
    return f"CAST(CASE WHEN {v} IS NULL OR {v} < 0 THEN NULL {' '.join(parts)} ELSE 500.0 END AS INTEGER)"


def _category_sql(v: str) -> str:
    return (f"CASE WHEN {v} IS NULL THEN 'Unknown' WHEN {v} <= 50 THEN 'Good' WHEN {v} <= 100 THEN 'Satisfactory' "
            f"WHEN {v} <= 200 THEN 'Moderate' WHEN {v} <= 300 THEN 'Poor' WHEN {v} <= 400 THEN 'Very Poor' "
            f"ELSE 'Severe' END")


_STATION_SQL = f"""
WITH s AS (SELECT n_name AS city, s_name AS station, n_name AS country, CAST(s_nationkey AS DOUBLE) AS latitude,
  CAST(-s_nationkey AS DOUBLE) AS longitude, '2024-01-01T00:00:00' AS last_updated,
  round(abs(s_acctbal) / 19, 2) AS pm25, round(abs(s_acctbal) / 7, 2) AS pm10,
  CASE WHEN s_acctbal >= 0 THEN round(abs(s_acctbal) / 31, 2) END AS no2, CAST(NULL AS DOUBLE) AS so2,
  round(s_acctbal / 1001, 2) AS co, CAST(NULL AS DOUBLE) AS o3
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT *, {_subindex_sql('pm25', 'reference')} AS calculated_aqi,
  {_category_sql(_subindex_sql('pm25', 'reference'))} AS aqi_category FROM s
"""


def _stations(spark, sf):
    return stations_from_payload(S.station_payloads(spark, sf), "value")


@query("station_rows", _STATION_SQL)
def station_rows(spark, sf):
    """SRC-09: landed station JSON -> one reading row per station with sub-index and category."""
    return _stations(spark, sf)


_COMPLETE_SQL = f"""
WITH s AS (SELECT n_name AS city, s_name AS station, {_category_sql(_subindex_sql('round(abs(s_acctbal) / 19, 2)', 'reference'))}
  AS aqi_category FROM supplier JOIN nation ON s_nationkey = n_nationkey),
e AS (SELECT n_name AS city FROM nation UNION SELECT r_name FROM region)
SELECT city, station, aqi_category FROM s
UNION ALL
SELECT city, 'No Data' AS station, 'Unknown' AS aqi_category FROM e WHERE city NOT IN (SELECT city FROM s)
"""


@query("entity_completeness", _COMPLETE_SQL)
def entity_completeness(spark, sf):
    """SRC-10: every expected city appears; cities without stations get a placeholder."""
    out = complete_cities(_stations(spark, sf), S.expected_cities(spark, sf))
    return out.select("city", "station", "aqi_category")


_SUBINDEX_SQL = f"""
WITH v AS (SELECT l_orderkey, l_linenumber, round(l_extendedprice / 191, 2) AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, c, {_subindex_sql('c', 'reference')} AS subindex_reference,
  {_subindex_sql('c', 'continuous')} AS subindex_continuous FROM v
"""


def _conc(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return li.select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") / 191, 2).alias("c"))


@query("subindex", _SUBINDEX_SQL)
def subindex(spark, sf):
    """FN-22 in both gap modes on scaled line prices (values up to ~550, so every band,
    the gaps and the ceiling occur)."""
    v = _conc(spark, sf)
    return v.select("l_orderkey", "l_linenumber", "c", B.subindex("c", gaps="reference").alias("subindex_reference"),
                    B.subindex("c", gaps="continuous").alias("subindex_continuous"))


@query("subindex_range_join", f"""
WITH v AS (SELECT l_orderkey, l_linenumber, round(l_extendedprice / 191, 2) AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, {_subindex_sql('c', 'reference')} AS subindex FROM v
""")
def subindex_range_join(spark, sf):
    """JOIN-04: the same sub-index through a join with the band table over bins of the value."""
    v = _conc(spark, sf)
    out = B.subindex_join(v, "c", B.band_table(spark))
    return out.select("l_orderkey", "l_linenumber", "subindex")


_CATEGORY_SQL = f"""
WITH v AS (SELECT l_orderkey, l_linenumber, {_subindex_sql('round(l_extendedprice / 191, 2)', 'continuous')} AS idx
  FROM lineitem)
SELECT l_orderkey, l_linenumber, idx, {_category_sql('idx')} AS category FROM v
"""


@query("category_band", _CATEGORY_SQL)
def category_band(spark, sf):
    v = _conc(spark, sf).select("l_orderkey", "l_linenumber", B.subindex("c").alias("idx"))
    return v.select("l_orderkey", "l_linenumber", "idx", B.category("idx").alias("category"))


def _advice_sql(cat: str) -> str:
    whens = " ".join(
        f"WHEN '{k}' THEN '" + " | ".join(items).replace("'", "''") + "'" for k, items in ADVISORIES.items()
    )
    counts = " ".join(f"WHEN '{k}' THEN {len(items)}" for k, items in ADVISORIES.items())
    return f"CASE {cat} {whens} END AS advice, CAST(CASE {cat} {counts} END AS INTEGER) AS advice_count"


_ADVICE_SQL = f"""
WITH v AS (SELECT l_orderkey, l_linenumber,
  {_category_sql(_subindex_sql('round(l_extendedprice / 191, 2)', 'continuous'))} AS category FROM lineitem)
SELECT l_orderkey, l_linenumber, category, {_advice_sql('category')} FROM v
"""


@query("advisory", _ADVICE_SQL)
def advisory(spark, sf):
    """FN-24: category -> ordered advisory list (joined with ' | ' for the oracle)."""
    v = _conc(spark, sf).select("l_orderkey", "l_linenumber", B.category(B.subindex("c")).alias("category"))
    adv = B.advisories("category")
    return v.select("l_orderkey", "l_linenumber", "category", F.array_join(adv, " | ").alias("advice"),
                    F.size(adv).alias("advice_count"))


_KEYS = ["pm25", "pm10", "no2", "co"]

_VALID_SQL = EV + """
SELECT entity, day,
  concat_ws(',', CASE WHEN pm25 IS NULL THEN 'missing_key:pm25' END, CASE WHEN pm10 IS NULL THEN 'missing_key:pm10' END,
    CASE WHEN no2 IS NULL THEN 'missing_key:no2' END, CASE WHEN co IS NULL THEN 'missing_key:co' END) AS errors,
  CAST((pm25 IS NULL)::INT + (pm10 IS NULL)::INT + (no2 IS NULL)::INT + (co IS NULL)::INT AS INTEGER) AS n_errors
FROM p
"""


@query("record_validation", _VALID_SQL)
def record_validation(spark, sf):
    """VAL-07 on serving requests: every rule evaluated, failures listed per record."""
    r = S.requests(spark, sf)
    errs = V.request_errors(
        F.col("city"), F.col("date"), F.col("pollutants"), _KEYS, F.col("aqi_history"),
        {c: F.col(c) for c in ("pm25_yesterday", "pm25_3days_ago", "pm10_yesterday", "co_yesterday")},
    )
    return r.select("entity", "day", F.array_join(errs, ",").alias("errors"), F.size(errs).alias("n_errors"))


_HIST_SQL = EV + """
SELECT entity, day,
  round(lag(aqi, 1) OVER w, 6) AS AQI_lag_1, round(lag(aqi, 2) OVER w, 6) AS AQI_lag_2,
  round(lag(aqi, 3) OVER w, 6) AS AQI_lag_3, round(lag(aqi, 7) OVER w, 6) AS AQI_lag_7,
  round(avg(aqi) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS AQI_roll_mean_3,
  round(avg(aqi) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS AQI_roll_mean_7,
  round(stddev_samp(aqi) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS AQI_roll_std_7,
  round(max(aqi) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS AQI_roll_max_7,
  round(min(aqi) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS AQI_roll_min_7
FROM p WINDOW w AS (PARTITION BY entity ORDER BY day)
"""


@query("array_history_features", _HIST_SQL)
def array_history_features(spark, sf):
    """FN-12/13: lag and rolling features from the request's 7-value history array; the
    oracle computes the same numbers with window functions on the panel."""
    r = S.requests(spark, sf)
    feats = {**A.history_lags("aqi_history"), **A.history_features("aqi_history")}
    return round_doubles(r.select("entity", "day", *[c.alias(n) for n, c in feats.items()]))


_JSON_SQL = """
SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum,
  CAST(max(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_max
FROM events GROUP BY event_type
"""


@query("json_docs", _JSON_SQL)
def json_docs(spark, sf):
    """FN-26: decode JSON documents with an explicit schema and aggregate a field."""
    ev = table(spark, sf, "events").select("event_type", "props")
    k = F.from_json("props", "k long")["k"]
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("k_sum"), F.max(k).alias("k_max"))


_PRICE_SQL = """
WITH e AS (SELECT DISTINCT p_retailprice AS lo FROM part),
b AS (SELECT lo, lead(lo) OVER (ORDER BY lo) AS hi FROM e),
v AS (SELECT l_orderkey, l_linenumber, round(880 + l_extendedprice % 140, 2) AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, v, (SELECT min(lo) FROM b WHERE v.v >= lo AND (hi IS NULL OR v.v <= hi)) AS band FROM v
"""


@query("price_band_join", _PRICE_SQL)
def price_band_join(spark, sf):
    """JOIN-04 with as many bands as there are part prices, the last one open: each line's price in its band."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(880 + F.col("l_extendedprice") % 140, 2).alias("v"))
    prices = table(spark, sf, "part").select(F.col("p_retailprice").alias("band")).distinct()
    edges = global_rank(prices, [F.col("band").asc()], "at")
    after = edges.select((F.col("at") - 1).alias("at"), F.col("band").alias("hi"))
    bands = edges.join(after, "at", "left").withColumn("lo", F.col("band"))
    return range_lookup(li, F.col("v"), bands, "lo", "hi", ["band"])


_KEYWORD_SQL = """
WITH n AS (SELECT p_partkey, p_name || ' ' || p_type AS name FROM part),
w AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS k FROM part UNION SELECT DISTINCT p_name FROM part WHERE p_name LIKE 'hot%'
  UNION SELECT DISTINCT p_type FROM part WHERE p_type LIKE '%O%'),
r AS (SELECT n.name, max_by(length(k), length(k)) AS s FROM (SELECT DISTINCT name FROM n) n JOIN w ON contains(n.name, k) GROUP BY n.name)
SELECT p_partkey, n.name, coalesce(CAST(s AS DOUBLE), 0.4) AS interpretability FROM n LEFT JOIN r ON n.name = r.name
"""


@query("keyword_rules", _KEYWORD_SQL)
def keyword_rules(spark, sf):
    """JOIN-05 with rules as data: the longest rule contained in each part's name; here a rule scores its length."""
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    words = [F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)), F.when(F.col("p_name").startswith("hot"), F.col("p_name")), F.when(F.col("p_type").contains("O"), F.col("p_type"))]
    rules = p.select(F.explode(F.array(*words)).alias("keyword")).where("keyword is not null").distinct().withColumn("score", F.length("keyword").cast("double"))
    named = p.select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("name"))
    return interpretability_join(named, "name", rules)
