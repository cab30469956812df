"""Catalogue: metrics, composite ranking, leaderboard and importance shares (M5/M6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import spec as S
from ..operators import explain as X
from ..operators import metrics as M
from ..operators import rank as R
from ..operators import split as SP
from ..operators.ordering import global_rank, topk_per_group
from ..sources import standins as ST
from ..sources.tables import li_panel, table
from ..spec import LI_CUTOFFS
from .q_windows import LI
from .registry import query, round_doubles

_SPLIT_CASE = ("CASE WHEN day <= DATE '1998-12-31' THEN 'train' WHEN day <= DATE '1999-12-31' THEN 'validation' "
               "WHEN day <= DATE '2001-08-01' THEN 'test' END")


def _closed_form(spark, sf):
    """Closed-form least-squares predictor of q from the month, fitted on the train split."""
    p = SP.chronological_split(li_panel(spark, sf), "day", LI_CUTOFFS).withColumn(
        "x", F.month("day").cast("double"))
    fit = p.where("split = 'train'").agg(F.regr_slope("q", "x").alias("b"), F.regr_intercept("q", "x").alias("a")).first()
    return p.withColumn("prediction", F.lit(fit["a"]) + F.lit(fit["b"]) * F.col("x")).withColumn(
        "model", F.lit("closed_form"))


_PRED_CTE = LI + f"""
, s AS (SELECT *, {_SPLIT_CASE} AS split, CAST(month(day) AS DOUBLE) AS x FROM p),
f AS (SELECT regr_slope(q, x) AS fb, regr_intercept(q, x) AS fa FROM s WHERE split = 'train'),
pr AS (SELECT s.*, fa + fb * x AS pred FROM s, f WHERE split IS NOT NULL)
"""

_METRICS_SQL = _PRED_CTE + """
SELECT 'closed_form' AS model, split, count(q) AS n,
  round(CASE WHEN var_pop(q) * count(q) > 0 THEN 1.0 - sum((q - pred) * (q - pred)) / (var_pop(q) * count(q)) END, 6) AS r2,
  round(avg(abs(q - pred)), 6) AS mae, round(sqrt(sum((q - pred) * (q - pred)) / count(q)), 6) AS rmse,
  round(avg(abs(q - pred) / greatest(abs(q), 1e-8)) * 100, 6) AS mape
FROM pr GROUP BY split
"""


@query("regression_metrics", _METRICS_SQL)
def regression_metrics(spark, sf):
    """AGG-15 on a closed-form predictor: R2 (1 - SSE/SST), MAE, RMSE, MAPE per split."""
    return M.regression_metrics(_closed_form(spark, sf), "q", "prediction")


_PRED_TABLE_SQL = _PRED_CTE + """
SELECT 'closed_form' AS model, split, entity, day, round(q, 6) AS Actual, round(pred, 6) AS Predicted,
  round(q - pred, 6) AS Residual, round(abs(q - pred), 6) AS Absolute_Error,
  CAST(row_number() OVER (PARTITION BY split ORDER BY entity, day) - 1 AS BIGINT) AS Index
FROM pr
"""


@query("prediction_table", _PRED_TABLE_SQL)
def prediction_table(spark, sf):
    """PRJ-08: residuals and the 0-based row index inside each split (entity, day order)."""
    return round_doubles(M.prediction_table(_closed_form(spark, sf), "q", "prediction", "entity", "day"))


_REC = f"rec AS ({ST.SUPPLIER_RECORDS_SQL})"

_MINMAX_SQL = f"""
WITH {_REC}, b AS (SELECT s_nationkey, min(revenue) AS l1, max(revenue) AS h1, min(avg_qty) AS l2, max(avg_qty) AS h2,
  min(rmse) AS l3, max(rmse) AS h3 FROM rec GROUP BY s_nationkey)
SELECT s_suppkey,
  round(CASE WHEN revenue IS NULL THEN NULL WHEN h1 = l1 THEN 0.5 ELSE (revenue - l1) / (h1 - l1) END, 6) AS norm_revenue,
  round(CASE WHEN avg_qty IS NULL THEN NULL WHEN h2 = l2 THEN 0.5 ELSE (h2 - avg_qty) / (h2 - l2) END, 6) AS norm_avg_qty,
  round(CASE WHEN rmse IS NULL THEN NULL WHEN h3 = l3 THEN 0.5 ELSE (h3 - rmse) / (h3 - l3) END, 6) AS norm_rmse
FROM rec JOIN b USING (s_nationkey)
"""


def _records(spark, sf):
    return ST.supplier_records(spark, sf).withColumnRenamed("validation_rmse", "rmse")


@query("minmax_cohort", _MINMAX_SQL)
def minmax_cohort(spark, sf):
    """WIN-09: direction-aware min-max normalisation of supplier measures within each nation."""
    r = _records(spark, sf)
    out = R.minmax_normalise(r, {"revenue": True, "avg_qty": False, "rmse": False}, cohort=["s_nationkey"])
    return round_doubles(out.select("s_suppkey", "norm_revenue", "norm_avg_qty", "norm_rmse"))


_COMPOSITE_SQL = f"""
WITH {_REC}, b AS (SELECT min(revenue) AS l1, max(revenue) AS h1, min(avg_qty) AS l2, max(avg_qty) AS h2,
  min(rmse) AS l3, max(rmse) AS h3 FROM rec),
s AS (SELECT s_suppkey, round(0.5 * CASE WHEN revenue IS NULL THEN NULL WHEN h1 = l1 THEN 0.5 ELSE (revenue - l1) / (h1 - l1) END
  + 0.2 * CASE WHEN avg_qty IS NULL THEN NULL WHEN h2 = l2 THEN 0.5 ELSE (h2 - avg_qty) / (h2 - l2) END
  + 0.3 * CASE WHEN rmse IS NULL THEN NULL WHEN h3 = l3 THEN 0.5 ELSE (h3 - rmse) / (h3 - l3) END, 6) AS score FROM rec, b)
SELECT s_suppkey, score, CAST(row_number() OVER (ORDER BY score DESC NULLS LAST, s_suppkey) AS BIGINT) AS rank FROM s
"""


@query("composite_rank", _COMPOSITE_SQL)
def composite_rank(spark, sf):
    """LB-01 general form + WIN-07: weighted composite of normalised supplier measures,
    ranked 1..n by a distributed global rank."""
    r = _records(spark, sf)
    sc = R.composite_score(r, {"revenue": 0.5, "avg_qty": 0.2, "rmse": 0.3},
                           {"revenue": True, "avg_qty": False, "rmse": False})
    ranked = global_rank(sc, [F.col("score").desc_nulls_last(), F.col("s_suppkey").asc()])
    return ranked.select("s_suppkey", "score", "rank")


def _interp_sql(col: str) -> str:
    rules = sorted(S.INTERPRETABILITY_RULES, key=lambda kv: len(kv[0]), reverse=True)
    whens = " ".join(f"WHEN contains({col}, '{k}') THEN {v}" for k, v in rules)
    return f"CAST(CASE {whens} ELSE {S.INTERPRETABILITY_DEFAULT} END AS DOUBLE)"


_LB_CTE = f"""
WITH {_REC},
ev AS (SELECT *, train_r2 - validation_r2 AS gap,
  CASE WHEN train_r2 - validation_r2 IS NULL THEN NULL ELSE greatest(train_r2 - validation_r2, 0.0) END AS gapc,
  {_interp_sql('model')} AS interp FROM rec),
b AS (SELECT min(validation_r2) AS l1, max(validation_r2) AS h1, min(rmse) AS l2, max(rmse) AS h2, min(gapc) AS l3,
  max(gapc) AS h3, min(val_pred_time_s) AS l4, max(val_pred_time_s) AS h4, min(train_time_s) AS l5,
  max(train_time_s) AS h5 FROM ev),
n AS (SELECT ev.*,
  CASE WHEN validation_r2 IS NULL THEN NULL WHEN h1 = l1 THEN 0.5 ELSE (validation_r2 - l1) / (h1 - l1) END AS n1,
  CASE WHEN rmse IS NULL THEN NULL WHEN h2 = l2 THEN 0.5 ELSE (h2 - rmse) / (h2 - l2) END AS n2,
  CASE WHEN gapc IS NULL THEN NULL WHEN h3 = l3 THEN 0.5 ELSE (h3 - gapc) / (h3 - l3) END AS n3,
  CASE WHEN val_pred_time_s IS NULL THEN NULL WHEN h4 = l4 THEN 0.5 ELSE (h4 - val_pred_time_s) / (h4 - l4) END AS n4,
  CASE WHEN train_time_s IS NULL THEN NULL WHEN h5 = l5 THEN 0.5 ELSE (h5 - train_time_s) / (h5 - l5) END AS n5
  FROM ev, b),
s AS (SELECT *, round(0.35 * n1 + 0.25 * n2 + 0.15 * n3 + 0.1 * n4 + 0.05 * n5 + 0.1 * interp, 6) AS engineering_score FROM n),
lb AS (SELECT *,
  CASE WHEN validation_r2 IS NULL THEN 'Experimental'
       WHEN validation_r2 >= 0.85 AND (gap IS NULL OR gap <= 0.1) THEN 'Production Ready'
       WHEN validation_r2 >= 0.85 THEN 'Needs Optimization' WHEN validation_r2 >= 0.6 THEN 'Needs Optimization'
       ELSE 'Experimental' END AS deployment_status,
  coalesce(nullif(concat_ws(' | ', CASE WHEN gap > 0.1 THEN 'Potential Overfitting' END,
    CASE WHEN val_pred_time_s > 1.0 THEN 'Slow Prediction' END, CASE WHEN train_time_s > 300 THEN 'Slow Training' END,
    CASE WHEN validation_r2 < 0.7 THEN 'Weak Validation Performance' END,
    CASE WHEN gap > 0.1 THEN 'High Generalisation Gap' END, CASE WHEN rmse > 50 THEN 'Large Error' END), ''), 'None')
    AS risk_flags,
  CAST(row_number() OVER (ORDER BY engineering_score DESC NULLS LAST, model) AS BIGINT) AS rank FROM s)
"""


def _supplier_leaderboard(spark, sf):
    r = ST.supplier_records(spark, sf)
    return R.leaderboard(r.drop("s_suppkey", "s_nationkey", "revenue", "avg_qty"))


@query("tiers_and_flags", _LB_CTE + "SELECT model, engineering_score, deployment_status, risk_flags, rank FROM lb")
def tiers_and_flags(spark, sf):
    """LB-01..04 + LB-06 on per-supplier metric records: composite score, tier, flags, rank."""
    lb = _supplier_leaderboard(spark, sf)
    return lb.select("model", "engineering_score", "deployment_status", "risk_flags", "rank")


_RECO_SQL = _LB_CTE + """
SELECT (SELECT model FROM lb WHERE rank = 1) AS recommended_model,
  coalesce((SELECT model FROM lb WHERE rank = 2), 'N/A') AS runner_up,
  (SELECT model FROM lb WHERE val_pred_time_s IS NOT NULL ORDER BY val_pred_time_s, rank LIMIT 1) AS fastest_prediction,
  (SELECT model FROM lb WHERE validation_r2 IS NOT NULL ORDER BY validation_r2 DESC, rank LIMIT 1) AS most_accurate,
  (SELECT model FROM lb ORDER BY interp DESC, rank LIMIT 1) AS most_interpretable,
  (SELECT count(*) FROM lb) AS models,
  (SELECT count(*) FROM lb WHERE trim(deployment_status) = 'Production Ready') AS ready
"""


@query("recommendation", _RECO_SQL)
def recommendation(spark, sf):
    """LB-07/08: winner, runner-up, fastest, most accurate, most interpretable, counts."""
    rec = R.recommendation(_supplier_leaderboard(spark, sf))
    return rec.select("recommended_model", "runner_up", "fastest_prediction", "most_accurate", "most_interpretable",
                      "models", "ready")


def _line_sql(metric: str, col: str) -> str:
    cuts, words = S.ASSESSMENT_BANDS[metric]
    whens = " ".join(f"WHEN {col} >= {c} THEN '{w}'" for c, w in zip(cuts, words, strict=False))
    return f"CASE WHEN {col} IS NOT NULL THEN '{metric} ' || printf('%.4f', {col}) || ' (' || CASE {whens} ELSE '{words[-1]}' END || ')' END"


_LINES = {"validation R2": "validation_r2", "train-validation gap": "gap", "prediction time": "val_pred_time_s", "interpretability": "interp", "RMSE": "rmse"}

_LEADERBOARD_SQL = _LB_CTE + f"""
SELECT rank, model, round(validation_r2, 6) AS validation_r2, round(test_r2, 6) AS test_r2, round(mae, 6) AS mae, round(rmse, 6) AS rmse,
  round(mape, 6) AS mape, train_time_s, round(val_pred_time_s, 6) AS val_pred_time_s, round(gap, 6) AS generalization_gap,
  engineering_score, deployment_status, risk_flags,
  concat_ws('; ', {", ".join(_line_sql(m, c) for m, c in _LINES.items())}, 'status ' || deployment_status) AS ai_comment
FROM lb
"""


@query("leaderboard", _LEADERBOARD_SQL)
def leaderboard(spark, sf):
    """LB-06 + SNK-04: the exported leaderboard columns incl. the generated comment."""
    return round_doubles(R.export_view(_supplier_leaderboard(spark, sf)))


_REASONS_SQL = _LB_CTE + f"""
SELECT model, concat_ws('; ', 'score ' || printf('%.4f', engineering_score), {", ".join(_line_sql(m, c) for m, c in list(_LINES.items())[:4])},
    'status ' || deployment_status) AS reasons,
  (SELECT string_agg(model, ',' ORDER BY model) FROM lb WHERE trim(deployment_status) = 'Production Ready') AS ready_models
FROM lb WHERE rank = 1
"""


@query("recommendation_reasons", _REASONS_SQL)
def recommendation_reasons(spark, sf):
    """LB-07/08: why the winner is recommended, and the production-ready models (NULL if there are none)."""
    rec = R.recommendation(_supplier_leaderboard(spark, sf))
    ready = F.array_join("ready_models", ",")
    return rec.select(F.col("recommended_model").alias("model"), F.array_join("reasons", "; ").alias("reasons"), F.when(ready != "", ready).alias("ready_models"))


_METADATA_SQL = _LB_CTE + """
, m AS (SELECT s_name AS model, count(*) AS n, CAST(max(l_shipdate) AS DATE) AS t, count(DISTINCT l_partkey) AS f
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0 GROUP BY s_name)
SELECT lb.rank, lb.model, coalesce(strftime(m.t, '%Y-%m-%d'), 'N/A') AS trained_at, coalesce(CAST(m.f AS VARCHAR), 'N/A') AS n_features,
  coalesce(CAST(m.n AS VARCHAR), 'N/A') AS training_rows, coalesce('rows=' || CAST(m.n AS VARCHAR), '') AS hyperparameters
FROM lb LEFT JOIN m ON lb.model = m.model
"""


@query("leaderboard_metadata", _METADATA_SQL)
def leaderboard_metadata(spark, sf):
    """SNK-03 -> SRC-05 -> JOIN-02: a metadata document per supplier (those with a positive balance), written, scanned and looked up
    beside the leaderboard; models without a document get the defaults."""
    from ..sources import files as IO
    from ..streaming.pipeline import scratch

    li = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate")
    s = table(spark, sf, "supplier").where("s_acctbal > 0").select("s_suppkey", F.col("s_name").alias("model_name"))
    docs = li.join(s, li.l_suppkey == s.s_suppkey).groupBy("s_suppkey", "model_name").agg(
        F.date_format(F.max(F.col("l_shipdate").cast("date")), "yyyy-MM-dd").alias("timestamp"), F.countDistinct("l_partkey").cast("int").alias("n_features"),
        F.count(F.lit(1)).cast("int").alias("training_rows"))
    docs = docs.withColumn("hyperparameters", F.create_map(F.lit("rows"), F.col("training_rows").cast("string")))
    out = scratch(spark, "metadata")
    IO.write_table(docs.withColumnRenamed("s_suppkey", "part"), out, "json", file_per="part")
    found = IO.read_json_records(spark, out, IO.METADATA_SCHEMA, ".json", key="model_name")
    lb = R.with_metadata(_supplier_leaderboard(spark, sf), found)
    shown = F.array_join(F.transform(F.map_entries("hyperparameters"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return lb.select("rank", "model", "trained_at", "n_features", "training_rows", shown.alias("hyperparameters"))


def _customer_revenue(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    per = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("revenue"))
    return per.join(c, per.o_custkey == c.c_custkey).select("c_nationkey", "c_name", "revenue")


_REV_CTE = """
WITH r AS (SELECT c_nationkey, c_name, sum(o_totalprice) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY c_nationkey, c_name),
t AS (SELECT c_nationkey, sum(revenue) AS tot FROM r GROUP BY c_nationkey),
s AS (SELECT r.*, CASE WHEN tot > 0 THEN round(revenue / tot * 100, 4) ELSE 0.0 END AS importance_pct,
  row_number() OVER (PARTITION BY r.c_nationkey ORDER BY revenue DESC NULLS LAST, c_name) AS rank
  FROM r JOIN t ON r.c_nationkey = t.c_nationkey),
c AS (SELECT *, round(sum(importance_pct) OVER (PARTITION BY c_nationkey ORDER BY rank
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS cumulative_pct FROM s)
"""


@query("importance_share", _REV_CTE + """
SELECT c_nationkey, c_name, round(revenue, 6) AS revenue, CAST(rank AS BIGINT) AS rank, importance_pct, cumulative_pct
FROM c""")
def importance_share(spark, sf):
    """WIN-07/08: customers' share of their nation's revenue, rank, cumulative share."""
    out = X.share_table(_customer_revenue(spark, sf), "c_name", "revenue", ["c_nationkey"])
    return round_doubles(out.select("c_nationkey", "c_name", "revenue", "rank", "importance_pct", "cumulative_pct"))


@query("pareto_count", _REV_CTE + """
SELECT c_nationkey, count(*) AS n, CAST(least(count_if(cumulative_pct <= 80.0) + 1, count(*)) AS BIGINT) AS n_for_80,
  CAST(least(count_if(cumulative_pct <= 95.0) + 1, count(*)) AS BIGINT) AS n_for_95 FROM c GROUP BY c_nationkey""")
def pareto_count(spark, sf):
    """SRT-05: customers needed per nation to reach 80 % / 95 % of revenue."""
    shares = X.share_table(_customer_revenue(spark, sf), "c_name", "revenue", ["c_nationkey"])
    return X.pareto_counts(shares, ["c_nationkey"])


_KW = ["bolt", "GEAR", "promo"]

_KW_SQL = """
WITH r AS (SELECT p_name || ' ' || p_type || ' #' || CAST(p_partkey AS VARCHAR) AS item, sum(l_extendedprice) AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
s AS (SELECT item, round(revenue / (SELECT sum(revenue) FROM r) * 100, 4) AS importance_pct,
  row_number() OVER (ORDER BY revenue DESC NULLS LAST, item) AS orig_rank FROM r)
SELECT item, CAST(orig_rank AS BIGINT) AS orig_rank, CAST(row_number() OVER (ORDER BY orig_rank) AS BIGINT) AS rank,
  importance_pct FROM s
WHERE contains(lower(item), 'bolt') OR contains(lower(item), 'gear') OR contains(lower(item), 'promo')
"""


@query("keyword_subset", _KW_SQL)
def keyword_subset(spark, sf):
    """FLT-04/EXP-05: items whose name contains any keyword (case-insensitive), re-ranked."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice")
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    rev = li.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("revenue"))
    items = rev.join(p, rev.l_partkey == p.p_partkey).select(
        F.concat_ws(" ", "p_name", "p_type", F.concat(F.lit("#"), F.col("p_partkey").cast("string"))).alias("item"),
        "revenue")
    shares = X.share_table(items, "item", "revenue")
    sub = X.keyword_subset(shares, "item", _KW)
    return round_doubles(sub.select("item", "orig_rank", "rank", "importance_pct"))


@query("topk_per_group", """
WITH r AS (SELECT c_nationkey, c_name, sum(o_totalprice) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY c_nationkey, c_name)
SELECT c_nationkey, c_name, round(revenue, 6) AS revenue, CAST(pos AS INTEGER) AS pos FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY revenue DESC, c_name) AS pos FROM r) WHERE pos <= 3
""")
def topk_per_group_q(spark, sf):
    """SRT-04: top 3 customers by revenue per nation (salted two-phase top-k)."""
    r = _customer_revenue(spark, sf)
    out = topk_per_group(r, ["c_nationkey"], [F.col("revenue").desc(), F.col("c_name")], 3,
                         salt_key=F.col("c_name"), name="pos")
    return round_doubles(out.select("c_nationkey", "c_name", "revenue", "pos"))


@query("latest_per_entity", """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, round(o_totalprice, 6) AS o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
) WHERE rn = 1
""")
def latest_per_entity(spark, sf):
    """SNK-09: latest record per key as one aggregate (max_by over (time, key))."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("d"),
                                          "o_totalprice")
    g = o.groupBy("o_custkey").agg(
        F.max_by(F.struct("o_orderkey", "d", "o_totalprice"), F.struct("d", "o_orderkey")).alias("_l"))
    return round_doubles(g.select("o_custkey", "_l.o_orderkey", F.col("_l.d").alias("o_orderdate"),
                                  "_l.o_totalprice"))


_FILES_SQL = f"""
WITH {_REC}
SELECT model, round(train_r2, 6) AS train_r2, round(validation_r2, 6) AS validation_r2, round(test_r2, 6) AS test_r2,
  round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(train_time_s, 6) AS train_time_s
FROM rec
"""


@query("metrics_files", _FILES_SQL)
def metrics_files(spark, sf):
    """SNK-03 -> SRC-04: per-supplier metric records written as one JSON object per file
    (a file per model), read back with the schema-checked JSON reader that
    skips malformed files, and flattened (PRJ-07)."""
    from ..sources import files as IO
    from ..streaming.pipeline import scratch

    out = scratch(spark, "metrics")
    recs = ST.supplier_records(spark, sf).select(
        F.col("model").alias("model_name"), "uses_scaled", "train_time_s", "train_r2", "validation_r2", "test_r2",
        "validation_mae", "validation_rmse", "validation_mape", "validation_pred_time",
        F.col("s_suppkey").alias("part"))
    IO.write_table(recs, out, "json", file_per="part")
    got = IO.read_json_records(spark, out, IO.METRICS_SCHEMA, ".json", key="model_name")
    ev = R.evaluation_rows(got.withColumnRenamed("model_name", "model"))
    return round_doubles(ev.select("model", "train_r2", "validation_r2", "test_r2", "mae", "rmse", "train_time_s"))
