"""Importance shares (38-row golden), Pareto, keyword subset, leaderboard rules, ranking helpers."""

import csv
import os

from pyspark.sql import functions as F

from panelforge.operators import explain as X
from panelforge.operators import rank as R
from panelforge.operators.ordering import global_rank, topk_per_group

GOLDEN = os.path.join(os.path.dirname(__file__), "golden", "importance_38.csv")


def _golden():
    with open(GOLDEN) as f:
        return list(csv.DictReader(f))


def test_importance_golden(spark):
    g = _golden()
    df = spark.createDataFrame([(r["feature"], float(r["coefficient"])) for r in g], "feature string, coefficient double")
    out = X.share_table(df, "feature", "coefficient", use_abs=True).orderBy("rank").collect()
    assert [r.feature for r in out] == [r["feature"] for r in g]
    assert [r.importance_pct for r in out] == [float(r["importance_pct"]) for r in g]
    assert [r.cumulative_pct for r in out] == [float(r["cumulative_pct"]) for r in g]
    shares = X.share_table(df, "feature", "coefficient", use_abs=True)
    par = X.pareto_counts(shares).first()
    assert (par.n_for_80, par.n_for_95) == (6, 13)
    sub = X.keyword_subset(shares, "feature")
    s = X.subset_share(sub).first()
    assert s["items"] == 16 and round(s.share_pct, 3) == 12.598
    assert sorted(r.rank for r in sub.collect()) == list(range(1, 17))
    sign = X.sign_counts(df, "coefficient").first()
    assert (sign.positive, sign.negative) == (21, 17)


def test_leaderboard_rules(spark):
    recs = spark.createDataFrame([
        ("LinearRegression", 0.99, 0.95, 0.9, 2.0, 5.0, 1.0, 0.5, 0.001),
        ("RandomForest", 0.99, 0.80, 0.8, 3.0, 20.0, 2.0, 400.0, 2.0),
        ("Mystery", None, 0.90, 0.9, 1.0, 60.0, 1.0, 1.0, 0.01),
        ("Ridge", 0.95, 0.95, 0.9, 2.0, 5.0, 1.0, 0.5, 0.001),
    ], "model string, train_r2 double, validation_r2 double, test_r2 double, validation_mae double, "
       "validation_rmse double, validation_mape double, train_time_s double, validation_pred_time double")
    lb = {r.model: r for r in R.leaderboard(recs).collect()}
    assert lb["LinearRegression"].deployment_status == "Production Ready"
    assert lb["RandomForest"].deployment_status == "Needs Optimization"
    assert lb["RandomForest"].risk_flags == ("Potential Overfitting | Slow Prediction | Slow Training | "
                                             "High Generalisation Gap")
    assert lb["Mystery"].generalization_gap is None and lb["Mystery"].engineering_score is None
    assert lb["Mystery"].risk_flags == "Large Error"
    assert lb["Mystery"].interpretability == 0.40 and lb["Ridge"].interpretability == 0.95
    assert sorted(r.rank for r in lb.values()) == [1, 2, 3, 4]
    assert lb["Mystery"].rank == 4  # NULL score sorts last
    rec = R.recommendation(R.leaderboard(recs)).first()
    winner = min(lb.values(), key=lambda r: r.rank).model
    assert rec.recommended_model == winner == "Ridge"  # smaller gap outweighs the interpretability prior
    assert rec.most_interpretable == "LinearRegression"
    # R2 and prediction time tie between Ridge and LinearRegression: the better rank wins
    assert rec.most_accurate == "Ridge" and rec.fastest_prediction == "Ridge"
    assert rec.runner_up == "LinearRegression" and rec.models == 4
    assert rec.ready == 3  # a NULL gap with R2 >= 0.85 counts as ready (reference rule)



def test_global_rank_ties_and_groups(spark):
    rows = [(g, f"n{i:03d}", float(i % 3)) for g in ("a", "b") for i in range(50)]
    df = spark.createDataFrame(rows, "g string, name string, v double")
    out = global_rank(df, [F.col("v").desc(), F.col("name")], group=["g"], partitions=7).collect()
    for g in ("a", "b"):
        got = sorted((r.rank, r.name) for r in out if r.g == g)
        ref = sorted(((-v, n) for (gg, n, v) in rows if gg == g))
        assert [n for _, n in got] == [n for _, n in ref]
        assert [r for r, _ in got] == list(range(1, 51))
    top = topk_per_group(df, ["g"], [F.col("v").desc(), F.col("name")], 3, salts=5).orderBy("g", "rank").collect()
    assert [r.name for r in top] == ["n002", "n005", "n008"] * 2
