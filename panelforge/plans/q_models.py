"""Catalogue: Spark ML training, importances and batch scoring (M5/M7, rows-only checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explain as X
from ..operators import models as MD
from ..operators import windows as W
from ..sources.tables import li_panel
from ..spec import LI_PANEL
from .prepare import LI_OPTS, prepared_li
from .registry import query
from .serve import ServingArtefacts, score_requests


#: A day's quantity of a nation that no request may exceed.
LI_HISTORY_MAX = 1e6


def _prepared(spark, sf):
    return prepared_li(spark, sf, impute="knn")


def _registry():
    return {m.name: m for m in MD.default_registry()}


def _train(name, spark, sf):
    p = _prepared(spark, sf)
    return MD.train_one(_registry()[name], p.data, LI_PANEL.target, p.features, p.scaled_features), p


def _metrics_query(name):
    def run(spark, sf):
        res, _ = _train(name, spark, sf)
        return res.metrics

    run.__doc__ = f"ML-08/AGG-15: fit {name} on the train split, metrics on all three splits."
    return run


for _q, _m in [("train_ols", "LinearRegression"), ("train_ridge", "Ridge"), ("train_lasso", "Lasso"),
               ("train_tree", "DecisionTree"), ("train_forest", "RandomForest"), ("train_gbt", "GradientBoosting")]:
    query(_q)(_metrics_query(_m))


@query("importances")
def importances(spark, sf):
    """EXP-02/03 + WIN-08: ranked importance tables of every registered model that has them."""
    p = _prepared(spark, sf)
    results = [MD.train_one(m, p.data, LI_PANEL.target, p.features, p.scaled_features) for m in _registry().values()]
    return X.training_importances(spark, results, p.features, p.scaled_features)


def li_requests(spark, sf):
    """Stand-in requests, one per row of the LI panel: today's channels, the previous 7
    targets and previous channel readings, as a serving client would send them."""
    p = li_panel(spark, sf)
    feats = [W.Feature(f"_h{k}", "lag", "q", k) for k in range(1, 8)]
    feats += [W.Feature(f"{c}_lag_{k}", "lag", c, k) for c, ks in LI_OPTS.channel_lags.items() for k in ks]
    p = W.add_window_features(p, "entity", ["day"], feats)
    chan = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).alias("v")) for c in LI_PANEL.channels])
    lags = F.array(*[F.struct(F.lit(f.name).alias("k"), F.col(f.name).alias("v")) for f in feats if not
                     f.name.startswith("_h")])
    return p.select(
        "entity", F.col("day").cast("string").alias("date"),
        F.map_from_entries(chan).alias("channels"),  # a channel without a reading is there, with NULL
        F.array(*[F.col(f"_h{k}") for k in range(7, 0, -1)]).alias("target_history"),
        F.map_from_entries(F.filter(lags, lambda e: e["v"].isNotNull())).alias("channel_lags"),
    )


@query("batch_scoring")
def batch_scoring(spark, sf):
    """SRV-01: score a table of requests with the OLS model and the fitted imputer/scaler."""
    res, p = _train("LinearRegression", spark, sf)
    art = ServingArtefacts(LI_PANEL, LI_OPTS, p, res.model, res.uses_scaled, res.name, history_max=LI_HISTORY_MAX)
    out = score_requests(li_requests(spark, sf), art, ["entity"])
    return out.select("entity", "date", "predicted", "category", F.array_join("advisories", " | ").alias("advice"),
                      "model_used", F.array_join("errors", ",").alias("errors"))
