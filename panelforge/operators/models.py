"""Spark ML regressors, the model registry and the training loop (ML-01..11, EXP-01..04, VAL-09).

Every fit is a distributed Spark ML job over the materialised model-ready table
(the tree learners cache their binned input themselves); the driver only loops
over the (short) registry. Linear models on <= 4096 features
solve the normal equations from one ``treeAggregate`` of X'X; trees and
ensembles use Spark's distributed histogram training.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forest import BinnedForest
from .metrics import regression_metrics
from .split import SPLITS

SEED = 42


@dataclass
class ModelSpec:
    name: str
    factory: Callable[[DataFrame, str], object]  # (train frame, label) -> estimator
    uses_scaled: bool


def _ols(train, label):
    return LinearRegression(regParam=0.0, elasticNetParam=0.0, standardization=False, solver="normal")


def _ridge(alpha: float = 1.0):
    def make(train, label):
        # closed-form ridge ||y - Xb||^2 + alpha ||b||^2 on already-scaled features: Spark's
        # objective scales the penalty by n and by the label's std, so map alpha accordingly
        row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
        n, s = row["n"], row["s"] or 1.0
        return LinearRegression(regParam=alpha / n * s, elasticNetParam=0.0, standardization=False, solver="normal")

    return make


def _lasso(alpha: float = 0.1, max_iter: int = 5000):
    def make(train, label):
        return LinearRegression(regParam=alpha, elasticNetParam=1.0, standardization=False, maxIter=max_iter,
                                tol=1e-6)

    return make


def _tree(train, label):
    return DecisionTreeRegressor(maxDepth=10, minInstancesPerNode=5, seed=SEED, maxBins=64)


def _forest(num_trees: int = 300, max_depth: int = 30):
    def make(train, label):
        return BinnedForest(trees=num_trees, depth=max_depth, min_rows=3, max_bins=64, seed=SEED)

    return make


def _gbt(max_iter: int = 300, depth: int = 6):
    def make(train, label):
        return GBTRegressor(maxIter=max_iter, stepSize=0.05, maxDepth=depth, subsamplingRate=0.8, seed=SEED,
                            maxBins=64)

    return make


def default_registry() -> list[ModelSpec]:
    """ML-07: the preset model list (name, estimator factory, scaled-input flag)."""
    return [
        ModelSpec("LinearRegression", _ols, True),
        ModelSpec("Ridge", _ridge(1.0), True),
        ModelSpec("Lasso", _lasso(0.1, 5000), True),
        ModelSpec("DecisionTree", _tree, False),
        ModelSpec("RandomForest", _forest(300, 30), False),
        ModelSpec("GradientBoosting", _gbt(300, 6), False),
    ]


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """PRJ-02: numeric feature vector; NULLs are an error (impute first)."""
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error").transform(df)


def detect_family(model) -> str:
    """EXP-01."""
    if hasattr(model, "featureImportances"):
        return "tree"
    if hasattr(model, "coefficients"):
        return "linear"
    return "unsupported"


def importance_values(model, n_features: int) -> tuple[str, list[float]] | None:
    """EXP-02..04 + VAL-09: (family, raw values) or None when unsupported / wrong length."""
    fam = detect_family(model)
    if fam == "tree":
        vals = model.featureImportances.toArray().tolist()
    elif fam == "linear":
        vals = model.coefficients.toArray().tolist()
    else:
        return None
    if len(vals) != n_features:
        return None
    return fam, vals


def param_map(model) -> dict[str, str]:
    """ML-10: hyper-parameters as strings (non-scalar values JSON-encoded)."""
    out = {}
    for p, v in model.extractParamMap().items():
        out[p.name] = v if isinstance(v, str) else json.dumps(v) if isinstance(v, (list, dict)) else str(v)
    return out


@dataclass
class TrainResult:
    name: str
    model: object
    uses_scaled: bool
    train_time_s: float
    scored: DataFrame
    metrics: DataFrame
    metadata: dict
    pred_time_s: dict[str, float] = field(default_factory=dict)


def train_one(spec: ModelSpec, data: DataFrame, label: str, features: list[str], scaled_features: list[str],
              split_col: str = "split") -> TrainResult:
    """ML-08/09: fit on the train split, score every split once, compute metrics.

    Prediction is timed per split: one pass of the model over all rows of the split.
    """
    feats = scaled_features if spec.uses_scaled else features
    assembled = assemble(data, feats)
    train = assembled.where(F.col(split_col) == "train")
    est = spec.factory(train, label).setFeaturesCol("features").setLabelCol(label).setPredictionCol("prediction")
    t0 = time.perf_counter()
    model = est.fit(train)
    fit_s = time.perf_counter() - t0
    scored = model.transform(assembled).withColumn("model", F.lit(spec.name))
    metrics = regression_metrics(scored, label, "prediction", by=("model", split_col))
    times, rows = {}, {}
    for name in SPLITS:
        t0 = time.perf_counter()
        rows[name] = scored.where(F.col(split_col) == name).agg(F.count(F.lit(1)).alias("n"), F.sum("prediction")).first()["n"]
        times[name] = time.perf_counter() - t0
    meta = {
        "model_name": spec.name,
        "timestamp": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S"),
        "n_features": len(feats),
        "training_rows": rows["train"],
        "hyperparameters": param_map(model),
        "train_time_s": fit_s,
        "prediction_time_s": times["validation"],
        "random_state": SEED,
        "uses_scaled_data": spec.uses_scaled,
    }
    return TrainResult(spec.name, model, spec.uses_scaled, fit_s, scored, metrics, meta, times)


def train_all(registry: list[ModelSpec], data: DataFrame, label: str, features: list[str],
              scaled_features: list[str], split_col: str = "split") -> tuple[list[TrainResult], list[tuple[str, str]]]:
    """ML-08 loop: a failing model is recorded and skipped; the others continue."""
    done, failed = [], []
    for spec in registry:
        try:
            done.append(train_one(spec, data, label, features, scaled_features, split_col))
        except Exception as e:  # isolate failures per model
            failed.append((spec.name, str(e).splitlines()[0][:300]))
    return done, failed


def metrics_records(results: list[TrainResult], split_col: str = "split") -> DataFrame:
    """ML-11 / PRJ-07 input: one row per model with train/validation/test metrics (pivot of
    the per-split metric table) plus training time and the scaled flag."""
    if not results:
        raise ValueError("no trained models")
    m = results[0].metrics
    for r in results[1:]:
        m = m.unionByName(r.metrics)
    wide = m.groupBy("model").pivot(split_col, ["train", "validation", "test"]).agg(
        F.first("r2").alias("r2"), F.first("mae").alias("mae"), F.first("rmse").alias("rmse"),
        F.first("mape").alias("mape"),
    )
    spark = m.sparkSession
    info = spark.createDataFrame(
        [(r.name, r.uses_scaled, float(r.train_time_s), *[float(r.pred_time_s[x]) for x in SPLITS]) for r in results],
        "model string, uses_scaled boolean, train_time_s double, " + ", ".join(f"{x}_pred_time double" for x in SPLITS),
    )
    return wide.join(info, "model")


def metadata_records(spark, results: list[TrainResult]) -> DataFrame:
    """ML-10: one metadata row per trained model."""
    schema = ("model_name string, timestamp string, n_features int, training_rows int, hyperparameters map<string,string>, "
              "train_time_s double, prediction_time_s double, random_state int, uses_scaled_data boolean")
    names = [f.split()[0] for f in schema.replace("map<string,string>", "map").split(", ")]
    return spark.createDataFrame([tuple(r.metadata[n] for n in names) for r in results], schema)
