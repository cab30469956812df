"""Standardisation fitted on the training rows only (SCL-01..03).

Parameters are the mean and the *population* standard deviation of each column
(Spark ML's ``StandardScaler`` uses the sample std, so it is not used here); a
constant column gets scale 1. Fitting is one aggregation pass; the parameters
(2 scalars per column) are applied as literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def fit_scaler(train: DataFrame, cols: list[str]) -> dict[str, tuple[float | None, float]]:
    """SCL-01 fit: column -> (mean, scale)."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(_c(c)).alias(f"m{i}"), F.stddev_pop(_c(c)).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    out = {}
    for i, c in enumerate(cols):
        s = row[f"s{i}"]
        out[c] = (row[f"m{i}"], 1.0 if s is None or s == 0 else s)
    return out


def scaler_table(spark: SparkSession, params: dict[str, tuple]) -> DataFrame:
    """SCL-03: the fitted parameters as a table (persist with the model)."""
    return spark.createDataFrame([(c, m, s) for c, (m, s) in params.items()], "feature string, mean double, scale double")


def apply_scaler(df: DataFrame, params: dict[str, tuple], suffix: str = "") -> DataFrame:
    """SCL-01/02 apply: ``(x - mean) / scale`` for exactly the fitted columns.
    With ``suffix`` the scaled values are added as new columns instead of replacing."""
    exprs = {}
    for c, (m, s) in params.items():
        if c not in df.columns:
            continue
        exprs[f"{c}{suffix}"] = (_c(c) - F.lit(m)) / F.lit(s) if m is not None else F.lit(None).cast("double")
    return df.withColumns(exprs)


def params_from_table(tbl: DataFrame) -> dict[str, tuple]:
    """Load parameters saved with :func:`scaler_table` (bounded: one row per feature)."""
    return {r["feature"]: (r["mean"], r["scale"]) for r in tbl.collect()}
