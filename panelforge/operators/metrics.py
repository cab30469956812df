"""Regression metrics and prediction tables (AGG-15, PRJ-08, SET-05).

All metrics are algebraic aggregates (sums, counts, a mergeable variance), so a
``groupBy(model, split)`` combines partial states map-side: a split holding a
third of all rows is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAPE_EPS = 1e-8


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def regression_metrics(df: DataFrame, label: str, prediction: str, by=("model", "split"),
                       digits: int = 6, eps: float = MAPE_EPS) -> DataFrame:
    """R2 = 1 - SSE/SST (NULL when SST = 0, i.e. a constant target), MAE, RMSE and
    MAPE % with a ``max(|y|, eps)`` denominator, per group, rounded."""
    y, p = _c(label), _c(prediction)
    err = y - p
    g = df.groupBy(*by).agg(
        F.count(y).alias("n"),
        F.sum(err * err).alias("_sse"),
        (F.var_pop(y) * F.count(y)).alias("_sst"),
        F.avg(F.abs(err)).alias("_mae"),
        F.avg(F.abs(err) / F.greatest(F.abs(y), F.lit(eps))).alias("_mape"),
    )
    return g.select(
        *by, "n",
        F.round(F.when(F.col("_sst") > 0, F.lit(1.0) - F.col("_sse") / F.col("_sst")), digits).alias("r2"),
        F.round("_mae", digits).alias("mae"),
        F.round(F.sqrt(F.col("_sse") / F.col("n")), digits).alias("rmse"),
        F.round(F.col("_mape") * 100, digits).alias("mape"),
    )


def ordered_position(df: DataFrame, group: list[str], entity: str, time: str, name: str = "Index") -> DataFrame:
    """0-based contiguous position of each row inside ``group`` ordered by (entity, time), NULLs last.

    One range sort over (group, entity, time): no group, entity or block of equal times is gathered into one task.
    """
    from .ordering import global_rank

    keyed = df.withColumn("_t", F.monotonically_increasing_id())
    ranked = global_rank(keyed, [_c(entity).asc_nulls_last(), _c(time).asc_nulls_last(), F.col("_t")], "_r", group)
    return ranked.withColumn(name, F.col("_r") - 1).drop("_r", "_t")


def prediction_table(scored: DataFrame, label: str, prediction: str, entity: str, time: str,
                     by=("model", "split")) -> DataFrame:
    """PRJ-08: actual, predicted, residual, absolute error and the 0-based row index
    inside (model, split) ordered by (entity, time)."""
    out = scored.select(
        *by, entity, time,
        _c(label).alias("Actual"), _c(prediction).alias("Predicted"),
        (_c(label) - _c(prediction)).alias("Residual"),
        F.abs(_c(label) - _c(prediction)).alias("Absolute_Error"),
    )
    return ordered_position(out, list(by), entity, time)
