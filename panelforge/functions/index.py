"""Weighted composite index (FN-09 training form, FN-10 serving form, AGG-18).

Training form: each weighted channel is min-max scaled with bounds taken from a
whole table (one ``agg`` pass; the 2-scalars-per-channel result is applied as
literals, never through an unpartitioned window); a zero-variance channel contributes
0; a channel absent from the table is skipped; any NULL channel makes the index
NULL. Serving form: fixed bounds, clamp to [0, 1], NULL channel contributes 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import SERVING_BOUNDS


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def fit_index_bounds(df: DataFrame, weights: dict[str, float]) -> dict[str, tuple[float | None, float | None]]:
    """AGG-18: (min, max) of each weighted channel present in ``df``, in one pass.

    The result is 2 scalars per channel (bounded), so it is fetched to the driver
    and applied as literals -- no cross join, no unpartitioned window.
    """
    present = [c for c in weights if c in df.columns]
    if not present:
        return {}
    aggs = []
    for c in present:
        aggs += [F.min(_c(c)).alias(f"{c}__min"), F.max(_c(c)).alias(f"{c}__max")]
    row = df.agg(*aggs).first()
    return {c: (row[f"{c}__min"], row[f"{c}__max"]) for c in present}


def index_expr(weights: dict[str, float], bounds: dict[str, tuple], digits: int = 6) -> Column:
    """FN-09 expression from fitted bounds: zero-variance channel -> 0 on every row;
    otherwise a NULL value nulls the index; channels without bounds are skipped."""
    total = None
    for c, wgt in weights.items():
        if c not in bounds:
            continue
        lo, hi = bounds[c]
        if lo is None or hi is None:
            scaled = F.lit(None).cast("double")
        elif hi == lo:
            scaled = F.lit(0.0)
        else:
            scaled = (_c(c) - F.lit(float(lo))) / F.lit(float(hi - lo))
        term = F.lit(float(wgt)) * scaled
        total = term if total is None else total + term
    if total is None:
        return F.lit(None).cast("double")
    return F.round(total, digits)


def composite_index(df: DataFrame, weights: dict[str, float], bounds: dict[str, tuple] | None = None,
                    name: str = "pollution_index", digits: int = 6) -> DataFrame:
    """FN-09. ``bounds`` defaults to the bounds of ``df`` itself (whole-table parity);
    pass bounds fitted on the training split to avoid look-ahead (Q2)."""
    b = bounds if bounds is not None else fit_index_bounds(df, weights)
    return df.withColumn(name, index_expr(weights, b, digits))


def serving_index(weights: dict[str, float], bounds: dict[str, tuple[float, float]] | None = None,
                  digits: int = 6, value_of=None) -> Column:
    """FN-10 expression: fixed bounds, clamp to [0, 1], NULL channel -> 0, round.

    ``value_of`` maps a channel name to its Column (default: the column itself).
    """
    bounds = bounds or SERVING_BOUNDS
    value_of = value_of or _c
    total = F.lit(0.0)
    for c, wgt in weights.items():
        lo, hi = bounds[c]
        v = value_of(c)
        scaled = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (v - F.lit(lo)) / F.lit(hi - lo)))
        total = total + F.coalesce(F.when(v.isNotNull(), scaled), F.lit(0.0)) * F.lit(float(wgt))
    return F.round(total, digits)
