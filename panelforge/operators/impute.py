"""Imputation fitted on training rows (IMP-01..03 in ``knn``, POL-01, POL-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize  # noqa: F401  also used through this module
from .knn import KnnModel, fit_knn, knn_transform  # noqa: F401
from .windows import _chunk_expr, _order, qcol

# ---------------------------------------------------------------------------
# Policy fills
# ---------------------------------------------------------------------------

def ffill_bfill(df: DataFrame, entity: str, order_cols: list[str], cols: list[str], chunk_days: int = 90) -> DataFrame:
    """POL-01: forward-fill then back-fill each column within the entity's time order.

    Carry values cross chunk borders through a small per-chunk summary (last and first
    non-NULL value of each chunk), so rows are windowed per (entity, chunk) and a hot
    entity is spread over many tasks.
    """
    base = df.withColumn("_chunk", _chunk_expr(order_cols[0], chunk_days))
    order = _order(order_cols)
    part = [qcol(entity), F.col("_chunk")]
    # per chunk: last / first non-NULL value by time
    summ_aggs = []
    for i, c in enumerate(cols):
        t = F.struct(*[qcol(o) for o in order_cols])
        summ_aggs += [
            F.max_by(qcol(c), F.when(qcol(c).isNotNull(), t)).alias(f"_l{i}"),
            F.min_by(qcol(c), F.when(qcol(c).isNotNull(), t)).alias(f"_f{i}"),
        ]
    summ = base.groupBy(qcol(entity).alias("_e"), F.col("_chunk").alias("_c")).agg(*summ_aggs)
    we = Window.partitionBy("_e").orderBy("_c")
    carry = summ.select(
        "_e", "_c",
        *[F.last(f"_l{i}", ignorenulls=True).over(we.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_in{i}")
          for i in range(len(cols))],
        *[F.first(f"_f{i}", ignorenulls=True).over(we.rowsBetween(1, Window.unboundedFollowing)).alias(f"_out{i}")
          for i in range(len(cols))],
    )
    joined = base.join(carry, qcol(entity).eqNullSafe(F.col("_e")) & F.col("_chunk").eqNullSafe(F.col("_c")), "left")
    w = Window.partitionBy(*part).orderBy(*order)
    fwd = w.rowsBetween(Window.unboundedPreceding, 0)
    bwd = w.rowsBetween(0, Window.unboundedFollowing)
    exprs = {}
    for i, c in enumerate(cols):
        ff = F.coalesce(F.last(qcol(c), ignorenulls=True).over(fwd), F.col(f"_in{i}"))
        bf = F.coalesce(F.first(qcol(c), ignorenulls=True).over(bwd), F.col(f"_out{i}"))
        exprs[c] = F.coalesce(ff, bf)
    return joined.withColumns(exprs).select(*[qcol(c) for c in df.columns])


def monthly_median_fill(df: DataFrame, entity: str, time: str, cols: list[str]) -> DataFrame:
    """POL-03: fill with the entity's median of that calendar month, then the entity's mean.

    Medians and means of all columns come from one ranking and one aggregate, and meet the rows in
    one join each; rows that lack nothing take no part in them.
    """
    from .quantiles import exact_quantiles_grouped

    base = df.withColumn("_m", F.date_trunc("month", qcol(time)).cast("date"))
    names = {c: f"_x{i}" for i, c in enumerate(cols)}
    slim = base.select(qcol(entity).alias("_e"), "_m", *[qcol(c).alias(x) for c, x in names.items()])
    medians = exact_quantiles_grouped(slim, ["_e", "_m"], list(names.values()), [0.5]).withColumnsRenamed({"_e": "_e1", "_m": "_m1"})
    means = slim.groupBy(F.col("_e").alias("_e2")).agg(*[F.avg(x).alias(f"{x}_mean") for x in names.values()])
    lacking = F.lit(False)
    for c in cols:
        lacking = lacking | qcol(c).isNull()
    out = base.where(lacking).join(medians, qcol(entity).eqNullSafe(F.col("_e1")) & F.col("_m").eqNullSafe(F.col("_m1")), "left")
    out = out.join(means, qcol(entity).eqNullSafe(F.col("_e2")), "left")
    filled = out.withColumns({c: F.coalesce(qcol(c), F.col(f"{x}_q0"), F.col(f"{x}_mean")) for c, x in names.items()})
    whole = [qcol(c) for c in df.columns]
    return filled.select(*whole).unionByName(base.where(~lacking).select(*whole))
