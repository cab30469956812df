"""Sub-index bands, categories and advisories (FN-21..24, JOIN-03/04, VAL-10).

The band list is fixed and tiny, so the default form is a ``CASE`` chain that
stays inside whole-stage codegen. ``subindex_join`` offers the same lookup as a
broadcast range join for band tables supplied as data (6 rows here; the
caller's table is counted before it is broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import ADVISORIES, CATEGORY_ABOVE, CATEGORY_BOUNDS, CATEGORY_UNKNOWN, SUBINDEX_BANDS, SUBINDEX_CEILING


def _c(col) -> Column:
    return F.col(f"`{col}`") if isinstance(col, str) else col


def _interp(v: Column, c_lo, c_hi, i_lo, i_hi) -> Column:
    return F.lit((i_hi - i_lo) / (c_hi - c_lo)) * (v - F.lit(c_lo)) + F.lit(float(i_lo))


def subindex(col, bands=SUBINDEX_BANDS, gaps: str = "continuous", ceiling: int = SUBINDEX_CEILING) -> Column:
    """FN-22: piecewise-linear sub-index rounded half-even to int; NULL or negative -> NULL.

    gaps="reference": a value must lie inside ``[c_lo, c_hi]`` of a band; values between
    bands (30.05) and above the last band give ``ceiling``.
    gaps="continuous": a value belongs to the first band with ``v <= c_hi``; values in a
    gap are clamped up to that band's ``c_lo``; above the last band gives ``ceiling``.
    """
    v = _c(col).cast("double")
    expr = None
    for c_lo, c_hi, i_lo, i_hi in bands:
        if gaps == "reference":
            cond = (v >= F.lit(c_lo)) & (v <= F.lit(c_hi))
            val = _interp(v, c_lo, c_hi, i_lo, i_hi)
        else:
            cond = v <= F.lit(c_hi)
            val = _interp(F.greatest(v, F.lit(c_lo)), c_lo, c_hi, i_lo, i_hi)
        expr = F.when(cond, F.bround(val, 0)) if expr is None else expr.when(cond, F.bround(val, 0))
    expr = expr.otherwise(F.lit(float(ceiling)))
    return F.when(v.isNull() | (v < 0), F.lit(None)).otherwise(expr).cast("int")


def category(col, bounds=CATEGORY_BOUNDS, above: str = CATEGORY_ABOVE, unknown: str | None = CATEGORY_UNKNOWN) -> Column:
    """FN-23: index -> category by inclusive upper bounds; NULL -> ``unknown``."""
    v = _c(col)
    expr = None
    for hi, name in bounds:
        expr = F.when(v <= F.lit(hi), F.lit(name)) if expr is None else expr.when(v <= F.lit(hi), F.lit(name))
    expr = expr.otherwise(F.lit(above))
    return F.when(v.isNull(), F.lit(unknown)).otherwise(expr)


def band_table(spark, bands=SUBINDEX_BANDS) -> DataFrame:
    return spark.createDataFrame(
        [(float(a), float(b), int(c), int(d)) for a, b, c, d in bands], "c_lo double, c_hi double, i_lo int, i_hi int"
    )


def subindex_join(df: DataFrame, col: str, bands: DataFrame, name: str = "subindex",
                  ceiling: int = SUBINDEX_CEILING) -> DataFrame:
    """JOIN-04 on a band table of any size (reference gap semantics): an equi-join over bins of the value's range."""
    from ..operators.joins import range_lookup

    v = _c(col).cast("double")
    j = range_lookup(df, v, bands, "c_lo", "c_hi", ["c_lo", "c_hi", "i_lo", "i_hi"])
    val = (F.col("i_hi") - F.col("i_lo")) / (F.col("c_hi") - F.col("c_lo")) * (v - F.col("c_lo")) + F.col("i_lo")
    out = F.when(v.isNull() | (v < 0), F.lit(None)).when(F.col("c_lo").isNull(), F.lit(ceiling)).otherwise(
        F.bround(val, 0))
    return j.withColumn(name, out.cast("int")).drop("c_lo", "c_hi", "i_lo", "i_hi")


def advisories(cat, table: dict[str, list[str]] | None = None, strict: bool = False) -> Column:
    """FN-24: category -> ordered advisory list. ``strict`` raises on an unknown category (VAL-10)."""
    table = table or ADVISORIES
    m = F.create_map(*[x for k, items in table.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in items]))])
    c = _c(cat)
    out = F.try_element_at(m, c)
    if strict:
        return F.when(out.isNull(), F.raise_error(F.concat(F.lit("unknown category: "), F.coalesce(c, F.lit("NULL"))))
                      ).otherwise(out)
    return out


def first_present(a: Column, b: Column, zero_is_missing: bool = False) -> Column:
    """FN-21: first of two readings. With ``zero_is_missing`` a 0.0 in the first counts as
    absent and the second is taken as it is (the reference's ``a or b`` rule, Q9)."""
    if zero_is_missing:
        a = F.when(a != 0, a)
    return F.coalesce(a, b)
