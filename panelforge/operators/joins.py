"""Joins: small sides, dimension lookups (JOIN-02/03/10), intervals (JOIN-04) and contained keywords (JOIN-05).

Interval and containment lookups are equi-joins here, so no side has to be small: values and
intervals meet in *bins* of the value's range, names and keywords in the names' substrings.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def range_lookup(df: DataFrame, value: Column, bands: DataFrame, low: str, high: str, take: list[str]) -> DataFrame:
    """JOIN-04: ``df`` plus the columns ``take`` of the band with ``low <= value <= high`` (NULL without one).

    One row out per row in, repeated ones too; of bands that share a value the one with the least
    ``low`` (then ``high``, then ``take``) is taken. The range of the finite edges is cut into bins of the mean width of a
    band, each band is written to the bins it lies over (two a band on average) and a value
    looks at the bands of its bin only. NULL edges are open; a NULL or NaN value has no band.
    """
    b = bands.select(F.coalesce(_c(low).cast("double"), F.lit(-math.inf)).alias("lo"), F.coalesce(_c(high).cast("double"), F.lit(math.inf)).alias("hi"), F.struct(*[_c(c) for c in take]).alias("t")).where("lo <= hi")
    finite = lambda c: F.when(F.abs(c) < math.inf, F.col(c))
    edges = F.coalesce(finite("lo"), finite("hi")), F.coalesce(finite("hi"), finite("lo"))
    s = b.agg(F.min(edges[0]).alias("a"), F.max(edges[1]).alias("z"), F.avg(edges[1] - edges[0]).alias("w"), F.count(F.lit(1)).alias("n")).first()
    start = s["a"] if s["a"] is not None else 0.0
    span = (s["z"] - start) if s["a"] is not None else 0.0
    width = max(s["w"] or 0.0, span / max(1, 4 * (s["n"] or 0))) or 1.0
    last = int(span / width)
    bin_of = lambda v: F.greatest(F.lit(0), F.least(F.lit(last), F.floor((v - F.lit(start)) / F.lit(width))))
    spread = b.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("lo")), bin_of(F.col("hi")))))
    of_bin = spread.groupBy("_bin").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "t"))).alias("_bands"))  # the bands over one bin
    v = value.cast("double")
    keyed = df.withColumn("_value", F.when(~F.isnan(v), v))
    j = join_small(keyed.withColumn("_bin", bin_of(F.col("_value"))), of_bin, "_bin", "left")
    hit = F.get(F.filter("_bands", lambda x: (x["lo"] <= F.col("_value")) & (F.col("_value") <= x["hi"])), F.lit(0))["t"]
    return j.withColumn("_hit", hit).select(*[_c(c) for c in df.columns], *[F.col("_hit")[c].alias(c) for c in take])


def longest_contained(df: DataFrame, name: str, rules: DataFrame, keyword: str, score: str, out: str, default: float) -> DataFrame:
    """JOIN-05: ``df`` plus ``out``: the score of the longest keyword contained in ``name`` (ties: the first one), else ``default``.

    Each distinct name is taken apart once into its substrings of the lengths that keywords have, which
    meet the keywords in an equi-join; repeated rows and NULL names are kept as they are.
    """
    rules = rules.where(_c(keyword).isNotNull()).groupBy(_c(keyword).alias("_k")).agg(F.max(_c(score)).alias("_s"))
    sizes = sorted(r[0] for r in rules.select(F.length("_k")).distinct().collect())  # a keyword's lengths: few numbers
    always = next((r["_s"] for r in rules.where("_k = ''").collect()), default)
    names = df.select(_c(name).alias("_n")).where(F.col("_n").isNotNull()).distinct()

    def pieces(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("_n") - (n - 1)))
        return F.transform(starts, lambda at: F.substr(F.col("_n"), at, F.lit(n)))

    own = [pieces(n) for n in sizes if n]
    parts = F.flatten(F.array(*own)) if own else F.expr("cast(array() as array<string>)")
    found = names.select("_n", F.explode(F.array_distinct(parts)).alias("_k")).join(rules.where("_k <> ''"), "_k")
    best = found.groupBy("_n").agg(F.min_by("_s", F.struct(-F.length("_k"), F.col("_k"))).alias("_best"))
    j = join_small(df.withColumn("_n", _c(name)), best, "_n", "left")
    return j.select(*[_c(c) for c in df.columns], F.coalesce(F.col("_best"), F.lit(always)).alias(out))


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """Equi-join ``big`` with a side expected to be small.

    No hint and no count: Spark broadcasts a side that its own size bound
    (``spark.sql.autoBroadcastJoinThreshold``, checked by AQE at run time)
    allows, and otherwise shuffles, with AQE's skew-join handling of hot keys.
    """
    return big.join(small, on, how)


def complete_entities(expected: DataFrame, facts: DataFrame, key: str, defaults: dict | None = None) -> DataFrame:
    """JOIN-10 / SRC-10: one output row per expected entity. Entities without facts
    keep a row whose other columns are NULL or ``defaults``."""
    out = expected.join(facts, key, "left")
    if defaults:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    return out
