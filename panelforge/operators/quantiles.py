"""Quantiles with linear interpolation (pandas / ``quantile_cont`` semantics).

``exact_quantiles_many`` finds the quantiles of any number of columns together, in
aggregates alone; no value list ever reaches the driver or meets in one task:

1. one aggregate over the table gives each column's count, least and greatest value, and a
   mergeable quantile sketch (``percentile_approx``), read a little below and above every
   wanted probability: an interval for each;
2. one aggregate counts the values below and inside each interval. An interval that
   misses its rank (the sketch is approximate) is widened to the whole column;
3. narrowing passes, all intervals in one: each is split into ``parts`` buckets, the values inside
   are counted per bucket with their least and greatest, and the bucket that holds the rank,
   shrunk to the values in it, is the next interval. It is settled when its least value is its
   greatest. The buckets are of equal width; an interval that shrank too little is
   split by sign or by logarithm next, so values of any magnitude settle in a few passes.

Every pass gets at most (intervals x parts) rows, whatever the number of rows or of equal
values, and does the same at every size.

``method="approx"`` is a single ``percentile_approx`` pass. Grouped quantiles rank each
group's values with a range-partitioned sort, all columns in one, and keep only
the rows at the needed positions, so no group, and no run of equal values, is gathered into one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of an interval in a narrowing pass, and accuracy of the first sketch (relative rank error 1 / ACCURACY).
PARTS, ACCURACY = 256, 10_000


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass
class _Interval:
    """Values of column ``i`` in [low, high] hold ``ranks``; ``below`` values are less than ``low``."""

    i: int
    low: float
    high: float
    ranks: list[int]
    below: int = 0
    count: int | None = None
    scale: str = "even"

    def inside(self, v: Column) -> Column:
        return (v >= F.lit(self.low)) & (v <= F.lit(self.high))

    def bucket(self, v: Column, parts: int) -> Column:
        """Number of the bucket of a value inside, not decreasing in the value; ``low`` and ``high`` fall apart."""
        low, high = self.low, self.high
        if math.isinf(low) or math.isinf(high):
            return F.when(v == F.lit(-math.inf), 0).when(v == F.lit(math.inf), 2).otherwise(1)
        if self.scale == "uneven" and low <= 0 <= high:
            return F.when(v < 0, 0).when(v > 0, 2).otherwise(1)
        if self.scale == "uneven":
            near, far = (low, high) if low > 0 else (-high, -low)
            share = (F.log(v if low > 0 else -v) - F.log(F.lit(near))) / (F.log(F.lit(far)) - F.log(F.lit(near)))
            share = share if low > 0 else 1 - share
        else:
            share = (v / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)  # halved: the width may exceed the largest double
        at = F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.floor(share * parts))).cast("int")
        # logarithms of neighbouring doubles may be equal: the ends are told apart in any case
        return F.when(v == F.lit(low), -1).when(v == F.lit(high), parts).otherwise(at)


def _narrow(values: DataFrame, pending: list[_Interval], parts: int) -> tuple[list[_Interval], dict[tuple[int, int], float]]:
    """One pass over all intervals: the next ones, and the values found by (column, rank)."""
    v = [F.col(f"v{x.i}") for x in pending]
    found = F.array(*[F.when(x.inside(c), F.struct(F.lit(k).alias("k"), x.bucket(c, parts).alias("b"), c.alias("v"))) for k, (x, c) in enumerate(zip(pending, v, strict=True))])
    rows = values.select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x")).select("x.*")
    counts = rows.groupBy("k", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
    of: dict[int, list] = {}
    for r in sorted(counts, key=lambda r: (r["k"], r["b"])):
        of.setdefault(r["k"], []).append(r)
    left, settled = [], {}
    for k, x in enumerate(pending):
        below, total = x.below, sum(r["n"] for r in of[k])
        for r in of[k]:
            own = [q for q in x.ranks if below <= q < below + r["n"]]
            if own and r["low"] == r["high"]:
                settled |= {(x.i, q): r["low"] for q in own}
            elif own:
                poor = r["n"] > total / 4 and x.scale == "even"
                left.append(_Interval(x.i, r["low"], r["high"], own, below, r["n"], "uneven" if poor else "even"))
            below += r["n"]
    return left, settled


def exact_quantiles_many(df: DataFrame, wanted: dict[str, list[float]], parts: int = PARTS, accuracy: int = ACCURACY) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns: column -> its values, in the order of its probabilities (None without values)."""
    columns = list(wanted)
    number = [_c(c).cast("double") for c in columns]
    # the passes read the projected columns several times: kept for the duration of the call
    # (recomputed where an executor is lost, spilled when large), released before returning
    values = df.select(*[F.when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(number)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _many(values, columns, wanted, parts, accuracy)
    finally:
        values.unpersist()


def _many(values: DataFrame, columns: list[str], wanted: dict[str, list[float]], parts: int, accuracy: int) -> dict[str, list[float | None]]:
    margin = 2.0 / accuracy
    first = []
    for i, c in enumerate(columns):
        grid = [min(1.0, max(0.0, p + s)) for p in wanted[c] for s in (-margin, margin)]
        sketch = F.percentile_approx(f"v{i}", grid, accuracy) if grid else F.lit(None).cast("array<double>")
        first.append(F.struct(F.count(f"v{i}").alias("n"), F.min(f"v{i}").alias("low"), F.max(f"v{i}").alias("high"), sketch.alias("q")).alias(f"s{i}"))
    row = values.agg(*first).first()
    places: dict[str, list[tuple[int, int, float]]] = {}
    pending: list[_Interval] = []
    for i, c in enumerate(columns):
        s = row[f"s{i}"]
        places[c] = []
        if not s["n"]:
            continue
        merged: dict[tuple[float, float], set[int]] = {}
        for k, p in enumerate(wanted[c]):
            at = p * (s["n"] - 1)
            low = math.floor(at)
            high = min(low + 1, s["n"] - 1)
            places[c].append((low, high, at - low))
            # the position above may lie one value further than the sketch was asked for; counting tells
            merged.setdefault((s["q"][2 * k], s["q"][2 * k + 1]), set()).update((low, high))
        pending += [_Interval(i, a, b, sorted(ranks)) for (a, b), ranks in merged.items()]
    found: dict[tuple[int, int], float] = {}
    if pending:
        counted = values.agg(*[F.count_if(F.col(f"v{x.i}") < F.lit(x.low)).alias(f"a{k}") for k, x in enumerate(pending)], *[F.count_if(F.col(f"v{x.i}") <= F.lit(x.high)).alias(f"b{k}") for k, x in enumerate(pending)]).first()
        checked: list[_Interval] = []
        for k, x in enumerate(pending):
            below, upto = counted[f"a{k}"], counted[f"b{k}"]
            own = [r for r in x.ranks if below <= r < upto]
            rest = [r for r in x.ranks if not below <= r < upto]
            s = row[f"s{x.i}"]
            if own:
                checked.append(_Interval(x.i, x.low, x.high, own, below))
            if rest:
                checked.append(_Interval(x.i, s["low"], s["high"], rest))
        pending = []
        for x in checked:
            if x.low == x.high:
                found |= {(x.i, r): x.low for r in x.ranks}
            else:
                pending.append(x)
    while pending:
        pending, more = _narrow(values, pending, parts)
        found |= more
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        out[c] = [None] * len(wanted[c]) if not places[c] else [found[i, a] + (found[i, b] - found[i, a]) * f if f else found[i, a] for a, b, f in places[c]]
    return out


def exact_quantiles(df: DataFrame, col: str | Column, probs: list[float], parts: int = PARTS, accuracy: int = ACCURACY) -> list[float | None]:
    if not isinstance(col, str):
        df, col = df.select(col.alias("v")), "v"
    return exact_quantiles_many(df, {col: list(probs)}, parts, accuracy)[col]


def approx_quantiles(df: DataFrame, col: str, probs: list[float], accuracy: int = 10_000) -> list[float | None]:
    r = df.agg(F.percentile_approx(_c(col).cast("double"), list(probs), accuracy).alias("q")).first()["q"]
    return list(r) if r is not None else [None] * len(probs)


def quantile_columns(df: DataFrame, col: str, probs: list[float], method: str = "exact") -> list[float | None]:
    if method == "approx":
        return approx_quantiles(df, col, probs)
    return exact_quantiles(df, col, probs)


def exact_quantiles_grouped(df: DataFrame, keys: list[str], cols: str | list[str], probs: list[float]) -> DataFrame:
    """Per-group linear-interpolated quantiles as columns q0, q1, ... (several columns: ``<column>_q0``, ...).

    Values of all columns are ranked inside each (group, column) by one range-partitioned sort
    (``global_rank``), with a row number behind the value, so that neither a large group nor many equal
    values stay together; only the rows at the needed positions (two per probability) are kept and combined.
    """
    from .ordering import global_rank

    one = isinstance(cols, str)
    names = [cols] if one else list(cols)
    number = [_c(c).cast("double") for c in names]
    cells = F.array(*[F.when(v.isNotNull() & ~F.isnan(v), F.struct(F.lit(k).alias("_c"), v.alias("_v"))) for k, v in enumerate(number)])
    base = df.select(*[_c(k) for k in keys], F.monotonically_increasing_id().alias("_t"), F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("_x")).select(*keys, "_t", "_x.*")
    ranked = global_rank(base, [F.col("_v").asc(), F.col("_t").asc()], "_r", group=[*keys, "_c"])
    counts = ranked.groupBy(*keys, "_c").agg(F.count(F.lit(1)).alias("_n"))
    need = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        lo = F.floor(pos).cast("long")
        need.append(F.struct(F.lit(i).alias("i"), (lo + 1).alias("lo"), F.least(lo + 2, F.col("_n")).alias("hi"), (pos - lo).alias("frac")))
    plan = counts.select(*keys, "_c", F.explode(F.array(*need)).alias("_q")).select(*keys, "_c", "_q.*")
    same = F.lit(True)
    plan = plan.withColumnsRenamed({k: f"_k{n}" for n, k in enumerate(keys)} | {"_c": "_c2"})
    for n, k in enumerate(keys):  # NULL is a group of its own
        same = same & _c(k).eqNullSafe(F.col(f"_k{n}"))
    at = (F.col("_r") == F.col("lo")) | (F.col("_r") == F.col("hi"))
    hits = ranked.join(plan, same & (F.col("_c") == F.col("_c2"))).where(at)
    per = hits.groupBy(*keys, "_c", "i").agg(
        F.max(F.when(F.col("_r") == F.col("lo"), F.col("_v"))).alias("a"),
        F.max(F.when(F.col("_r") == F.col("hi"), F.col("_v"))).alias("b"),
        F.first("frac").alias("frac"),
    )
    val = F.when(F.col("frac") == 0, F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("frac"))
    made = [((k, i), f"q{i}" if one else f"{c}_q{i}") for k, c in enumerate(names) for i in range(len(probs))]
    wide = per.groupBy(*keys).agg(*[F.max(F.when((F.col("_c") == k) & (F.col("i") == i), val)).alias(name) for (k, i), name in made])
    # groups whose values are all NULL still get a row (NULL quantiles)
    every = df.select(*[_c(k) for k in keys]).distinct()
    wide = wide.withColumnsRenamed({k: f"_k{n}" for n, k in enumerate(keys)})
    same = F.lit(True)
    for n, k in enumerate(keys):
        same = same & _c(k).eqNullSafe(F.col(f"_k{n}"))
    return every.join(wide, same, "left").select(*[_c(k) for k in keys], *[_c(name) for _, name in made])
