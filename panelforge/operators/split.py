"""Chronological split and per-split reports (SET-04, VAL-13, AGG-21, AGG-04).

The split is a column, never separate scans: downstream fits filter on it and
the output can be written ``partitionBy("split")`` so later reads prune.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLITS = ("train", "validation", "test")


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def split_label(time: str, cutoffs: tuple[str, str, str], labels=SPLITS) -> Column:
    """Inclusive upper cutoffs: ``<= t1`` train, ``(t1, t2]`` validation, ``(t2, t3]`` test;
    later rows and NULL times get NULL."""
    t = _c(time).cast("date")
    t1, t2, t3 = (F.lit(x).cast("date") for x in cutoffs)
    return (
        F.when(t <= t1, F.lit(labels[0]))
        .when(t <= t2, F.lit(labels[1]))
        .when(t <= t3, F.lit(labels[2]))
    )


def chronological_split(df: DataFrame, time: str, cutoffs: tuple[str, str, str], name: str = "split",
                        keep_unassigned: bool = False) -> DataFrame:
    """SET-04. Rows after the last cutoff or with NULL time are dropped unless
    ``keep_unassigned`` (then their split is NULL and they can be counted, Q16)."""
    out = df.withColumn(name, split_label(time, cutoffs))
    return out if keep_unassigned else out.where(F.col(name).isNotNull())


def two_way_split(df: DataFrame, time: str, train_end: str, test_end: str, name: str = "split") -> DataFrame:
    """POL-09: ``<= train_end`` train, ``(train_end, test_end]`` test; the rest dropped."""
    t = _c(time).cast("date")
    lab = F.when(t <= F.lit(train_end).cast("date"), F.lit("train")).when(
        t <= F.lit(test_end).cast("date"), F.lit("test"))
    return df.withColumn(name, lab).where(F.col(name).isNotNull())


def split_counts(df: DataFrame, split_col: str = "split") -> dict[str, int]:
    """Row count per split (tiny driver-side dict used by the VAL-13 guard)."""
    return {r[0]: r[1] for r in df.groupBy(split_col).count().collect()}


def check_splits(counts: dict[str, int], labels=SPLITS) -> list[str]:
    """VAL-13: train must be non-empty (raises); empty validation/test give warnings."""
    if counts.get(labels[0], 0) == 0:
        raise ValueError("training split is empty; check the first cutoff")
    return [f"{s} split is empty" for s in labels[1:] if counts.get(s, 0) == 0]


def split_summary(df: DataFrame, time: str, split_col: str = "split") -> DataFrame:
    """AGG-21: rows, first and last time per split."""
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(_c(time)).alias("first"),
        F.max(_c(time)).alias("last"),
    )


def missing_by_split(df: DataFrame, cols: list[str], split_col: str = "split",
                     labels=("train", "validation", "test"), prefixes=("train", "valid", "test"),
                     digits: int = 3) -> DataFrame:
    """AGG-04: NULL count and % per feature x split, sorted by train count desc.

    One aggregation pass computes every (feature, split) count; the single
    wide row is then unpivoted into one row per feature.
    """
    aggs = [F.count_if(F.col(split_col) == s).alias(f"__n_{p}") for s, p in zip(labels, prefixes)]
    for i, c in enumerate(cols):
        for s, p in zip(labels, prefixes):
            aggs.append(F.count_if((F.col(split_col) == s) & _c(c).isNull()).alias(f"__m{i}_{p}"))
    wide = df.agg(*aggs)
    structs = [
        F.struct(
            F.lit(c).alias("feature"),
            *[F.col(f"__m{i}_{p}").alias(f"{p}_missing") for p in prefixes],
        )
        for i, c in enumerate(cols)
    ]
    long = wide.select(*[F.col(f"__n_{p}") for p in prefixes], F.explode(F.array(*structs)).alias("r"))
    out = long.select(
        F.col("r.feature").alias("feature"),
        *[
            x
            for p in prefixes
            for x in (
                F.col(f"r.{p}_missing").alias(f"{p}_missing"),
                F.when(F.col(f"__n_{p}") > 0, F.round(F.col(f"r.{p}_missing") / F.col(f"__n_{p}") * 100, digits))
                .otherwise(F.lit(0.0)).alias(f"{p}_pct"),
            )
        ],
    )
    return out.orderBy(F.col(f"{prefixes[0]}_missing").desc(), "feature")
