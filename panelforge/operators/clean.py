"""Cleaning, projection and row filters (SET-01, PRJ-01/05/06, FLT-01/05, VAL-14, POL-04/05)."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def to_double(col: str | Column) -> Column:
    """VAL-14: coerce to double; non-numeric text, NaN and NULL all become NULL."""
    c = _c(col) if isinstance(col, str) else col
    v = c.cast("string").try_cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in every floating column (Spark's max/avg propagate NaN)."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    todo = [c for c in (cols or floats) if c in floats]
    if not todo:
        return df
    return df.withColumns({c: F.nanvl(_c(c), F.lit(None).cast(df.schema[c].dataType)) for c in todo})


def remove_exact_duplicates(df: DataFrame) -> DataFrame:
    """SET-01: drop rows equal on every column (NULL equals NULL)."""
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each exact duplicate group, as a one-row table."""
    groups = df.groupBy(*[_c(c) for c in df.columns]).count()
    return groups.agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
        F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("total_rows"),
    )


def duplicate_sample(df: DataFrame, n: int = 10) -> DataFrame:
    """SET-02: the ``n`` largest groups of equal rows with their size, ties by the columns in order."""
    groups = df.groupBy(*[_c(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return groups.orderBy(F.col("copies").desc(), *[_c(c).asc_nulls_first() for c in df.columns]).limit(n)


def distinct_entities(df: DataFrame, entity: str) -> DataFrame:
    """SET-08: distinct entities that are not NULL."""
    return df.select(_c(entity)).where(_c(entity).isNotNull()).distinct()


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """SRT-07: the first ``n`` rows along ``order`` (each task keeps its first ``n``)."""
    return df.orderBy(*[_c(c).asc_nulls_last() for c in order]).limit(n)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """PRJ-01: drop the columns that exist (absent ones are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def add_placeholders(df: DataFrame, cols, dtype: str = "double") -> DataFrame:
    """PRJ-06: append all-NULL placeholder columns."""
    return df.withColumns({c: F.lit(None).cast(dtype) for c in cols if c not in df.columns})


def reindex(df: DataFrame, schema: T.StructType | list[tuple[str, str]]) -> DataFrame:
    """PRJ-05: project to an exact column list/order; absent columns become typed NULLs,
    extra columns are dropped."""
    fields = [(f.name, f.dataType) for f in schema.fields] if isinstance(schema, T.StructType) else schema
    return df.select(*[
        (_c(n).cast(t) if n in df.columns else F.lit(None).cast(t)).alias(n) for n, t in fields
    ])


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    """FLT-01."""
    return df.where(_c(target).isNotNull())


def any_null(cols) -> Column:
    """FLT-05: row has at least one NULL among ``cols`` (a plain OR chain, which the
    optimizer handles cheaply even for many columns)."""
    return functools.reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols])


def all_null(cols) -> Column:
    """FLT-05: every one of ``cols`` is NULL."""
    return functools.reduce(lambda a, b: a & b, [_c(c).isNull() for c in cols])


def remove_empty_rows(df: DataFrame, target: str, channels) -> DataFrame:
    """POL-04 (first half): drop rows whose target and all channels are NULL."""
    return df.where(~all_null([target, *channels]))


def policy_clean(df: DataFrame, entity: str, time: str, target: str, lo: float = 0.0, hi: float = 500.0,
                 order_cols: list[str] | None = None) -> DataFrame:
    """POL-05: drop NULL-time rows and targets outside [lo, hi]; keep the first row per
    (entity, time) by ``order_cols`` (a total tie-break is required for determinism)."""
    kept = df.where(_c(time).isNotNull() & (_c(target).isNull() | _c(target).between(lo, hi)))
    order = [_c(c) for c in (order_cols or df.columns)]
    w = Window.partitionBy(_c(entity), _c(time)).orderBy(*order)
    return kept.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def combine_sources(history: DataFrame, live: DataFrame, enrich: DataFrame, keys: list[str],
                    fill: list[str]) -> DataFrame:
    """POL-08: history UNION ALL live readings (columns aligned by name), then placeholder
    columns ``fill`` taken from an enrichment table by an equi-join on ``keys``."""
    both = history.unionByName(live, allowMissingColumns=True)
    e = enrich.select(*keys, *[_c(c).alias(f"_e_{c}") for c in fill])
    j = both.join(e, keys, "left")
    return j.withColumns({c: F.coalesce(_c(c), F.col(f"_e_{c}")) if c in both.columns else F.col(f"_e_{c}")
                         for c in fill}).drop(*[f"_e_{c}" for c in fill])
