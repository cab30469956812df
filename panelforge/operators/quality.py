"""Panel profiling (AGG-01..14, SET-02/03, VAL-12, FLT-02/05).

Every profile is one aggregation pass over the table (map-side partial
aggregation, one tiny final merge) followed by an unpivot of the single wide
row -- never one pass per statistic or per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import parse_date
from ..spec import BUCKET_ORDER
from .quantiles import approx_quantiles, exact_quantiles_grouped, exact_quantiles_many, quantile_columns


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _explode_structs(wide: DataFrame, structs: list[Column], keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    return wide.select(*[F.col(k) for k in keep], F.explode(F.array(*structs)).alias("_r")).select(*keep, "_r.*")


def overview(df: DataFrame) -> DataFrame:
    """AGG-01: rows, columns and the schema as text."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.lit(", ".join(f"{n}:{t}" for n, t in df.dtypes)).alias("dtypes"),
    )


def date_range(df: DataFrame, raw_col: str, fmt: str = "yyyy-MM-dd", parsed: Column | None = None) -> DataFrame:
    """AGG-05 + VAL-12: first/last date, span in days, span as years + days (365-day years),
    and the count of non-NULL values that do not parse."""
    p = parsed if parsed is not None else parse_date(raw_col, fmt)
    d = df.select(_c(raw_col).alias("_raw"), p.alias("_d"))
    agg = d.agg(
        F.min("_d").alias("first_date"),
        F.max("_d").alias("last_date"),
        F.count_if(F.col("_raw").isNotNull() & F.col("_d").isNull()).alias("invalid_dates"),
    )
    span = F.datediff("last_date", "first_date")
    return agg.select(
        "first_date", "last_date", span.alias("span_days"),
        F.floor(span / 365).cast("int").alias("span_years"), (span % 365).alias("span_rem_days"),
        "invalid_dates",
    )


def missing_by_column(df: DataFrame, cols: list[str] | None = None, high_pct: float = 30.0,
                      digits: int = 2) -> DataFrame:
    """AGG-02: NULL count and % per column, HIGH flag above ``high_pct``, sorted by % desc."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(_c(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing")) for i, c in enumerate(cols)]
    long = _explode_structs(wide, structs, ["_n"])
    pct = F.when(F.col("_n") > 0, F.round(F.col("missing") / F.col("_n") * 100, digits)).otherwise(0.0)
    return long.select("column_name", "missing", pct.alias("missing_pct"), (pct > high_pct).alias("high")).orderBy(
        F.col("missing_pct").desc(), "column_name"
    )


def row_null_profile(df: DataFrame, channels: list[str], cols: list[str] | None = None, digits: int = 2) -> DataFrame:
    """AGG-03: total cells, missing cells and %, rows with >= 1 NULL and %, rows with all channels NULL."""
    from .clean import all_null, any_null

    cols = cols or df.columns
    n_null = sum((_c(c).isNull().cast("long") for c in cols), F.lit(0).cast("long"))
    agg = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(n_null), F.lit(0)).cast("long").alias("missing_cells"),
        F.count_if(any_null(cols)).alias("rows_any_null"),
        F.count_if(all_null(channels)).alias("rows_all_channels_null"),
    )
    cells = F.col("rows") * F.lit(len(cols))
    return agg.select(
        cells.alias("total_cells"),
        "missing_cells",
        F.when(cells > 0, F.round(F.col("missing_cells") / cells * 100, digits)).otherwise(0.0).alias("missing_pct"),
        "rows_any_null",
        F.when(F.col("rows") > 0, F.round(F.col("rows_any_null") / F.col("rows") * 100, digits)).otherwise(0.0)
        .alias("rows_any_pct"),
        "rows_all_channels_null",
    )


def entity_profile(df: DataFrame, entity: str, time: str, target: str, key_cols: list[str], expected,
                   digits: int = 1) -> DataFrame:
    """AGG-06 + FLT-02: per expected entity: rows, first/last time, span, target count /
    missing / mean / median / min / max / sample std, NULLs and % per key column, and a
    ``found`` flag. Entities without rows are kept (left join from the expected list)."""
    spark: SparkSession = df.sparkSession
    etype = df.schema[entity].dataType
    exp = spark.createDataFrame([(e,) for e in expected], T.StructType([T.StructField(entity, etype)]))
    sub = df.join(F.broadcast(exp), entity, "left_semi")  # expected list: bounded, caller-given
    aggs = [
        F.count(F.lit(1)).alias("rows"),
        F.min(_c(time)).alias("first"),
        F.max(_c(time)).alias("last"),
        F.count(_c(target)).alias("target_count"),
        F.count_if(_c(target).isNull()).alias("target_missing"),
        F.avg(_c(target)).alias("target_mean"),
        F.min(_c(target)).alias("target_min"),
        F.max(_c(target)).alias("target_max"),
        F.stddev_samp(_c(target)).alias("target_std"),
    ]
    for i, c in enumerate(key_cols):
        aggs.append(F.count_if(_c(c).isNull()).alias(f"{c}_missing"))
    g = sub.groupBy(entity).agg(*aggs)
    med = exact_quantiles_grouped(sub, [entity], target, [0.5]).select(entity, F.col("q0").alias("target_median"))
    g = g.join(med, entity, "left")
    g = g.withColumn("span_days", F.datediff(_c("last"), _c("first")))
    for c in key_cols:
        g = g.withColumn(f"{c}_pct", F.round(F.col(f"{c}_missing") / F.col("rows") * 100, digits))
    out = exp.join(g, entity, "left").withColumn("found", F.col("rows").isNotNull())
    return out.withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))


def corrected_moments(n: Column, g1: Column, g2: Column) -> tuple[Column, Column]:
    """Bias-corrected sample skewness G1 and excess kurtosis G2 from population g1, g2
    (Spark's ``skewness``/``kurtosis``); NULL for n < 3 / n < 4."""
    nd = n.cast("double")
    G1 = F.when(n >= 3, F.sqrt(nd * (nd - 1)) / (nd - 2) * g1)
    G2 = F.when(n >= 4, (nd - 1) / ((nd - 2) * (nd - 3)) * ((nd + 1) * g2 + 6))
    return G1, G2


def distribution(df: DataFrame, col: str, method: str = "exact") -> DataFrame:
    """AGG-07: n, missing, mean, median, sample std, bias-corrected skewness and kurtosis,
    and skew direction."""
    agg = df.agg(
        F.count(_c(col)).alias("n"),
        F.count_if(_c(col).isNull()).alias("missing"),
        F.avg(_c(col)).alias("mean"),
        F.stddev_samp(_c(col)).alias("std"),
        F.skewness(_c(col)).alias("_g1"),
        F.kurtosis(_c(col)).alias("_g2"),
    )
    med = quantile_columns(df, col, [0.5], method)[0]
    G1, G2 = corrected_moments(F.col("n"), F.col("_g1"), F.col("_g2"))
    return agg.select(
        "n", "missing", "mean", F.lit(med).cast("double").alias("median"), "std",
        G1.alias("skewness"), G2.alias("kurtosis"),
        F.when(G1 > 0, F.lit("right")).when(G1.isNotNull(), F.lit("left")).alias("skew_direction"),
    )


PERCENTILES = (5, 10, 25, 50, 75, 90, 95, 99)


def percentiles(df: DataFrame, col: str, pcts=PERCENTILES, method: str = "exact") -> DataFrame:
    """AGG-08: linear-interpolated percentiles, one row per percentile."""
    vals = quantile_columns(df, col, [p / 100 for p in pcts], method)
    spark = df.sparkSession
    return spark.createDataFrame(list(zip(pcts, vals)), "pct int, value double")


def category_frequency(df: DataFrame, col: str, order: list[str] | None = None, digits: int = 1) -> DataFrame:
    """AGG-09: frequency of every category incl. NULL and its % of all rows. ``ord`` is the
    fixed display position (0-based) of known categories and NULL for the others, which
    follow by count desc in the sorted output."""
    order = order if order is not None else BUCKET_ORDER
    counts = df.groupBy(_c(col).alias("category")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).first()[0] or 0
    pos = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("category"))
    pct = F.round(F.col("count") / F.lit(total) * 100, digits) if total else F.lit(0.0)
    out = counts.select("category", "count", pct.alias("pct"),
                        F.when(pos > 0, (pos - 1).cast("int")).alias("ord"))
    return out.orderBy(F.col("ord").asc_nulls_last(), F.col("count").desc(), F.col("category").asc_nulls_last())


def iqr_outliers(df: DataFrame, cols: list[str], k: float = 1.5, digits: int = 2, method: str = "exact") -> DataFrame:
    """AGG-10: Q1, Q3, IQR, fences and the strict-outside count (and % of non-NULL) per
    column. Rows are never removed. Quartiles of all columns together first, then one counting pass with the
    fences as literals."""
    spark = df.sparkSession
    quartiles = [0.25, 0.75]
    found = {c: approx_quantiles(df, c, quartiles) for c in cols} if method == "approx" else exact_quantiles_many(df, dict.fromkeys(cols, quartiles))
    rows = [(c, *found[c]) for c in cols]
    aggs = []
    for i, (c, q1, q3) in enumerate(rows):
        if q1 is None:
            aggs += [F.lit(0).cast("long").alias(f"_o{i}"), F.count(_c(c)).alias(f"_n{i}")]
            continue
        iqr = q3 - q1
        lo, hi = q1 - k * iqr, q3 + k * iqr
        aggs += [F.count_if((_c(c) < lo) | (_c(c) > hi)).alias(f"_o{i}"), F.count(_c(c)).alias(f"_n{i}")]
    counts = df.agg(*aggs).first()
    out = []
    for i, (c, q1, q3) in enumerate(rows):
        o, n = counts[f"_o{i}"], counts[f"_n{i}"]
        iqr = None if q1 is None else q3 - q1
        lo = None if q1 is None else q1 - k * iqr
        hi = None if q1 is None else q3 + k * iqr
        out.append((c, q1, q3, iqr, lo, hi, o, n))
    res = spark.createDataFrame(
        out, "column_name string, q1 double, q3 double, iqr double, lower double, upper double, outliers long, n long"
    )
    return res.withColumn(
        "outlier_pct", F.when(F.col("n") > 0, F.round(F.col("outliers") / F.col("n") * 100, digits)).otherwise(0.0)
    ).drop("n")


def correlations(df: DataFrame, target: str, cols: list[str], min_pairs: int = 10, digits: int = 4) -> DataFrame:
    """AGG-11/12: pairwise-complete Pearson r of ``target`` with each column (NULL unless more
    than ``min_pairs`` pairs), strength band, sign and bar length; ordered by |r| desc."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.corr(_c(target), _c(c)).alias(f"_r{i}"), F.regr_count(_c(target), _c(c)).alias(f"_n{i}")]
    wide = df.agg(*aggs)
    structs = [
        F.struct(F.lit(c).alias("column_name"),
                 F.when(F.col(f"_n{i}") > min_pairs, F.round(F.col(f"_r{i}"), digits)).alias("r"))
        for i, c in enumerate(cols)
    ]
    long = _explode_structs(wide, structs)
    a = F.abs(F.col("r"))
    strength = (F.when(a >= 0.7, "Strong").when(a >= 0.4, "Moderate").when(a >= 0.2, "Weak")
                .when(a.isNotNull(), "Negligible"))
    return long.select(
        "column_name", "r", strength.alias("strength"),
        F.when(F.col("r") > 0, "positive").when(F.col("r").isNotNull(), "negative").alias("direction"),
        F.coalesce((a * 20).cast("int"), F.lit(0)).alias("bar"),
    ).orderBy(F.coalesce(a, F.lit(0.0)).desc(), "column_name")


def screen_features(corr: DataFrame, threshold: float = 0.4) -> DataFrame:
    """AGG-13: keep when |r| >= threshold, otherwise (or NULL r) caution."""
    return corr.select(
        "column_name", "r",
        F.when(F.abs("r") >= threshold, "keep").otherwise("caution").alias("decision"),
    )


def entity_summary(df: DataFrame, entity: str, col: str, digits: int = 1) -> DataFrame:
    """AGG-14: per entity: non-NULL count, rounded mean and max."""
    return df.groupBy(entity).agg(
        F.count(_c(col)).alias("readings"),
        F.round(F.avg(_c(col)), digits).alias("mean"),
        F.round(F.max(_c(col)), digits).alias("max"),
    )
