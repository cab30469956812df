"""Importance shares, Pareto counts and importance documents (EXP-01..07, WIN-07/08,
FLT-04, SRT-04..06, AGG-17, SNK-05..07, FN-20).

``share_table`` is the general form: per group, each item's share (%) of the
group total, its rank by value, and the cumulative share along the rank --
with the reference's rule that the cumulative column sums the *rounded*
shares (Q11). It scales to any number of items per group (see ``ordering``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import POLLUTANT_KEYWORDS
from .joins import join_small
from .models import importance_values
from .ordering import global_rank, group_rank, running_sum, topk_per_group


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def share_table(df: DataFrame, item: str, value: str, group: list[str] | None = None, use_abs: bool = False,
                digits: int = 4, pct: str = "importance_pct", cum: str = "cumulative_pct") -> DataFrame:
    """WIN-07/08 + SRT-06: rank by value (or |value|) desc with the item name as tie-break,
    share of the group total (zero total -> 0) and cumulative share of rounded shares."""
    group = group or []
    v = F.abs(_c(value)) if use_abs else _c(value)
    base = df.withColumn("_v", v)
    if group:
        totals = base.groupBy(*group).agg(F.sum("_v").alias("_tot"))
        base = join_small(base, totals, group, "left")
    else:
        base = base.withColumn("_tot", F.lit(base.agg(F.sum("_v")).first()[0]))
    base = base.withColumn(
        pct, F.when(F.col("_tot") > 0, F.round(F.col("_v") / F.col("_tot") * 100, digits)).otherwise(0.0))
    ranked = global_rank(base, [F.col("_v").desc_nulls_last(), _c(item).asc()], "rank", group=group)
    out = running_sum(ranked, group, "rank", pct, "_cum").withColumn(cum, F.round("_cum", digits))
    return out.drop("_v", "_tot", "_cum")


def pareto_counts(shares: DataFrame, group: list[str] | None = None, thresholds=(80.0, 95.0),
                  cum: str = "cumulative_pct") -> DataFrame:
    """SRT-05: items needed to reach each threshold = min(count(cum <= t) + 1, n)."""
    group = group or []
    aggs = [F.count(F.lit(1)).alias("n")]
    for t in thresholds:
        aggs.append(F.count_if(F.col(cum) <= t).alias(f"_le{int(t)}"))
    g = shares.groupBy(*group).agg(*aggs)
    return g.select(*group, "n", *[F.least(F.col(f"_le{int(t)}") + 1, F.col("n")).alias(f"n_for_{int(t)}")
                                  for t in thresholds])


def keyword_mask(item: Column, keywords=POLLUTANT_KEYWORDS, mode: str = "substring") -> Column:
    """FLT-04: case-insensitive match of any keyword. ``substring`` is the reference rule
    (so 'co' matches 'Month_cos', Q10); ``token`` matches whole '_'/space/'.'-separated tokens."""
    kws = F.array(*[F.lit(k.lower()) for k in keywords])
    low = F.lower(item)
    if mode == "token":
        toks = F.split(low, r"[_\s]+")
        return F.exists(kws, lambda k: F.array_contains(toks, k))
    return F.exists(kws, lambda k: low.contains(k))


def keyword_subset(shares: DataFrame, item: str, keywords=POLLUTANT_KEYWORDS, group: list[str] | None = None,
                   mode: str = "substring") -> DataFrame:
    """FLT-04 + EXP-05: rows whose item matches a keyword, re-ranked from 1 in the old order."""
    group = group or []
    sub = shares.where(keyword_mask(_c(item), keywords, mode)).withColumnRenamed("rank", "orig_rank")
    return group_rank(sub, group, F.floor((F.col("orig_rank") - 1) / 4096), [F.col("orig_rank")], "rank")


def subset_share(subset: DataFrame, group: list[str] | None = None, pct: str = "importance_pct") -> DataFrame:
    """AGG-17: items and total share held by a subset."""
    group = group or []
    return subset.groupBy(*group).agg(F.count(F.lit(1)).alias("items"), F.sum(pct).alias("share_pct"))


def sign_counts(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """AGG-17: positive / negative counts (linear coefficients)."""
    return df.groupBy(*(group or [])).agg(F.count_if(_c(value) > 0).alias("positive"),
                                          F.count_if(_c(value) < 0).alias("negative"))


def top_bottom(shares: DataFrame, k: int, group: list[str] | None = None, bottom: bool = False,
               value: str = "rank") -> DataFrame:
    """SRT-04: top-k (or bottom-k) items per group by rank, via the salted top-k."""
    order = [F.col(value).desc()] if bottom else [F.col(value).asc()]
    return topk_per_group(shares, group or [], order, k, name="pos")


# ---------------------------------------------------------------------------
# Model importances
# ---------------------------------------------------------------------------

def importance_table(spark: SparkSession, model, features: list[str], model_name: str) -> DataFrame | None:
    """EXP-02/03/04: ranked table for a tree model (importance) or a linear model (signed
    coefficient + absolute value); None when the family is unsupported or lengths differ."""
    got = importance_values(model, len(features))
    if got is None:
        return None
    fam, vals = got
    raw = spark.createDataFrame([(model_name, f, float(v)) for f, v in zip(features, vals)],
                                "model string, feature string, value double")  # one row per feature
    if fam == "linear":
        t = raw.withColumnRenamed("value", "coefficient").withColumn("absolute_coefficient", F.abs("coefficient"))
        out = share_table(t, "feature", "absolute_coefficient", ["model"])
        return out.withColumn("importance", F.col("absolute_coefficient")).withColumn("family", F.lit(fam))
    out = share_table(raw.withColumnRenamed("value", "importance"), "feature", "importance", ["model"])
    return out.withColumn("family", F.lit(fam))


def training_importances(spark: SparkSession, results, features: list[str], scaled_features: list[str]):
    """EXP-06: one ranked importance table per trained model (unsupported families skipped),
    unioned into one table keyed by model."""
    out = None
    for r in results:
        t = importance_table(spark, r.model, scaled_features if r.uses_scaled else features, r.name)
        if t is None:
            continue
        t = t.select("model", "family", "feature", "importance", "rank", "importance_pct", "cumulative_pct")
        out = t if out is None else out.unionByName(t)
    return out if out is not None else empty_importance(spark).select(
        "model", "family", "feature", "importance", "rank", "importance_pct", "cumulative_pct")


def importance_document(imp: DataFrame, method: str) -> DataFrame:
    """SNK-05: one nested row per model: header fields + array of records in rank order
    (bounded by the model's feature count)."""
    rec = F.struct("rank", "feature", "importance", "importance_pct", "cumulative_pct")
    return imp.groupBy("model", "family").agg(
        F.count(F.lit(1)).alias("n_features"),
        F.array_sort(F.collect_list(rec)).alias("features"),
    ).withColumn("method", F.lit(method))


def dashboard_document(imp: DataFrame, lb_row: DataFrame) -> DataFrame:
    """SNK-06 + FN-20: top feature, its importance and share, first-10 names, summary
    fields (NULL without importances); joined to the model's leaderboard row (R2, score)."""
    top10 = F.transform(
        F.array_sort(F.collect_list(F.when(F.col("rank") <= 10, F.struct("rank", "feature")))),
        lambda s: s["feature"],
    )
    d = imp.groupBy("model").agg(
        F.min_by("feature", "rank").alias("top_feature"),
        F.min_by("importance", "rank").alias("top_importance"),
        F.min_by("importance_pct", "rank").alias("top_pct"),
        F.filter(top10, lambda x: x.isNotNull()).alias("top10"),
    )
    out = lb_row.select("model", "validation_r2", "engineering_score").join(d, "model", "left")
    fields = F.concat(F.lit("model "), F.col("model"), F.lit("; top feature "), F.col("top_feature"),
                      F.lit("; share "), F.format_string("%.2f", F.col("top_pct")), F.lit(" %"))
    return out.withColumn("summary", F.when(F.col("top_feature").isNotNull(), fields))


def empty_importance(spark: SparkSession) -> DataFrame:
    """SNK-07: schema-valid empty table."""
    return spark.createDataFrame([], "model string, feature string, importance double, rank int, "
                                     "importance_pct double, cumulative_pct double, family string")
