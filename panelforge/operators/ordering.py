"""Order-dependent operators that stay distributed (WIN-07, SRT-04, WIN-08 running sums).

* ``global_rank``: 1..n over a total order. Rows are range-partitioned on the
  order (sampling splits even a run of equal scores, because the tie-break makes
  the key unique), numbered inside their range, and offset by the sizes of the
  earlier ranges (one small table of per-range counts).
* ``group_rank``: 1..n inside each group, in blocks: rows are numbered within
  (group, block of the order key) and offset by the earlier blocks of the group.
* ``running_sum``: cumulative sum inside each group along an integer rank, the
  same way (block totals -> prefix sums -> in-block running sum).
* ``topk_per_group``: exact top k per group in two phases -- top k inside
  (group, salt) sub-groups, then top k of those few candidates per group.

None of them puts a whole group, or the whole table, into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .impute import materialize


def global_rank(df: DataFrame, order: list[Column], name: str = "rank", group: list[str] | None = None,
                partitions: int | None = None) -> DataFrame:
    """Position 1..n along ``order`` (a total order), optionally restarting per ``group``.

    Rows are range-partitioned on (group, order); each range is numbered locally and
    offset by the rows of the same group in earlier ranges. The offset table has at
    most (#ranges + #groups) rows.
    """
    group = group or []
    n = partitions or max(df.sparkSession.sparkContext.defaultParallelism, 1)
    keys = [F.col(g).asc() for g in group] + list(order)
    # one range sort; written sorted, so a row's place in its range is its place in the file
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    place = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    ranged = materialize(place)
    counts = ranged.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_pn"), F.min("_at").alias("_first"))
    wo = Window.partitionBy(*group).orderBy("_pid") if group else Window.orderBy("_pid")
    offs = counts.select(
        "_pid", *group,
        (F.coalesce(F.sum("_pn").over(wo.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_first")).alias("_off"),
    )
    same = F.lit(True)
    offs = offs.withColumnsRenamed({g: f"_g{i}" for i, g in enumerate(group)}).withColumnRenamed("_pid", "_p2")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = ranged.join(offs, (F.col("_pid") == F.col("_p2")) & same).withColumn(name, F.col("_off") + F.col("_at") + 1)
    return out.drop("_pid", "_p2", "_off", "_at", *[f"_g{i}" for i in range(len(group))])


def group_rank(df: DataFrame, group: list[str], block: Column, order: list[Column], name: str = "rank") -> DataFrame:
    """Position 1..n inside each group along ``order``; ``block`` must be a coarse,
    order-compatible key (rows of an earlier block always come first)."""
    base = df.withColumn("_blk", block)
    counts = base.groupBy(*group, "_blk").agg(F.count(F.lit(1)).alias("_bn"))
    w = Window.partitionBy(*group).orderBy("_blk")
    offs = counts.withColumn(
        "_off", F.coalesce(F.sum("_bn").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("_bn")
    within = F.row_number().over(Window.partitionBy(*group, "_blk").orderBy(*order))
    return base.join(offs, [*group, "_blk"]).withColumn(name, (F.col("_off") + within).cast("bigint")).drop(
        "_blk", "_off")


def running_sum(df: DataFrame, group: list[str], rank: str, value: str, name: str, block_size: int = 4096) -> DataFrame:
    """Cumulative sum of ``value`` along the integer ``rank`` inside each group."""
    base = df.withColumn("_blk", F.floor((F.col(rank) - 1) / block_size))
    tot = base.groupBy(*group, "_blk").agg(F.sum(value).alias("_bs"))
    w = Window.partitionBy(*group).orderBy("_blk")
    offs = tot.withColumn(
        "_off", F.coalesce(F.sum("_bs").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ).drop("_bs")
    within = F.sum(value).over(
        Window.partitionBy(*group, "_blk").orderBy(rank).rowsBetween(Window.unboundedPreceding, 0))
    return base.join(offs, [*group, "_blk"]).withColumn(name, F.col("_off") + within).drop("_blk", "_off")


def topk_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, salts: int = 64,
                   salt_key: Column | None = None, name: str = "rank") -> DataFrame:
    """Exact top ``k`` rows per group (with their rank 1..k) along ``order``."""
    h = F.xxhash64(salt_key) if salt_key is not None else F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    salt = F.pmod(h, F.lit(salts))
    s = df.withColumn("_salt", salt)
    first = s.withColumn("_r1", F.row_number().over(Window.partitionBy(*group, "_salt").orderBy(*order)))
    cand = first.where(F.col("_r1") <= k).drop("_r1", "_salt")  # <= salts * k rows per group
    ranked = cand.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col(name) <= k)
