"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.session import materialize

from .common import shared_folder


def components(links: DataFrame) -> DataFrame:
    """node, comp (least node of its component) for the nodes of ``links`` (columns a, b of type long, not null).

    Rounds: each node points to its least neighbour if that is less than
    itself; pointers are followed to their roots by repeated self-joins (each
    doubles the distance covered); links are rewritten to roots and those
    within a root are dropped. Every round at least halves the nodes that
    still have links. Neighbours are only ever reduced to a minimum, so a hub
    with any number of links is combined before the shuffle.

    Each table is written to the shared folder as Parquet and read again, so that
    Spark knows its size. A checkpoint hands on the estimate instead, and every
    join multiplies those of its sides: their digits double with each step, and
    after some rounds they fill the driver.
    """
    shared_folder(links.sparkSession)
    both = lambda x: x.select("a", "b").unionAll(x.select(F.col("b").alias("a"), F.col("a").alias("b")))
    left = materialize(links.where("a <> b").select("a", "b").distinct())
    known = materialize(both(left).select(F.col("a").alias("node")).distinct().withColumn("comp", F.col("node")))
    while not left.isEmpty():
        up = both(left).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("up"))
        up = materialize(up)
        while True:
            above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            nxt = materialize(up.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")))
            moved = not nxt.where("moved").isEmpty()
            up = nxt.drop("moved")
            if not moved:
                break
        known = materialize(known.join(up.select(F.col("node").alias("comp"), "up"), "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")))
        a, b = (up.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in "ab")
        left = materialize(left.join(a, "a").join(b, "b").select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).where("a <> b").distinct())
    return known
