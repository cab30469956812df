"""Exact deduplication by a tree merge of sorted digest runs.

Each input partition turns its texts, without white space, into digests and
sorts them into a run: one entry per digest with the best row (most code
points, then least id, then first row) and the number of rows. Runs are merged in
rounds along a binomial tree. After rounds that cover ``t`` levels, the
partitions of a block of ``2 ** t`` have dealt the digests among themselves by
their first ``t`` bits, so a partition holds one lane of the digests of its
whole block, as one sorted run. A round covers up to ``FAN_BITS`` levels at
once: a partition gets up to ``2 ** FAN_BITS`` runs, which are merged by
Spark's external sort (spilling, never held whole) and one streaming pass that
keeps the best row of equal digests and adds up their counts. After the last
round each partition holds one lane of all digests; no task ever gets more than
its lane, and a digest, however frequent, comes at most once from each run.

The best rows of groups of two and more then travel down the same tree: each
entry of a level is joined with the entry of the level above that it went into,
so one group is never answered to all partitions by one task. The rows meet
the answers by (partition, digest), which splits a hot group as the input was.

Equal digests count as equal texts only if the length in bytes and an
independent 64-bit hash agree too; otherwise the entries stay apart, at every
level.

The digested rows are narrow (about 100 bytes a row) and checkpointed in the shared
folder, which fixes their partitions; the levels above hang on shuffles alone, and
the way down reads the same shuffles again. A lost executor costs the tasks
whose shuffle output it had.

Edge cases: null texts count as empty, and all texts of white space alone are
one group; rows without an id come after those with one in the choice of the
row that stays, so ``keep_id`` is null only if the whole group has none;
repeated rows (same id and text) are rows of their own, exactly one row of a
group has ``kept``; very long texts are digested whole; an empty table gives no
rows; columns of the input that are named as the new ones are replaced, all
others pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append_columns, cut, fresh

#: Levels of the binomial tree that one exchange covers: up to 2 ** FAN_BITS runs meet in a merge.
FAN_BITS = 3
_SPACE = b" \t\n\x0b\x0c\r"
_KEY = ["k1", "k2", "k3", "k4", "v", "z"]


def digest_of(text: bytes | None) -> tuple[int, ...]:
    """Code points of the text, then of the text without white space: SHA-256 as four signed 64-bit numbers, another hash, the length in bytes."""
    text = text or b""
    bare = text.translate(None, _SPACE)
    sha = hashlib.sha256(bare).digest()
    words = [int.from_bytes(sha[i : i + 8], "big", signed=True) for i in (0, 8, 16, 24)]
    return len(text.decode()), *words, xxhash.xxh3_64_intdigest(bare) - (1 << 63), len(bare)


def _lane(bits: int) -> Column:
    """The first ``bits`` bits of the digest."""
    return F.shiftrightunsigned("k1", 64 - bits).cast("int") if bits else F.lit(0)


def _cell(block: Column, bits: int) -> Column:
    """Partition of an entry at the level of ``bits``: its block's lanes lie side by side."""
    return (F.shiftleft(block, bits) + _lane(bits)).cast("int")


def _merge(run: DataFrame) -> DataFrame:
    """One entry per (cell, digest): the first row in the order of preference, and the sum of the counts."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            b = pa.RecordBatch.from_arrays(b.columns, names=b.schema.names)  # all columns nullable, as in what is held
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            if not b.num_rows:
                continue
            keys = np.column_stack([b.column(k).to_numpy() for k in ["c", *_KEY]])
            first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            total = np.add.reduceat(b.column("n").to_numpy(), first)
            best = b.take(pa.array(first))
            best = best.set_column(best.schema.get_field_index("n"), "n", pa.array(total))
            yield best.slice(0, len(first) - 1)
            held = best.slice(len(first) - 1)  # the next batch may go on with this digest
        if held is not None:
            yield held

    order = [F.col(c) for c in ["c", *_KEY]] + [F.col("m").desc(), F.col("i").asc_nulls_last(), F.col("r")]
    return run.sortWithinPartitions(*order).mapInArrow(go, run.schema)


def tree(rows: DataFrame, partitions: int, fan_bits: int = FAN_BITS) -> list[tuple[int, DataFrame]]:
    """Levels (bits, runs), from the runs of the input partitions to the lanes of all digests.

    ``rows``: c (input partition), the digest's columns, m (code points), i
    (id), r (row), n (count), in their input partitions.
    """
    last = max(0, partitions - 1).bit_length()
    levels = [(0, _merge(rows))]
    while levels[-1][0] < last:
        bits, run = levels[-1]
        to = min(last, bits + fan_bits)
        moved = run.withColumn("c", _cell(F.shiftright(F.col("c"), to), to))
        cells = -(-partitions >> to) << to
        levels.append((to, _merge(moved.repartitionById(cells, "c"))))
    return levels


def answers(levels: list[tuple[int, DataFrame]]) -> DataFrame:
    """c (input partition), the digest's columns, keep_i, keep_r, size: the groups of two rows and more, for each partition that has rows of them."""
    bits, top = levels[-1]
    found = top.where("n > 1").select("c", *_KEY, F.col("i").alias("keep_i"), F.col("r").alias("keep_r"), F.col("n").alias("size"))
    for lower, run in reversed(levels[:-1]):
        own = run.select(F.col("c").alias("own"), *_KEY, _cell(F.shiftright(F.col("c"), bits), bits).alias("c"))
        found = own.join(found, ["c", *_KEY]).select(F.col("own").alias("c"), *_KEY, "keep_i", "keep_r", "size")
        bits = lower
    return found


def mark_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fan_bits: int = FAN_BITS, drop: tuple = ()) -> DataFrame:
    """``docs`` (without the columns in ``drop``) plus keep_id, group_size, kept, text_sha256; one row per input row."""
    own = {k: fresh(docs, f"_{k}") for k in ("m", *_KEY)}
    p, r = fresh(docs, "_p"), fresh(docs, "_r")

    def work():
        return lambda texts: [digest_of(t) for t in texts]

    digested = append_columns(docs, [text], ", ".join(f"`{x}` bigint" for x in own.values()), work, tuple(d for d in drop if d != doc_id))
    rows = cut(digested)  # fixes the partitions, which the tree starts from
    rows = rows.withColumns({p: F.spark_partition_id(), r: F.monotonically_increasing_id()})
    start = rows.select(F.col(p).alias("c"), *[F.col(own[k]).alias(k) for k in _KEY], F.col(own["m"]).alias("m"), F.col(doc_id).alias("i"), F.col(r).alias("r"), F.lit(1).cast("bigint").alias("n"))
    found = answers(tree(start, rows.rdd.getNumPartitions(), fan_bits))
    names = {k: fresh(rows, f"_a_{k}") for k in found.columns}
    found = found.withColumnsRenamed(names)
    same = F.col(p) == F.col(names["c"])
    for k in _KEY:
        same = same & (F.col(own[k]) == F.col(names[k]))
    size = F.col(names["size"])
    sha = F.lower(F.concat(*[F.lpad(F.hex(F.col(own[k])), 16, "0") for k in _KEY[:4]]))
    out = rows.join(found, same, "left").withColumns({
        "keep_id": F.when(size.isNull(), F.col(doc_id)).otherwise(F.col(names["keep_i"])),
        "group_size": F.coalesce(size, F.lit(1).cast("bigint")),
        "kept": F.coalesce(F.col(names["keep_r"]) == F.col(r), F.lit(True)),
        "text_sha256": sha,
    })
    new = ("keep_id", "group_size", "kept", "text_sha256")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in (*new, *drop)], *new)


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    return mark_copies(docs, doc_id, text).where("kept").select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("keep_id", "group_size", "kept", "text_sha256")])
