"""Line deduplication by a suffix array over line ids, built by distributed prefix doubling.

A document is its sequence of lines with a word, stripped of white space at
both ends. A run is a sequence of consecutive lines; it is repeated if it
occurs at two places or more, and long if it has ``min_words`` words or more.
A line goes if it lies in an occurrence, other than the first one (by doc_id,
text, line), of a long repeated run. The first occurrence of any line's text
always stays.

Suffixes that start with a line found once can share no prefix, so only the
others are sorted. Ranks of windows of 1, 2, 4, ... lines are found by
doubling: the windows that start at a line get the rank of the pair (rank
here, rank half a window further) among all pairs found twice or more, in
their sorted order, by a range sort. That is the suffix array cut at the depth
of the window, and windows of equal rank are its intervals of a longest common
prefix of that many lines; windows found once drop out. A run of any length
between is named by the two ranks that cover it. For a long run it is enough
to look at the shortest long window that starts at each line and the shortest
that ends there: each repeated long run is the union of such windows, and
their length follows from their content. So the depth is bounded by
``min_words`` lines, not by the length of documents.

Each step is a shuffle of narrow rows; equal windows are counted before the
shuffle; no group of copies is gathered. Texts are read twice and joined once
with the places to delete.

Edge cases: null texts stay null and empty texts empty; repeated rows (same
doc_id and text) are one document and stay alike; null ids come first in the
order; blank lines go with the line before them; a text whose lines all go
becomes empty (the pipeline drops it); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, cut, fresh, map_rows, running_total

MIN_WORDS = 50
_HERE = ["d", "h"]


def line_windows(text: bytes | None, min_words: int) -> list[tuple[int, int, int, int, int]]:
    """Of each line with a word: its number, two 64-bit halves of its hash, and the lengths in lines of the shortest long windows that start and that end there (0: none)."""
    if not text:
        return []
    lines = [x for x in (y.strip() for y in text.split(b"\n")) if x]
    total = np.concatenate([[0], np.cumsum([len(x.split()) for x in lines], dtype=np.int64)])
    n = len(lines)
    ends = np.searchsorted(total, total[:-1] + min_words)
    starts = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    out = []
    for i, (line, e, s) in enumerate(zip(lines, ends.tolist(), starts.tolist(), strict=True)):
        x = xxhash.xxh3_128_intdigest(line)
        out.append((i, (x >> 64) - (1 << 63), (x & ((1 << 64) - 1)) - (1 << 63), e - i if e <= n else 0, i + 1 - s if s >= 0 else 0))
    return out


def _ranked(rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` (d, h, i, names...) whose names occur twice or more, with r: the rank of the names in sorted order."""
    twice = rows.groupBy(*names).agg(F.count("*").alias("c")).where("c > 1").select(*names, F.lit(1).cast("bigint").alias("one"))
    ranks = running_total(twice, [F.col(c) for c in names], "one", "r")
    return rows.join(ranks.drop("one"), names).select(*_HERE, "i", "r")


def suffix_ranks(lines: DataFrame, depth: int) -> list[DataFrame]:
    """Levels k = 0, 1, ...: (d, h, i, r) for windows of 2 ** k <= depth lines that occur twice or more."""
    levels = [cut(_ranked(lines.select(*_HERE, "i", "h1", "h2"), ["h1", "h2"]).dropDuplicates([*_HERE, "i"]))]
    while 2 ** len(levels) <= depth:
        last, half = levels[-1], 2 ** (len(levels) - 1)
        after = last.select(*_HERE, (F.col("i") - half).alias("i"), F.col("r").alias("r2"))
        pairs = last.withColumnRenamed("r", "r1").join(after, [*_HERE, "i"])
        nxt = cut(_ranked(pairs, ["r1", "r2"]))
        if nxt.isEmpty():
            break
        levels.append(nxt)
    return levels


def repeated_places(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """d, h, i, size: later occurrences of long repeated windows; ``docs`` has d (id), h (hash of the text), t."""

    def work():
        return lambda cols: [(d, h, *x) for d, h, t in zip(*cols, strict=True) for x in line_windows(t, min_words)]

    lines = cut(map_rows(docs.select("d", "h", "t"), "d bigint, h bigint, i int, h1 bigint, h2 bigint, f int, b int", work))
    levels = suffix_ranks(lines, min_words)
    deep = levels[0].withColumn("k", F.lit(0))
    for k, x in enumerate(levels[1:], 1):
        deep = deep.unionAll(x.withColumn("k", F.lit(k)))
    ends = lines.where("f > 0").select(*_HERE, "i", F.col("f").alias("size"))
    windows = ends.unionAll(lines.where("b > 0").select(*_HERE, (F.col("i") - F.col("b") + 1).alias("i"), F.col("b").alias("size"))).distinct()
    windows = windows.withColumn("k", F.floor(F.log2("size") + 1e-9).cast("int"))
    first = deep.select(*_HERE, "i", "k", F.col("r").alias("ra"))
    second = deep.select(*_HERE, F.col("i").alias("j"), "k", F.col("r").alias("rb"))
    named = windows.join(first, [*_HERE, "i", "k"]).withColumn("j", F.col("i") + F.col("size") - F.expr("cast(shiftleft(1, k) as int)")).join(second, [*_HERE, "j", "k"])
    named = cut(named.select(*_HERE, "i", "size", "ra", "rb"))
    place = F.struct("d", "h", "i")
    least = named.groupBy("size", "ra", "rb").agg(F.min(place).alias("first"))
    return named.join(least, ["size", "ra", "rb"]).where(place != F.col("first")).select(*_HERE, "i", "size")


def _without(text: bytes | None, places: list) -> tuple[str | None, int, int]:
    """The text without the lines of ``places``, its number of lines with a word, and how many of them went."""
    if not text:
        return (None if text is None else ""), 0, 0
    lines = text.split(b"\n")
    real = [i for i, x in enumerate(lines) if x.strip()]
    if not places:
        return text.decode(), len(real), 0
    gone = np.zeros(len(real) + 1, dtype=np.int64)
    for p in places:
        gone[p["i"]] += 1
        gone[p["i"] + p["size"]] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    kept, at, last = [], 0, False
    for i, x in enumerate(lines):
        if at < len(real) and real[at] == i:
            last = bool(gone[at])
            at += 1
        if not last:
            kept.append(x)
    text = b"" if gone.all() else b"\n".join(kept)
    return text.decode(), len(real), int(gone.sum())


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later copies of repeated lines deleted from ``text``, plus n_lines and n_deleted."""
    d, h, p = (fresh(docs, f"_{x}") for x in "dhp")
    keyed = docs.withColumns({d: F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(1 << 63))), h: F.xxhash64(text)})
    slim = keyed.select(F.col(d).alias("d"), F.col(h).alias("h"), F.col(text).alias("t"))
    places = repeated_places(slim, min_words).groupBy("d", "h").agg(F.collect_list(F.struct("i", "size")).alias(p))  # at most two a line of the document
    joined = keyed.join(places.withColumnsRenamed({"d": d, "h": h}), [d, h], "left").drop(d, h)

    def work():
        return lambda texts, places: [_without(*x) for x in zip(texts, places, strict=True)]

    out = append_columns(joined, [text, p], f"{text} string, n_lines int, n_deleted int", work, drop=(p,))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_deleted")], "n_lines", "n_deleted")
