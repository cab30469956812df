"""Target-distribution importance resampling with a head-tail vocabulary.

Features of a text are its runs of one to three words; a feature's bucket is
the CRC-32 of its bytes modulo ``buckets``. A bucket's gain is the logarithm of
its smoothed share among the target's features over that among all texts; a
text's weight is the sum of the gains of its features, and the ``percent`` texts
with the highest weight plus Gumbel noise (from a hash of the id) are drawn.

Most words and pairs of a corpus are few. The *head*, found in one pass by
mergeable frequency summaries (every word and pair above a fixed share of a
partition's words is in them), is broadcast: for each head word the exact CRC
states of the word and of the word after a space, and for each head pair its
CRC state, so its bucket needs no bytes at all. Everything else is *tail* and takes
direct CRC: tail words from their bytes, tail pairs and all runs of three by
carrying on the state of the run before over the word added (CRC is linear, so
states go on over a whole array of words at once). Both give the same exact
numbers, so which words are in the head is a matter of speed only, and every
feature is counted.

Bucket totals are summed per task and then per bucket; the table of gains
(``buckets`` numbers) is broadcast. The head's size is bounded by parameters.
The draw is one range sort of narrow rows.

Edge cases: null, empty and word-less texts have no features, weight 0 and
are not drawn; repeated rows count and are scored as rows of their own; a null
id draws as the empty text and comes last among ties; an empty target or an
empty table gives gains from the smoothing alone; very long texts are taken
whole; columns of the input that are named as the new ones are replaced, all others pass.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import append_columns, as_bytes, cut, fresh, running_total, slices, small_batches

BUCKETS = 10_000
#: Bounds of the broadcast head, and of the entries that a summary of a partition holds.
HEAD_WORDS, HEAD_PAIRS, SUMMARY = 8192, 32768, 1 << 17
_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_NORMAL = bytes(b if b in _KEEP else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_DDL = "kind int, word string, second string, n bigint"


def words_of(text: bytes | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased."""
    return text.translate(_NORMAL).split() if text else []


# --- CRC states over arrays


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


class Shift:
    """What a CRC state becomes over ``length`` zero bytes, for arrays of states and lengths: crc(ab) = shift(crc(a), len(b)) ^ crc(b)."""

    def __init__(self):
        step = _byte_table()
        x = np.arange(256, dtype=np.uint32)
        one = np.stack([x << np.uint32(8 * i) for i in range(4)])  # length 0: the state itself, by byte
        self._step, self.tables = step, one[None].astype(np.uint32)

    def _grow(self, most: int) -> None:
        if most < len(self.tables):
            return
        rows = [self.tables]
        last = self.tables[-1]
        for _ in range(len(self.tables), most + 1):
            last = (last >> np.uint32(8)) ^ self._step[last & np.uint32(255)]
            rows.append(last[None])
        self.tables = np.concatenate(rows)

    def __call__(self, state: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = np.empty(len(state), dtype=np.uint32)
        near = length <= 64
        self._grow(min(64, int(length.max(initial=0))))
        s, n = state[near], length[near]
        t = self.tables
        out[near] = t[n, 0, s & 255] ^ t[n, 1, (s >> 8) & 255] ^ t[n, 2, (s >> 16) & 255] ^ t[n, 3, s >> 24]
        for i in np.flatnonzero(~near):  # words of more than 64 bytes: by squaring
            out[i] = self._far(int(state[i]), int(length[i]))
        return out

    def _far(self, state: int, length: int) -> int:
        self._grow(64)
        rest = length % 64
        t = self.tables
        go = lambda s, n: int(t[n, 0, s & 255] ^ t[n, 1, (s >> 8) & 255] ^ t[n, 2, (s >> 16) & 255] ^ t[n, 3, s >> 24])
        state = go(state, rest)
        columns = [go(1 << i, 64) for i in range(32)]  # the operator of 64 bytes as a matrix
        times = length // 64
        while times:
            if times & 1:
                state = _apply(columns, state)
            columns = [_apply(columns, c) for c in columns]
            times >>= 1
        return state


def _apply(columns: list[int], state: int) -> int:
    out, i = 0, 0
    while state:
        if state & 1:
            out ^= columns[i]
        state >>= 1
        i += 1
    return out


# --- the head


class Head:
    """Broadcast states of frequent words and pairs; ``states`` gives the CRCs of all features of some texts."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]]):
        self.ids = {w: i for i, w in enumerate(words)}
        self.alone = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
        self.spaced = np.array([zlib.crc32(b" " + w) for w in words], dtype=np.uint32)
        self.length = np.array([len(w) + 1 for w in words], dtype=np.int64)
        self.size = len(words)
        known = sorted((self.ids[a] * self.size + self.ids[b], zlib.crc32(a + b" " + b)) for a, b in pairs if a in self.ids and b in self.ids)
        self.pair_keys = np.array([k for k, _ in known], dtype=np.int64)
        self.pair_states = np.array([s for _, s in known], dtype=np.uint32)

    def features(self, words: list[bytes], sizes: np.ndarray, shift: Shift) -> list[tuple[np.ndarray, np.ndarray]]:
        """For runs of one, two and three words: (CRC of each run, number of its text). ``sizes``: words of each text."""
        if not words:
            return []
        get = self.ids.get
        tail: dict[bytes, int] = {}
        put = tail.setdefault
        at = np.array([i if (i := get(w)) is not None else self.size + put(w, len(tail)) for w in words], dtype=np.int64)
        unseen = list(tail)
        alone = np.concatenate([self.alone, np.array([zlib.crc32(w) for w in unseen], dtype=np.uint32)])
        spaced = np.concatenate([self.spaced, np.array([zlib.crc32(b" " + w) for w in unseen], dtype=np.uint32)])
        length = np.concatenate([self.length, np.array([len(w) + 1 for w in unseen], dtype=np.int64)])
        text = np.repeat(np.arange(len(sizes)), sizes)
        one = alone[at]
        out = [(one, text)]
        inner = np.flatnonzero(text[1:] == text[:-1])  # a pair starts here
        first, second = at[inner], at[inner + 1]
        two = np.empty(len(inner), dtype=np.uint32)
        in_head = np.zeros(len(inner), dtype=bool)
        if len(self.pair_keys):
            both = np.flatnonzero((first < self.size) & (second < self.size))
            keys = first[both] * self.size + second[both]
            place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            hit = self.pair_keys[place] == keys
            two[both[hit]] = self.pair_states[place[hit]]
            in_head[both[hit]] = True
        rest = ~in_head
        two[rest] = shift(one[inner[rest]], length[second[rest]]) ^ spaced[second[rest]]
        out.append((two, text[inner]))
        third = np.flatnonzero(text[2:] == text[:-2])
        by_start = np.full(len(at), -1, dtype=np.int64)
        by_start[inner] = np.arange(len(inner))
        added = at[third + 2]
        out.append((shift(two[by_start[third]], length[added]) ^ spaced[added], text[third]))
        return out


def _prune(seen: Counter, most: int) -> Counter:
    """Misra-Gries: what is left after the count of the ``most``-th entry is taken from all."""
    if len(seen) <= most:
        return seen
    level = np.partition(np.fromiter(seen.values(), dtype=np.int64, count=len(seen)), -most)[-most]
    return Counter({k: v - level for k, v in seen.items() if v > level})


def find_head(docs: DataFrame, text: str = "text", words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS, summary: int = SUMMARY) -> Head:
    """The head of a corpus: frequency summaries of its partitions, merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Counter(), Counter()
        for b in batches:
            for part in slices(b):
                for t in as_bytes(part.column(0)):
                    w = words_of(t)
                    one.update(w)
                    two.update(zip(w, w[1:], strict=False))
                    if len(one) > 2 * summary:
                        one = _prune(one, summary)
                    if len(two) > 2 * summary:
                        two = _prune(two, summary)
        rows = [(1, w.decode(), "", n) for w, n in one.most_common(words)] + [(2, a.decode(), b.decode(), n) for (a, b), n in two.most_common(pairs)]
        if rows:
            kind, word, second, n = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(word), pa.array(second), pa.array(n, pa.int64())], names=["kind", "word", "second", "n"])

    small_batches(docs.sparkSession)
    merged = cut(docs.select(F.col(text)).mapInArrow(run, _DDL).groupBy("kind", "word", "second").agg(F.sum("n").alias("n")))
    # a histogram of the counts gives the least count of a head of bounded size: what the driver gets doesn't grow with the partitions
    level = F.floor(F.log2("n") * 64).cast("int")
    histogram = merged.groupBy("kind", level.alias("level")).count().collect()
    head = {}
    for kind, most in ((1, words), (2, pairs)):
        total, least = 0, None
        for r in sorted((r for r in histogram if r["kind"] == kind), key=lambda r: -r["level"]):
            total += r["count"]
            if total > most:
                break
            least = r["level"]
        own = [] if least is None else merged.where((F.col("kind") == kind) & (level >= least)).select("word", "second").collect()
        head[kind] = sorted((r["word"].encode(), r["second"].encode()) for r in own)
    return Head([w for w, _ in head[1]], head[2])


# --- totals, gains, draw


def bucket_totals(texts: DataFrame, head, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Number of features of all texts in each bucket; ``head`` is a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, total = Shift(), np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for part in slices(b):
                split = [words_of(t) for t in as_bytes(part.column(0))]
                for crc, _ in head.value.features([w for x in split for w in x], np.array([len(x) for x in split]), shift):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(total[own])], names=["bucket", "n"])

    found = texts.select(F.col(text)).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in found.collect():  # at most one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(share of the target / share of all texts)) of each bucket, both smoothed by one."""
    n, all_raw, all_target = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_raw + n) / ((s + 1.0) * (all_target + n)))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def noise(doc_id, seed: int) -> int:
    """floor(1000 * Gumbel noise) from a hash of the id."""
    shown = "" if doc_id is None else doc_id.decode() if isinstance(doc_id, bytes) else str(doc_id)
    h = int.from_bytes(hashlib.sha256(f"{seed}:{shown}".encode()).digest()[:4], "big")
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42, buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS, drop: tuple = ()) -> DataFrame:
    """``docs`` (without the columns in ``drop``) plus n_features, weight, score and rank (1, 2, ... of the drawn, else null)."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    head = spark.sparkContext.broadcast(find_head(docs, text, head_words, head_pairs))
    table = spark.sparkContext.broadcast(gains(bucket_totals(docs, head, text, buckets), bucket_totals(target, head, target_text, buckets)))
    enough, order, one, at = (fresh(docs, f"_{x}") for x in ("enough", "order", "one", "at"))

    def work():
        shift = Shift()

        def rows(ids, texts):
            split = [words_of(t) for t in texts]
            sizes = np.array([len(x) for x in split])
            weight, n = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
            for crc, own in head.value.features([w for x in split for w in x], sizes, shift):
                gain = table.value[crc % np.uint32(buckets)]
                weight += np.bincount(own, weights=gain, minlength=len(texts)).astype(np.int64)  # sums below 2 ** 53 are exact
                n += np.bincount(own, minlength=len(texts))
            return [(f, w, w + noise(d, seed), s >= min_words) for d, f, w, s in zip(ids, n.tolist(), weight.tolist(), sizes.tolist(), strict=True)]

        return rows

    scored = cut(append_columns(docs, [doc_id, text], f"n_features bigint, weight bigint, score bigint, `{enough}` boolean", work, tuple(d for d in drop if d != doc_id)))
    drawn = scored.where(F.col(enough)).count() * percent // 100
    keyed = scored.withColumns({order: F.monotonically_increasing_id(), one: F.lit(1).cast("bigint")})
    placed = running_total(keyed, [F.col(enough).desc(), F.col("score").desc(), F.col(doc_id).asc_nulls_last(), F.col(order)], one, at)
    rank = F.when(F.col(enough) & (F.col(at) < drawn), F.col(at) + 1)
    out = placed.withColumn("rank", rank)
    new = ("n_features", "weight", "score", "rank")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in (*new, *drop)], *new)
