"""Near duplicates by Jaccard similarity of word n-grams, with count-vector R-trees.

A document is the set of its distinct ``n``-word shingles (64-bit hashes).
Shingles are hashed into ``GROUPS`` groups; a document's point is its count
per group. Two sets share at most the sum of the least counts per group, so
points whose sum is too small for the threshold are never compared.

An R-tree over all points alone cannot hold the work down: at this threshold
the search box of a point covers most of the space in any few dimensions (the
README has figures). So the points are first dealt to leaves of their own: a
pair over the threshold shares a shingle among the first
``size - ceil(threshold * size) + 1`` of each of its sets in any common order,
and the order puts frequent shingles (by a bounded sample) last. Documents
that share such a shingle form a bucket (equal buckets are one); each that still holds more
than one component gets an R-tree, packed by size and then by the counts, and
every member searches it. Survivors are verified on their whole sets.

Before that, each member of a bucket is tried against the bucket's hub only
(the member that shares most of its first shingles), which joins most copies
at the cost of one pair each, so that a large group of copies is never
expanded to all its pairs. A second bound tells most other pairs apart: per
each of ``FINE`` finer groups a point also has its count's parity, and groups
of unlike parity differ by a shingle at least. Sets of more than ``FINE``
shingles, whose parities in so few groups say nothing, have a second vector
with as many groups as shingles; of two such the longer is folded to the
shorter. Large buckets are
split by size class (a linked pair is in the same or the next class), then
into blocks of at most about ``BLOCK`` members. Equal sets are one node.

Those links suffice for the components, and all links are within one. The
links of a set are then counted exactly: the sets of each component of three
or more are dealt to blocks, and each pair of blocks counts the shingles that
its sets share, frequent ones by matrix products and rare ones pair by pair.
The work grows with the square of a group of unlike near copies.

Edge cases: null, empty and word-less texts have no shingles and no links;
texts of fewer than ``n`` words are one shingle; repeated rows are copies of
each other; rows with a null id take part, but a component's id is its least
id that is not null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_rows
from .graph import components

GROUPS, FINE, FANOUT, BLOCK = 64, 2048, 16, 2048
#: Groups up to this many members are bounded pair by pair; a tree would be one leaf or two.
LEAF = 48
_WIDTH = GROUPS + FINE // 8
#: Texts looked at for the order of shingles, and in how many of them a frequent shingle is found; the results do not depend on either.
SAMPLE, FREQUENT, TABLE = 8000, 3, 22
#: Sets and shingles of a block in which links are counted; shingles of more sets than ``RARE`` are counted by matrix products of ``WIDTH`` columns.
COUNTED, COUNTED_SHINGLES, RARE, WIDTH = 1024, 1 << 20, 32, 4096
#: Ids up to this many bytes are broadcast; beyond it the texts are shuffled.
BROADCAST = 8 << 20
_P, _Q = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        made = []
        for base in (_P, pow(_P, -1, 1 << 64)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        _POWERS[:] = made
    return _POWERS


def word_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z lower-cased: differences of a rolling sum, so no step per word."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    a = np.frombuffer(text.lower(), dtype=np.uint8)
    edge = np.diff(np.concatenate([[0], ((a != 32) & ((a < 9) | (a > 13))).astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(a))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * power[: len(a)])])
    h = (total[last] - total[first]) * inverse[first]
    h ^= h >> np.uint64(32)
    h *= np.uint64(_Q)
    return h ^ (h >> np.uint64(29))


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; fewer words are one shingle."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(n, len(w))
    h = w[: len(w) - n + 1].copy()
    for i in range(1, n):
        h *= np.uint64(_P)
        h ^= h >> np.uint64(31)
        h += w[i : len(w) - n + 1 + i]
    h *= np.uint64(_Q)
    h ^= h >> np.uint64(32)
    h += np.uint64(n)
    return np.unique(h)


def _node(x: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63)


def _point(x: np.ndarray) -> bytes:
    """Counts per group, 255 for that many or more; then, per each of ``FINE`` finer groups, whether its count is odd."""
    fine = np.bincount((x >> np.uint64(40)).astype(np.int64) % FINE, minlength=FINE)
    return np.minimum(fine.reshape(GROUPS, -1).sum(axis=1), 255).astype(np.uint8).tobytes() + np.packbits(fine & 1).tobytes()


def _wide(x: np.ndarray) -> bytes | None:
    """Parities in a power of two of groups, as many as shingles or more, of a set of more than ``FINE``."""
    if len(x) <= FINE:
        return None
    width = 1 << min(24, (len(x) - 1).bit_length())
    return np.packbits(np.bincount((x >> np.uint64(40)).astype(np.int64) % width, minlength=width) & 1).tobytes()


def wide_apart(a: bytes, b: bytes) -> int:
    """Groups of unlike parity of two vectors of ``_wide``; the longer one is folded (parities of merged groups add up)."""
    x, y = sorted((np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def _points(column) -> tuple[np.ndarray, np.ndarray]:
    """Counts (rows x GROUPS) and odd bits (rows x 64-bit words) of a binary column."""
    x = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, _WIDTH)
    return x[:, :GROUPS], np.ascontiguousarray(x[:, GROUPS:]).view(np.uint64)


def may_link(sizes: np.ndarray, odd_a: np.ndarray, odd_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of total size ``sizes`` may link: a group whose parity differs holds a shingle that only one set has."""
    apart = np.bitwise_count(odd_a ^ odd_b).sum(axis=-1, dtype=np.int64)
    return (100 + percent) * (sizes - apart) >= 2 * percent * sizes


def most_shared(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Upper bounds of the sizes of intersections: sums of least counts (no bound where a count is off the scale in both)."""
    least = np.minimum(points, point)
    return np.where((least == 255).any(axis=-1), 1 << 40, least.sum(axis=-1, dtype=np.int64))


class RTree:
    """Packed R-tree of (size, point) rows; inner nodes hold the least and greatest size and the greatest counts."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray):
        by = np.lexsort((*[points[:, g] for g in np.argsort(points.std(axis=0))[-2:]], sizes))
        self.order = by
        self.levels = [(sizes[by], sizes[by], points[by])]
        while len(self.levels[-1][0]) > FANOUT:
            low, high, top = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(top, at, axis=0)))

    def search(self, size: int, point: np.ndarray, percent: int) -> np.ndarray:
        """Rows that may reach the threshold with (size, point)."""
        rows = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            low, high, top = (x[rows] for x in self.levels[depth])
            near = (100 * high >= percent * size) & (100 * size >= percent * low)
            # intersection i of sizes s, t passes if (100 + percent) * i >= percent * (s + t)
            rows, low, top = rows[near], low[near], top[near]
            rows = rows[(100 + percent) * most_shared(top, point) >= percent * (size + low)] if len(rows) else rows
            if depth:
                rows = (rows[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                rows = rows[rows < len(self.levels[depth - 1][0])]
        return self.order[rows]


def _frequent(docs: DataFrame, n: int) -> np.ndarray:
    """Table by low hash bits: True for shingles found in several texts of a bounded sample."""
    total = docs.count()
    share = int((1 << 20) * min(1.0, SAMPLE / max(1, total)))
    sample = docs.where(F.pmod(F.xxhash64(F.lit(31), "t"), F.lit(1 << 20)) < share) if share < 1 << 20 else docs

    def work():
        def rows(cols):
            found = [shingles(t, n) for t in cols[0]]
            low, count = np.unique(np.concatenate([*found, np.empty(0, np.uint64)]) & np.uint64((1 << TABLE) - 1), return_counts=True)
            return zip(low.tolist(), count.tolist(), strict=True)

        return rows

    low = map_rows(sample.select("t"), "k bigint, c bigint", work).groupBy("k").agg(F.sum("c").alias("c")).where(F.col("c") >= FREQUENT)
    out = np.zeros(1 << TABLE, dtype=bool)  # the answer has at most that many rows
    out[low.select("k").toArrow().column(0).to_numpy()] = True
    return out


def _first_shingles(x: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    k = len(x) - -(-percent * len(x) // 100) + 1
    late = frequent[(x & np.uint64((1 << TABLE) - 1)).astype(np.int64)]
    return np.concatenate([x[~late], x[late]])[:k]


def _passing(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and points allow a link, with sizes and text hashes of both."""
    of = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("t").alias(f"t{c}"), F.col("point").alias(f"p{c}"), F.col("wide").alias(f"w{c}"))
    rows = pairs.join(of("a"), "a").join(of("b"), "b").where((100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na")))
    rows = rows.select("a", "b", "na", "nb", "ta", "tb", "pa", "pb", "wa", "wb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if not x.num_rows:
                continue
            (p, odd_p), (q, odd_q) = (_points(x.column(c)) for c in ("pa", "pb"))
            size = x.column("na").to_numpy() + x.column("nb").to_numpy()
            keep = ((100 + percent) * most_shared(p, q) >= percent * size) & may_link(size, odd_p, odd_q, percent)
            wide = keep & (x.column("wa").is_valid().to_numpy(zero_copy_only=False) & x.column("wb").is_valid().to_numpy(zero_copy_only=False))
            for i in np.flatnonzero(wide):
                apart = wide_apart(x.column("wa")[i].as_py(), x.column("wb")[i].as_py())
                keep[i] = (100 + percent) * (int(size[i]) - apart) >= 2 * percent * int(size[i])
            yield x.filter(pa.array(keep)).select(["a", "b", "na", "nb", "ta", "tb"])

    return rows.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, ta bigint, tb bigint")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs over the threshold, on their whole sets; only texts that are still in a pair are read as sets again."""
    left = cut(_passing(pairs, nodes, percent))
    wanted = cut(left.select(F.col("ta").alias("h")).unionAll(left.select(F.col("tb").alias("h"))).distinct())
    small = wanted.count() * 16 <= BROADCAST
    texts = docs.join(F.broadcast(wanted) if small else wanted, "h", "left_semi").select("h", "t")

    def work():
        done: set[int] = set()

        def rows(cols):
            for h, t in zip(*cols, strict=True):
                if h not in done:  # copies in one task are told apart once
                    done.add(h)
                    x = shingles(t, n)
                    yield _node(x), x.view(np.int64)

        return rows

    # not cut: both joins take the sets from this one shuffle by node
    sets = map_rows(texts, "node bigint, s array<bigint>", work).groupBy("node").agg(F.first("s").alias("s"))
    a, b = (sets.select(F.col("node").alias(c), F.col("s").alias(f"s{c}")) for c in "ab")
    both = left.join(a, "a").join(b, "b").withColumn("k", F.size(F.array_intersect("sa", "sb")))
    return cut(both.where(100 * F.col("k") >= percent * (F.col("na") + F.col("nb") - F.col("k"))).select("a", "b"))


def _bucket_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that survive the R-tree search of their bucket.

    ``rows``: tok, node, comp, n, point, c (bucket size). A bucket of up to
    ``BLOCK`` members is one group. In a larger one a row goes to the group of
    its size class and that of the class below, in its block with every block.
    """
    base = float(np.log(100 / (percent - 1)))  # a little more than a linked pair's ratio
    large = F.col("c") > BLOCK
    rows = rows.withColumns({"cls": F.when(large, F.floor(F.log("n") / base)).otherwise(0), "nb": F.ceil(F.col("c") / BLOCK).cast("int")})
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("nb").cast("bigint")).cast("int"))
    rows = rows.withColumn("g", F.explode(F.when(large, F.array("cls", F.col("cls") - 1)).otherwise(F.array("cls")))).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.select("tok", "g", F.least("own", "x").alias("b1"), F.greatest("own", "x").alias("b2"), "own", (F.col("cls") == F.col("g")).alias("home"), "node", "comp", "n", "point")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "tok", "g", "b1", "b2").sortWithinPartitions("tok", "g", "b1", "b2")

    def pairs_of(g: dict) -> list[tuple[int, int]]:
        home = np.flatnonzero(g["home"])
        if not len(home) or (g["comp"] == g["comp"][0]).all():
            return []
        if len(g["n"]) <= LEAF:
            x = g["n"][home]
            near = (100 * x >= percent * g["n"][:, None]) & (100 * g["n"][:, None] >= percent * x)
            near &= (100 + percent) * most_shared(g["point"][home], g["point"][:, None]) >= percent * (x + g["n"][:, None])
            left, right = np.nonzero(near)
            right = home[right]
        else:
            tree = RTree(g["n"][home], g["point"][home])
            found = [home[tree.search(int(n), point, percent)] for n, point in zip(g["n"], g["point"], strict=True)]
            left, right = np.repeat(np.arange(len(found)), [len(x) for x in found]), np.concatenate(found)
        keep = (g["comp"][left] != g["comp"][right]) & (g["own"][left] != g["own"][right] if g["b1"][0] != g["b2"][0] else True)
        left, right = left[keep], right[keep]
        keep = may_link(g["n"][left] + g["n"][right], g["odd"][left], g["odd"][right], percent)
        a, b = g["node"][left[keep]], g["node"][right[keep]]
        return list(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))

    names = ["tok", "g", "b1", "b2", "own", "home", "node", "comp", "n"]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        held: list[pa.RecordBatch] = []

        def groups(x: pa.Table, final: bool):
            """Ends of whole groups in ``x``; the last group waits for its other rows unless ``final``."""
            cols = {k: x.column(k).to_numpy() for k in names}
            cols["point"], cols["odd"] = _points(x.column("point"))
            change = np.zeros(len(cols["tok"]), dtype=bool)
            change[0] = True
            for k in names[:4]:
                change[1:] |= cols[k][1:] != cols[k][:-1]
            at = np.append(np.flatnonzero(change), len(change))
            for s, e in zip(at[: -1 if final else -2], at[1:], strict=False):
                if e - s > 1:
                    for p in pairs_of({k: v[s:e] for k, v in cols.items()}):
                        if p not in seen:
                            seen.add(p)
                            yield p
            if not final:
                rest.append(x.slice(at[-2]))

        def out(found):
            got = list(found)
            if len(seen) > 1_000_000:
                seen.clear()
            return pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in got], schema=schema)

        rest: list[pa.Table] = []
        for batch in batches:
            if batch.num_rows:
                x = pa.Table.from_batches([*held, batch])
                rest.clear()
                yield out(groups(x, False))
                held = rest[0].to_batches() if rest else []
        if held:
            yield out(groups(pa.Table.from_batches(held), True))

    return rows.mapInArrow(run, "a bigint, b bigint").distinct()


def shared_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of ``sets`` (each without repeats); the diagonal is not filled."""
    m = len(sets)
    out = np.zeros((m, m), dtype=np.float32)  # whole numbers below 2 ** 24
    of = np.repeat(np.arange(m), [len(x) for x in sets])
    values = np.concatenate(sets)
    by = np.argsort(values, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], np.diff(values[by]) != 0]))
    of, counts = of[by], np.diff(np.append(at, len(by)))
    for c in range(2, min(RARE, m) + 1):
        rows = of[at[counts == c][:, None] + np.arange(c)]
        left, right = np.triu_indices(c, 1)
        step = max(1, (1 << 22) // len(left))
        for k in range(0, len(rows), step):
            part = rows[k : k + step]  # ascending, since the sort is stable
            pair, times = np.unique(part[:, left].ravel() * m + part[:, right].ravel(), return_counts=True)
            out.ravel()[pair] += times
    out += out.T
    often = np.flatnonzero(counts > RARE)
    for k in range(0, len(often), WIDTH):
        part = often[k : k + WIDTH]
        has = np.zeros((m, len(part)), dtype=np.float32)
        column = np.repeat(np.arange(len(part)), counts[part])
        first = np.cumsum(counts[part]) - counts[part]
        has[of[at[part][column] + np.arange(len(column)) - first[column]], column] = 1
        out += has @ has.T
    return out


def _count_links(nodes: DataFrame, comp: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """node, n_links of the nodes of components (``comp``) of more than two."""
    of = nodes.select("node", "n", F.col("t").alias("h")).join(comp, "node")
    blocks = of.groupBy("comp").agg(F.count("*").alias("m"), F.sum("n").alias("s")).where("m > 2")
    blocks = blocks.select("comp", F.greatest(F.ceil(F.col("m") / COUNTED), F.ceil(F.col("s") / COUNTED_SHINGLES)).cast("int").alias("nb"))
    wanted = cut(of.join(blocks, "comp").select("h", "node", "comp", "nb"))
    small = wanted.count() * 40 <= BROADCAST
    texts = docs.select("h", "t").join(F.broadcast(wanted) if small else wanted, "h").select("t", "node", "comp", "nb")

    def work():
        done: set[int] = set()

        def rows(cols):
            for t, node, c, nb in zip(*cols, strict=True):
                if node not in done:  # copies in one task are told apart once
                    x = shingles(t, n)
                    if _node(x) == node:
                        done.add(node)
                        yield node, c, nb, x.tobytes()

        return rows

    rows = map_rows(texts, "node bigint, comp bigint, nb int, s binary", work)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("nb").cast("bigint")).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.select("comp", F.least("own", "x").alias("b1"), F.greatest("own", "x").alias("b2"), "own", "node", "s")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "comp", "b1", "b2").sortWithinPartitions("comp", "b1", "b2")

    def linked(key: tuple, group: dict) -> Iterator[tuple[int, int]]:
        shared = shared_shingles([x for _, x in group.values()]).astype(np.int64)
        own, size = np.array([o for o, _ in group.values()]), np.array([len(x) for _, x in group.values()])
        link = 100 * shared >= percent * (size[:, None] + size - shared)
        if key[1] != key[2]:
            link &= own[:, None] != own
        np.fill_diagonal(link, False)
        return zip(group, link.sum(axis=1).tolist(), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("k", pa.int64())])
        made = lambda key, group: pa.RecordBatch.from_pylist([{"node": a, "k": k} for a, k in linked(key, group)], schema=schema)
        key, group = None, {}
        for batch in batches:
            keys = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            for i, (*of_row, own, node) in enumerate(keys):
                if of_row != key:
                    if len(group) > 1:
                        yield made(key, group)
                    key, group = of_row, {}
                if node not in group:  # copies from other tasks
                    group[node] = (own, np.frombuffer(batch.column(5)[i].as_py(), dtype=np.uint64))
        if len(group) > 1:
            yield made(key, group)

    return rows.mapInArrow(run, "node bigint, k bigint").groupBy("node").agg(F.sum("k").alias("n_links"))


def near_duplicates(docs: DataFrame, n: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text", count_links: bool = True) -> DataFrame:
    """One row per document: doc_id, n_shingles, n_links (other distinct sets that its set links with), component_id.

    Without ``count_links`` there is no n_links, for callers that only need the components.
    """
    docs = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).withColumn("h", F.xxhash64("t"))
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, n))  # 2 ** TABLE bytes

    def work():
        def rows(cols):
            for d, t, h in zip(*cols, strict=True):
                x = shingles(t, n)
                yield (d, h, len(x), _node(x), _first_shingles(x, frequent.value, percent).view(np.int64), _point(x), _wide(x)) if len(x) else (d, h, 0, None, None, None, None)

        return rows

    id_type = docs.schema["d"].dataType.simpleString()
    held = cut(map_rows(docs.select("d", "t", "h"), f"d {id_type}, t bigint, n bigint, node bigint, first array<bigint>, point binary, wide binary", work))
    nodes = cut(held.where("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first(F.size("first")).alias("k"), F.first("point").alias("point"), F.first("wide").alias("wide"), F.min("t").alias("t"), F.min("d").alias("d")))
    # one shuffle by shingle serves the counts and the join (few shingles repeat within a task, so combining first saves nothing)
    found = held.where("node is not null").select(F.explode("first").alias("tok"), "node").where("tok is not null").repartition("tok")
    # shingles of one passage have the same members: of buckets alike by size and hash sums one is kept, with how many it stands for
    part = F.xxhash64("node")
    shared = found.groupBy("tok").agg(F.min("node").alias("a"), F.max("node").alias("z"), F.count("*").alias("c"), F.sum(F.shiftrightunsigned(part, 32)).alias("u"), F.sum(part.bitwiseAND(F.lit((1 << 32) - 1))).alias("v")).where("a <> z")
    shared = shared.groupBy("a", "z", "c", "u", "v").agg(F.min("tok").alias("tok"), F.count("*").alias("w")).select("tok", "w")
    members = cut(found.join(shared, "tok").distinct())
    # a bucket's hub is the member that shares most of its first shingles: copies differ from each other more than from their model
    central = members.groupBy("node").agg(F.sum("w").alias("s")).join(nodes.select("node", "k"), "node").select("node", (F.col("s") * 1000000 / F.col("k")).cast("bigint").alias("s"))
    hubs = members.join(central, "node").groupBy("tok").agg(F.max(F.struct("s", "node"))["node"].alias("a"))
    star = members.join(hubs, "tok").where("a <> node").select("a", F.col("node").alias("b")).distinct()
    links = verified(star, nodes, docs, n, percent)
    comp = components(links)
    # buckets of two are done; of the others those with more than one component are searched
    of = members.select("tok", "node").join(comp, "node", "left").select("tok", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = of.groupBy("tok").agg(F.count("*").alias("c"), F.min("comp").alias("x"), F.max("comp").alias("y")).where("c > 2 and x <> y").select("tok", "c")
    rows = of.join(mixed, "tok").join(nodes.select("node", "n", "point"), "node")
    more = verified(_bucket_pairs(rows, percent), nodes, docs, n, percent)
    every = links.unionAll(more).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    comp = components(every)
    least = nodes.select("node", "d").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    root = least.groupBy("comp").agg(F.min("d").alias("component_id"))
    label = least.join(root, "comp").select("node", "component_id")
    shown = [F.col("d").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("d")).otherwise(F.col("component_id")).alias("component_id")]
    if count_links:
        # a set of a component of two has one link
        counted = comp.select("node").join(cut(_count_links(nodes, comp, docs, n, percent)), "node", "left").select("node", F.coalesce("n_links", F.lit(1)).alias("n_links"))
        label = label.join(counted, "node", "left")
        shown.insert(2, F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return held.select("d", "n", "node").join(label, "node", "left").select(*shown)
