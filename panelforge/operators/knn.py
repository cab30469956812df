"""Exact k-nearest-neighbour imputation with pruned donor search (IMP-01..03, JOIN-08).

The rule (NaN-Euclidean nearest neighbours):

* distance between rows x, y over the columns present in both (the shared set S):
  ``d = sqrt(p / |S| * sum_{i in S} (x_i - y_i)^2)`` (p = number of columns);
* for a missing cell (x, j) the donors are training rows that have column j;
  the value is the plain mean of the k nearest donors with a finite distance
  (ties broken by the donor key); no such donor -> the training mean of j.

Donors lie in *buckets*: by missing pattern first, then by median cuts of the widest column,
until a bucket has about ``BUCKET`` rows. The cuts are placed on a bounded sample; every
donor is then put into its bucket, and one aggregate over all donors gives each bucket's
directory entry: rows, rows per column, least and greatest value per column. From it
follows a lower bound on the distance of a receiver to any donor of the bucket: over
the columns that the receiver and all donors of the bucket have, the gap between value and
interval, scaled by p over the number of columns that could be shared.

A receiver visits buckets in two rounds. First the nearest ones by bound, as many as
hold ``WIDE`` times k donors of each missing column for certain. Their k-th distance is a limit; the second
round visits every other bucket whose bound is within the limit of some missing column,
and no donor outside can be among the k nearest. A round is one exchange: donors and
visiting receivers are dealt by (bucket, share), sorted with the donors first, and streamed:
the donors of one bucket are held, receivers pass in slices. A bucket that many receivers
visit is split into shares of about ``VISITS`` visits, each with a copy of its
donors, so a dense region spreads over many tasks. Donors never pass the driver; what is
broadcast is the directory, at most ``MAX_BUCKETS`` entries (beyond, buckets grow).

Receivers are known by a row number of a written table, so rows that share a key
are filled each for itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

#: Rows of a bucket, buckets at most, and rows of the sample that places the cuts.
BUCKET, MAX_BUCKETS, SAMPLE = 96, 1 << 16, 1 << 16
#: The first round's buckets hold so many times k donors: more distances there, but a tighter limit for the second.
WIDE = 60
#: Visits of one share of a bucket, and distances computed at a time.
VISITS, DISTANCES = 20_000, 400_000


def qcol(name: str):
    return F.col(f"`{name}`")


def _matrix(column: pa.Array, p: int) -> np.ndarray:
    """Rows of an array column of p numbers; null is NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, p)


# --- buckets


def _cut(x: np.ndarray, leaves: int):
    """Tree of median cuts over sampled rows: (column, value, left, right) or the number of leaves left to make (a leaf)."""
    if leaves < 2 or len(x) < 2:
        return None
    there = ~np.isnan(x)
    spread = np.array([np.ptp(c[m]) if m.any() else 0.0 for c, m in zip(x.T, there.T, strict=True)])
    if not spread.max() > 0:
        return None
    i = int(spread.argmax())
    values = x[there[:, i], i]
    value = float(np.median(values))
    value = value if (values > value).any() else float(values[values < value].max())  # something on both sides
    right = x[:, i] > value  # NaN goes left
    return i, value, _cut(x[~right], leaves - leaves // 2), _cut(x[right], leaves // 2)


def _leaves(tree) -> int:
    return 1 if tree is None else _leaves(tree[2]) + _leaves(tree[3])


def _place(x: np.ndarray, tree, first: int, out: np.ndarray, rows: np.ndarray) -> None:
    """Bucket numbers of rows, from ``first`` on."""
    if tree is None or not len(rows):
        out[rows] = first
        return
    i, value, left, right = tree
    go = x[rows, i] > value
    _place(x, left, first, out, rows[~go])
    _place(x, right, first + _leaves(left), out, rows[go])


def _patterns(x: np.ndarray) -> list[bytes]:
    packed = np.packbits(~np.isnan(x), axis=1)
    return [r.tobytes() for r in packed]


@dataclass
class Buckets:
    """Cuts of the donors: a tree per missing pattern; patterns too rare for the sample share one."""

    trees: dict[bytes, tuple[int, tuple | None]]  # pattern -> (first bucket, tree); b"" for the others

    @staticmethod
    def fit(sample: np.ndarray, donors: int, size: int, most: int) -> Buckets:
        size = max(size, -(-2 * donors // most))
        scale = donors / max(1, len(sample))
        of = _patterns(sample)
        counts = Counter(of)
        frequent = {k for k, c in counts.most_common(most // 4) if c * scale >= size / 4}
        groups: dict[bytes, list[int]] = {}
        for row, k in enumerate(of):
            groups.setdefault(k if k in frequent else b"", []).append(row)
        groups.setdefault(b"", [])
        trees, first = {}, 0
        for k in sorted(groups):
            tree = _cut(sample[groups[k]], max(1, round(len(groups[k]) * scale / size)))
            trees[k] = (first, tree)
            first += _leaves(tree)
        return Buckets(trees)

    def of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=np.int32)
        groups: dict[bytes, list[int]] = {}
        for row, k in enumerate(_patterns(x)):
            groups.setdefault(k if k in self.trees else b"", []).append(row)
        for k, rows in groups.items():
            first, tree = self.trees[k]
            _place(x, tree, first, out, np.array(rows))
        return out


@dataclass
class Directory:
    """Per bucket (rows) and column: donors that have it, least and greatest value. ``whole`` columns are in all its donors."""

    ids: np.ndarray
    count: np.ndarray
    have: np.ndarray
    low: np.ndarray
    high: np.ndarray
    whole: np.ndarray = field(init=False)

    def __post_init__(self):
        self.whole = self.have == self.count[:, None]
        self.low = np.where(self.whole, self.low, -np.inf)
        self.high = np.where(self.whole, self.high, np.inf)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower bounds on the distance of each row to each bucket, and whether every donor there shares a column."""
        p = x.shape[1]
        there = ~np.isnan(x)
        x0 = np.where(there, x, 0.0)
        total = np.zeros((len(x), len(self.ids)))
        for i in range(p):
            rows = np.flatnonzero(there[:, i])
            gap = np.maximum(self.low[:, i] - x0[rows, i, None], x0[rows, i, None] - self.high[:, i])
            total[rows] += np.square(np.maximum(gap, 0.0))
        shared = there.astype(float) @ (self.have > 0).T.astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            bound = np.where(shared > 0, np.sqrt(p / shared * total), np.inf)
        return bound * (1 - 1e-9), there.astype(float) @ self.whole.T.astype(float) > 0


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distance of every receiver to every donor; infinite where they share no column."""
    p = x.shape[1]
    have_x, have_y = ~np.isnan(x), ~np.isnan(y)
    x0, y_by = np.where(have_x, x, 0.0), np.ascontiguousarray(np.where(have_y, y, 0.0).T)
    total, shared = np.zeros((len(x), len(y))), have_x.astype(float) @ have_y.T.astype(float)
    d = np.empty_like(total)
    whole_x, whole_y = have_x.all(axis=0), have_y.all(axis=0)
    for i in range(p):
        np.subtract(x0[:, i, None], y_by[i], out=d)
        if not whole_x[i]:
            d *= have_x[:, i, None]
        if not whole_y[i]:
            d *= have_y[None, :, i]
        d *= d
        total += d
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(shared > 0, np.sqrt(p / shared * total), np.inf)


def _nearest(x: np.ndarray, y: np.ndarray, limits: np.ndarray, k: int) -> Iterator[tuple]:
    """Candidates for missing cells: (columns, receivers, donors, distances), for sets of columns that the same donors have.

    ``limits`` has a number for each missing cell of a receiver and NaN for the others. A
    receiver gets its k nearest donors within the largest limit of the columns at most; donors come in
    key order, which breaks ties.
    """
    dist = _distances(x, y)
    have = ~np.isnan(y)
    patterns, of = np.unique(~np.isnan(limits), axis=0, return_inverse=True)
    of = of.reshape(-1)
    for g, missing in enumerate(patterns):
        rows, columns = np.flatnonzero(of == g), np.flatnonzero(missing)
        alike: dict[bytes, list[int]] = {}
        for j in columns:
            alike.setdefault(have[:, j].tobytes(), []).append(int(j))
        for same in alike.values():
            own = np.flatnonzero(have[:, same[0]])
            if not len(own):
                continue
            d = dist[np.ix_(rows, own)]
            near = np.isfinite(d) & (d <= limits[rows][:, same].max(axis=1)[:, None])
            many = np.flatnonzero(near.sum(axis=1) > k)
            if len(many):
                order = np.argsort(np.where(near[many], d[many], np.inf), axis=1, kind="stable")[:, :k]
                near[many] = False
                near[many[:, None], order] = True
            r, o = np.nonzero(near)
            if len(r):
                yield same, rows[r], own[o], d[r, o]


# --- model


@dataclass
class KnnModel:
    key: list[str]
    cols: list[str]
    k: int
    donors: DataFrame  # dk struct, v array of p doubles, b bucket
    means: dict[str, float | None]
    n_donors: int
    directory: Directory
    #: Of the last transform: receivers, distances computed, and receivers times donors.
    stats: dict[str, int] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return knn_transform(self, df)


def read_directory(donors: DataFrame, p: int) -> Directory:
    """One aggregate over all donors; as many rows as there are buckets."""
    v = [F.get("v", F.lit(i)) for i in range(p)]
    rows = donors.groupBy("b").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.count(x) for x in v]).alias("h"),
        F.array(*[F.min(x) for x in v]).alias("lo"), F.array(*[F.max(x) for x in v]).alias("hi"),
    ).collect()
    rows.sort(key=lambda r: r["b"])
    get = lambda c: np.array([[np.nan if x is None else x for x in r[c]] for r in rows], dtype=float).reshape(len(rows), p)
    return Directory(np.array([r["b"] for r in rows], dtype=np.int32), np.array([r["n"] for r in rows], dtype=np.int64), get("h"), get("lo"), get("hi"))


def fit_knn(train: DataFrame, key: list[str], cols: list[str], k: int = 5, bucket: int = BUCKET, sample: int = SAMPLE) -> KnnModel:
    """IMP-01 fit: the donors in their buckets (written), their directory and the training means."""
    p = len(cols)
    row = train.agg(F.count(F.lit(1)).alias("_n"), *[F.avg(qcol(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    slim = train.select(F.struct(*[qcol(c) for c in key]).alias("dk"), F.array(*[qcol(c).cast("double") for c in cols]).alias("v"))
    share = F.pmod(F.xxhash64("dk", "v"), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, sample / max(1, row["_n"]))))
    some = slim.where(share).select("v").toArrow().column("v").combine_chunks()
    some = some.combine_chunks() if isinstance(some, pa.ChunkedArray) else some
    x = _matrix(some, p) if len(some) else np.empty((0, p))
    buckets = Buckets.fit(x[np.lexsort(x.T)] if len(x) else x, row["_n"], bucket, MAX_BUCKETS)
    shared = train.sparkSession.sparkContext.broadcast(buckets)
    schema = T.StructType([*slim.schema.fields, T.StructField("b", T.IntegerType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.of(_matrix(b.column(1), p)))], names=["dk", "v", "b"])

    donors = materialize(slim.mapInArrow(place, schema))
    means = {c: row[f"m{i}"] for i, c in enumerate(cols)}
    return KnnModel(key, cols, k, donors, means, row["_n"], read_directory(donors, p))


# --- search


def _first_visits(x: np.ndarray, bound: np.ndarray, sure: np.ndarray, directory: Directory, k: int) -> list[np.ndarray]:
    """The nearest buckets of each row that hold WIDE * k donors of each of its missing columns for certain (all, if none do)."""
    out = []
    for r, row in enumerate(x):
        order = np.argsort(bound[r], kind="stable")
        order = order[np.isfinite(bound[r, order])]
        have = directory.have[order][:, np.isnan(row)]
        # per missing column: buckets up to the one where there are enough
        enough = np.cumsum(np.where(sure[r, order, None], have, 0), axis=0) >= WIDE * k
        until = np.where(enough.any(axis=0), enough.argmax(axis=0), len(order)) if len(order) else np.zeros(have.shape[1], dtype=int)
        out.append(order[((have > 0) & (np.arange(len(order))[:, None] <= until)).any(axis=1)])
    return out


def _more_visits(x: np.ndarray, limits: np.ndarray, directory: Directory, k: int) -> list[np.ndarray]:
    """Buckets, beyond the first visits, that may hold a donor within the limit of a missing column."""
    bound, sure = directory.bounds(x)
    out = []
    for r, before in enumerate(_first_visits(x, bound, sure, directory, k)):
        columns = np.flatnonzero(np.isnan(x[r]))
        need = ((directory.have[:, columns] > 0) & (bound[r][:, None] <= limits[r, columns])).any(axis=1) & np.isfinite(bound[r])
        need[before] = False
        out.append(np.flatnonzero(need))
    return out


def _visits(receivers: DataFrame, shared, p: int, k: int, first: bool) -> DataFrame:
    """``receivers`` (rid, v, far) once per bucket to visit: b, rid, v, far."""
    schema = T.StructType.fromDDL("rid bigint, v array<double>, far array<double>, to array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory = shared.value
        step = max(1, DISTANCES // max(1, len(directory.ids)))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                x = _matrix(b.column(1), p)
                found = _first_visits(x, *directory.bounds(x), directory, k) if first else _more_visits(x, _matrix(b.column(2), p), directory, k)
                ends = np.append(0, np.cumsum([len(f) for f in found]))
                to = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(directory.ids[np.concatenate(found)]))
                yield pa.RecordBatch.from_arrays([*b.columns, to], names=schema.names)

    return receivers.select("rid", "v", "far").mapInArrow(run, schema).select(F.explode("to").alias("b"), "rid", "v", "far")


def _meet(model: KnnModel, visits: DataFrame) -> tuple[DataFrame, int]:
    """Candidates rid, j, d, dk, y of all visits, and the number of distances that take."""
    k, p = model.k, len(model.cols)
    spark = visits.sparkSession
    per = {r["b"]: r["count"] for r in visits.groupBy("b").count().collect()}  # at most a row per bucket
    size = dict(zip(model.directory.ids.tolist(), model.directory.count.tolist(), strict=True))
    pairs = sum(size[b] * c for b, c in per.items())
    shares = spark.createDataFrame([(b, -(-c // VISITS)) for b, c in per.items()], "b int, s int")
    key_type = model.donors.schema["dk"].dataType
    shares = F.broadcast(shares)  # at most a row per bucket
    asked = visits.join(shares, "b").withColumn("s", F.pmod(F.xxhash64("rid"), F.col("s").cast("bigint")).cast("int"))
    donors = model.donors.join(shares, "b").withColumn("s", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
    rows = donors.select("b", "s", F.lit(0).alias("side"), F.lit(None).cast("bigint").alias("rid"), "dk", "v", F.lit(None).cast("array<double>").alias("far")).unionByName(
        asked.select("b", "s", F.lit(1).alias("side"), "rid", F.lit(None).cast(key_type).alias("dk"), "v", "far"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, y, keys = None, [], None, None
        for batch in batches:
            b, s, side = (batch.column(i).to_numpy() for i in range(3))
            edge = np.flatnonzero((b[1:] != b[:-1]) | (s[1:] != s[:-1]) | (side[1:] != side[:-1])) + 1
            for start, end in zip([0, *edge], [*edge, batch.num_rows], strict=True):
                part = batch.slice(start, end - start)
                if not part.num_rows:
                    continue
                if (b[start], s[start]) != here:
                    here, held, y = (b[start], s[start]), [], None
                if side[start] == 0:
                    held.append(part)
                    continue
                if y is None:
                    y = np.concatenate([_matrix(x.column(5), p) for x in held])
                    keys = pa.concat_arrays([x.column(4) for x in held])
                step = max(1, DISTANCES // len(y))
                for at in range(0, part.num_rows, step):
                    own = part.slice(at, step)
                    for same, r, o, d in _nearest(_matrix(own.column(5), p), y, _matrix(own.column(6), p), k):
                        n = len(same)
                        js, ys = pa.array(np.tile(np.array(same, dtype=np.int32), len(r))), pa.array(y[o][:, same].ravel())
                        ends = pa.array(np.arange(0, n * len(r) + 1, n, dtype=np.int32))
                        yield pa.RecordBatch.from_arrays(
                            [own.column(3).take(pa.array(r)), pa.array(d), keys.take(pa.array(o)), pa.ListArray.from_arrays(ends, js), pa.ListArray.from_arrays(ends, ys)],
                            names=["rid", "d", "dk", "js", "ys"])

    out = T.StructType([T.StructField("rid", T.LongType()), T.StructField("d", T.DoubleType()), T.StructField("dk", key_type), T.StructField("js", T.ArrayType(T.IntegerType())), T.StructField("ys", T.ArrayType(T.DoubleType()))])
    met = rows.repartition("b", "s").sortWithinPartitions("b", "s", "side", "dk").mapInArrow(run, out)
    cells = met.select("rid", "d", "dk", F.inline(F.arrays_zip("js", "ys")))
    return cells.select("rid", F.col("js").alias("j"), "d", "dk", F.col("ys").alias("y")), pairs


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """rid, j, best: the k nearest candidates of a cell (few are gathered: k from each bucket visited)."""
    return candidates.groupBy("rid", "j").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "dk", "y"))), 1, k).alias("best"))


def _settled(model: KnnModel, receivers: DataFrame) -> DataFrame:
    """rid, j, val of every cell that has a donor at a finite distance."""
    k, p = model.k, len(model.cols)
    shared = receivers.sparkSession.sparkContext.broadcast(model.directory)
    anything = F.transform("v", lambda x: F.when(x.isNull(), F.lit(float("inf"))))
    first, pairs = _meet(model, materialize(_visits(receivers.withColumn("far", anything), shared, p, k, True)))
    first = materialize(_best(first, k))
    limit = F.when(F.size("best") >= k, F.element_at("best", -1)["d"]).otherwise(F.lit(float("inf")))
    limits = first.select("rid", F.struct("j", limit.alias("d")).alias("c")).groupBy("rid").agg(F.map_from_entries(F.collect_list("c")).alias("limits"))
    far = F.transform("v", lambda x, j: F.when(x.isNull(), F.coalesce(F.try_element_at("limits", j), F.lit(float("inf")))))
    again = receivers.join(limits, "rid", "left").withColumn("far", far)
    second, more = _meet(model, materialize(_visits(again, shared, p, k, False)))
    model.stats |= {"compared": pairs + more}
    both = first.select("rid", "j", F.inline("best")).unionByName(second.select("rid", "j", "d", "dk", "y"))
    total = F.aggregate("best", F.lit(0.0), lambda a, x: a + x["y"])
    return _best(both, k).select("rid", "j", (total / F.size("best")).alias("val"))


def knn_transform(model: KnnModel, df: DataFrame) -> DataFrame:
    """IMP-01/02/03 apply: fill the NULL cells of ``model.cols``; other columns pass through."""
    cols, spark = model.cols, df.sparkSession
    rid, fill = "_knn_row", "_knn_fill"
    # written with its row numbers: rows that share a key stay apart, and the source is read once
    numbered = materialize(df.withColumn(rid, F.monotonically_increasing_id()))
    missing = F.filter(F.array(*[F.when(F.get("v", F.lit(i)).isNull(), F.lit(i)) for i in range(len(cols))]), lambda x: x.isNotNull())
    receivers = numbered.select(F.col(rid).alias("rid"), F.array(*[qcol(c).cast("double") for c in cols]).alias("v")).withColumn("miss", missing).where(F.size("miss") > 0)
    receivers = materialize(receivers)
    n = receivers.count()
    model.stats = {"receivers": n, "all_pairs": n * model.n_donors, "compared": 0}
    settled = _settled(model, receivers) if n and model.n_donors else spark.createDataFrame([], "rid bigint, j int, val double")

    # cells without any donor at a finite distance -> training mean
    means = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(i), F.lit(model.means[c]).cast("double"))])
    cells = receivers.select("rid", F.explode("miss").alias("j"))
    filled = cells.join(settled, ["rid", "j"], "left").select("rid", "j", F.coalesce("val", F.try_element_at(means, F.col("j"))).alias("val"))
    per_row = filled.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("j", "val"))).alias(fill)).withColumnRenamed("rid", rid)
    out = numbered.join(per_row, rid, "left")
    return out.withColumns({
        c: F.coalesce(qcol(c), F.try_element_at(F.col(fill), F.lit(i)).cast(df.schema[c].dataType)) for i, c in enumerate(cols)
    }).drop(rid, fill)
