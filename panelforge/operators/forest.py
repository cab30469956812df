"""Random forest regression on binned features, grown in batches of trees (ML-05, EXP-02, EXP-04).

Features are cut into at most ``max_bins`` bins once, at quantiles of the training rows, and kept as bytes. A row's
weight in a tree's bootstrap is a Poisson number from a hash of seed, tree and row, so any task
can tell it and a tree doesn't depend on how rows are dealt. Trees are grown in batches:

* *top*: while a node has more than ``local_rows`` rows, its level is grown by a pass over the binned
  rows: tasks find the node of each row in each tree of the batch and sum weights and targets per (node,
  feature, bin); the sums are combined on both sides of one shuffle and each node's best split is found where its
  sums meet (features x bins rows);
* *local*: every smaller node's rows are dealt to one task, which grows the whole subtree from
  sorted bins, level by level. No task holds more than ``local_rows`` rows of one node.

The split rule is the largest fall of the squared error, with ``min_rows`` rows (by weight) on either side and at most ``max_depth``
levels. The model is the list of trees; importances are the falls per feature, to 1 in every tree, averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .stages import _Stored

#: Rows of a node that one task grows on, and trees of a batch.
LOCAL_ROWS, BATCH_TREES = 100_000, 50
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.append(1.0, np.arange(1, 12))))


def bootstrap(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson(1) weights of rows in a tree, from a hash."""
    with np.errstate(over="ignore"):
        h = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((tree * 0xD1342543DE82EF95 + seed * 0x2545F4914F6CDD1D) % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
    return np.searchsorted(_POISSON, (h >> np.uint64(11)).astype(np.float64) / 2.0**53, side="right").astype(np.float64)


@dataclass
class Tree:
    """Nodes as arrays: split feature (-1: leaf), bins up to ``cut`` go to ``left``, others to ``left + 1``; mean, and fall of the error."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def leaf(value: float) -> Tree:
        return Tree(np.array([-1], np.int16), np.zeros(1, np.uint8), np.zeros(1, np.int32), np.array([value]), np.zeros(1))

    def find(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of each row."""
        at = np.zeros(len(bins), dtype=np.int32)
        rows = np.arange(len(bins))
        while len(rows):
            f = self.feature[at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            n = at[rows]
            at[rows] = self.left[n] + (bins[rows, f] > self.cut[n])
        return at

    def grafted(self, below: dict[int, Tree]) -> Tree:
        """This tree with subtrees in place of some leaves."""
        parts, size = [self], len(self.feature)
        feature, cut, left, value, gain = (x.copy() for x in (self.feature, self.cut, self.left, self.value, self.gain))
        for node, sub in below.items():
            # a subtree's root takes the leaf's place, its other nodes come at the end
            feature[node], cut[node], gain[node], value[node] = sub.feature[0], sub.cut[0], sub.gain[0], sub.value[0]
            left[node] = sub.left[0] + size - 1
            parts.append(Tree(sub.feature[1:], sub.cut[1:], sub.left[1:] + size - 1, sub.value[1:], sub.gain[1:]))
            size += len(sub.feature) - 1
        rest = parts[1:]
        join = lambda first, name: np.concatenate([first, *[getattr(p, name) for p in rest]])
        return Tree(join(feature, "feature"), join(cut, "cut"), join(left, "left").astype(np.int32), join(value, "value"), join(gain, "gain"))


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, min_rows: int) -> Tree:
    """A whole tree of at most ``depth`` levels on weighted rows, level by level."""
    n, p = bins.shape
    feature, cut, left, value, gain = [[np.array([x])] for x in (np.int16(-1), np.uint8(0), np.int32(0), (w @ y) / max(w.sum(), 1e-300), 0.0)]
    rows, node, size, first = np.arange(n), np.zeros(n, dtype=np.int64), 1, 0  # node: number within the level
    count = 1
    for _ in range(depth):
        if not len(rows):
            break
        wr, sr = w[rows], w[rows] * y[rows]
        all_w, all_s = np.bincount(node, wr, count), np.bincount(node, sr, count)
        best = np.zeros(count)
        best_f, best_c, best_w, best_s = np.full(count, -1), np.zeros(count, np.int64), np.zeros(count), np.zeros(count)
        base = np.divide(all_s**2, all_w, out=np.zeros(count), where=all_w > 0)
        for f in range(p):
            key = node * 256 + bins[rows, f]
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            ends = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True))  # last row of each (node, bin)
            at = ordered[ends] >> 8
            start = np.searchsorted(at, np.arange(count))
            cw, cs = np.cumsum(wr[order])[ends], np.cumsum(sr[order])[ends]
            before = np.maximum(start - 1, 0)
            lw = cw - np.where(start > 0, cw[before], 0.0)[at]
            ls = cs - np.where(start > 0, cs[before], 0.0)[at]
            rw, rs = all_w[at] - lw, all_s[at] - ls
            ok = (lw >= min_rows) & (rw >= min_rows - 1e-9)
            with np.errstate(divide="ignore", invalid="ignore"):
                fall = np.where(ok, ls**2 / lw + rs**2 / rw - base[at], 0.0)
            # the best bin of each node; nodes without a row left have none
            there = np.flatnonzero(np.append(at[1:] != at[:-1], True))
            firsts = np.append(0, there[:-1] + 1)
            top = np.maximum.reduceat(fall, firsts)
            nodes = at[there]
            better = top > best[nodes] * (1 + 1e-9) + 1e-12
            for i in np.flatnonzero(better):
                s, e = firsts[i], there[i] + 1
                j = s + int(np.argmax(fall[s:e]))
                k = nodes[i]
                best[k], best_f[k], best_c[k], best_w[k], best_s[k] = fall[j], f, ordered[ends[j]] & 255, lw[j], ls[j]
        split = np.flatnonzero(best_f >= 0)
        if not len(split):
            break
        number = np.full(count, -1)
        number[split] = np.arange(len(split))
        children = size + 2 * np.arange(len(split))
        level_f, level_c, level_l, level_g = feature[-1], cut[-1], left[-1], gain[-1]
        level_f[split], level_c[split], level_l[split], level_g[split] = best_f[split], best_c[split], children, best[split]
        rw, rs = all_w[split] - best_w[split], all_s[split] - best_s[split]
        means = np.column_stack([best_s[split] / best_w[split], rs / rw]).ravel()
        stay = number[node] >= 0
        rows, node = rows[stay], node[stay]
        right = bins[rows, best_f[node]] > best_c[node]
        node = 2 * number[node] + right
        count = 2 * len(split)
        size += count
        feature.append(np.full(count, -1, np.int16))
        cut.append(np.zeros(count, np.uint8))
        left.append(np.zeros(count, np.int32))
        value.append(means)
        gain.append(np.zeros(count))
    return Tree(*[np.concatenate(x) for x in (feature, cut, left, value, gain)])


_TREE = "tree int, node int, feature binary, cut binary, left binary, value binary, gain binary"


def _packed(tree: Tree) -> list[bytes]:
    return [tree.feature.astype("<i2").tobytes(), tree.cut.astype("u1").tobytes(), tree.left.astype("<i4").tobytes(), tree.value.astype("<f8").tobytes(), tree.gain.astype("<f8").tobytes()]


def _unpacked(row) -> Tree:
    return Tree(*[np.frombuffer(bytes(row[c]), dtype=t) for c, t in (("feature", "<i2"), ("cut", "u1"), ("left", "<i4"), ("value", "<f8"), ("gain", "<f8"))])


def _bins_of(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)]).astype(np.uint8)


def _rows(column: pa.Array, p: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, p)


class BinnedForest(Estimator, _Stored):
    """Estimator: ``trees`` trees of ``depth`` levels on all features, see the module docstring."""

    def __init__(self, trees: int = 300, depth: int = 30, min_rows: int = 3, max_bins: int = 64, seed: int = 42, local_rows: int = LOCAL_ROWS, batch: int = BATCH_TREES):
        super().__init__()
        self.settings = {"trees": trees, "depth": depth, "min_rows": min_rows, "max_bins": max_bins, "seed": seed, "local_rows": local_rows, "batch": batch}
        self.columns = {"features": "features", "label": "label", "prediction": "prediction"}

    def setFeaturesCol(self, name: str) -> BinnedForest:
        self.columns["features"] = name
        return self

    def setLabelCol(self, name: str) -> BinnedForest:
        self.columns["label"] = name
        return self

    def setPredictionCol(self, name: str) -> BinnedForest:
        self.columns["prediction"] = name
        return self

    def _fit(self, dataset: DataFrame) -> BinnedForestModel:
        s, spark = self.settings, dataset.sparkSession
        slim = dataset.select(vector_to_array(self.columns["features"]).alias("x"), F.col(f"`{self.columns['label']}`").cast("double").alias("y")).where("y is not null")
        p = len(dataset.select(self.columns["features"]).head()[0])
        grid = [(i + 1) / s["max_bins"] for i in range(s["max_bins"] - 1)]
        # one aggregate gives the cuts of all features
        found = slim.agg(*[F.percentile_approx(F.get("x", F.lit(i)), grid, 10_000).alias(f"q{i}") for i in range(p)]).first()
        cuts = [np.unique(np.array(found[f"q{i}"], dtype=float)) for i in range(p)]
        shared = spark.sparkContext.broadcast(cuts)

        def to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    bins = _bins_of(_rows(b.column(0), p), shared.value)
                    yield pa.RecordBatch.from_arrays([b.column(2), pa.array([r.tobytes() for r in bins], pa.binary()), b.column(1)], names=["row", "bins", "y"])

        kept = materialize(slim.withColumn("row", F.monotonically_increasing_id()).mapInArrow(to_bytes, "row bigint, bins binary, y double"))
        total = kept.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("m")).first()
        trees: list[Tree] = []
        for at in range(0, s["trees"], s["batch"]):
            batch = list(range(at, min(s["trees"], at + s["batch"])))
            trees += _grow_batch(kept, batch, p, total["n"], total["m"], s)
        return BinnedForestModel(cuts=[c.tolist() for c in cuts], columns=self.columns, settings=s, trees=trees)


def _grow_batch(kept: DataFrame, batch: list[int], p: int, n: int, mean: float, s: dict) -> list[Tree]:
    """The trees of one batch: top levels by passes over all rows, what is left by subtrees."""
    spark, seed, min_rows = kept.sparkSession, s["seed"], s["min_rows"]
    trees = {t: Tree.leaf(mean) for t in batch}
    depth = {t: {0: 0} for t in batch}
    large = {(t, 0) for t in batch} if n > s["local_rows"] and s["depth"] else set()
    small = {(t, 0) for t in batch} - large
    while large:
        shared = spark.sparkContext.broadcast((trees, sorted(large)))

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            grown, active = shared.value
            of: dict[int, list[int]] = {}
            for t, node in active:
                of.setdefault(t, []).append(node)
            held = {}
            for b in batches:
                bins = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.uint8).reshape(-1, p)
                row, y = b.column(0).to_numpy(), b.column(2).to_numpy()
                for t, nodes in of.items():
                    w, at = bootstrap(row, t, seed), grown[t].find(bins)
                    for node in nodes:
                        own = np.flatnonzero((at == node) & (w > 0))
                        flat = (np.arange(p) * 256 + bins[own]).ravel()
                        made = np.stack([np.bincount(flat, np.repeat(v, p), p * 256) for v in (w[own], w[own] * y[own])])
                        held[t, node] = held[t, node] + made if (t, node) in held else made
            for (t, node), x in held.items():
                some = np.flatnonzero(x[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), t, np.int32)), pa.array(np.full(len(some), node, np.int32)), pa.array((some // 256).astype(np.int32)), pa.array((some % 256).astype(np.int32)), pa.array(x[0][some]), pa.array(x[1][some])], names=["t", "node", "f", "b", "w", "s"])

        def split(pdf: pd.DataFrame) -> pd.DataFrame:
            """The best split of one node: features x bins rows."""
            w, v = np.zeros((p, 256)), np.zeros((p, 256))
            w[pdf.f, pdf.b], v[pdf.f, pdf.b] = pdf.w, pdf.s
            lw, ls = np.cumsum(w, axis=1), np.cumsum(v, axis=1)
            all_w, all_s = lw[:, -1:], ls[:, -1:]
            rw, rs = all_w - lw, all_s - ls
            with np.errstate(divide="ignore", invalid="ignore"):
                fall = np.where((lw >= min_rows) & (rw >= min_rows - 1e-9), ls**2 / lw + rs**2 / rw - all_s**2 / all_w, 0.0)
            f, c = np.unravel_index(int(fall.argmax()), fall.shape)
            return pd.DataFrame({"t": [pdf.t.iloc[0]], "node": [pdf.node.iloc[0]], "f": [int(f)], "b": [int(c)], "gain": [float(fall[f, c])], "lw": [lw[f, c]], "ls": [ls[f, c]], "rw": [rw[f, c]], "rs": [rs[f, c]], "w": [all_w[0, 0]], "s": [all_s[0, 0]]})

        rows = kept.mapInArrow(sums, "t int, node int, f int, b int, w double, s double").groupBy("t", "node", "f", "b").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
        best = rows.groupBy("t", "node").applyInPandas(split, "t int, node int, f int, b int, gain double, lw double, ls double, rw double, rs double, w double, s double").collect()
        large = set()
        for r in best:  # a row per node with more than ``local_rows`` rows
            t, node = r["t"], r["node"]
            tree = trees[t]
            tree.value[node] = r["s"] / r["w"]
            if r["gain"] <= 1e-12:
                continue
            k = len(tree.feature)
            tree.feature[node], tree.cut[node], tree.left[node], tree.gain[node] = r["f"], r["b"], k, r["gain"]
            trees[t] = Tree(np.append(tree.feature, np.int16([-1, -1])), np.append(tree.cut, np.uint8([0, 0])), np.append(tree.left, np.int32([0, 0])), np.append(tree.value, [r["ls"] / r["lw"], r["rs"] / r["rw"]]), np.append(tree.gain, [0.0, 0.0]))
            for child, w in ((k, r["lw"]), (k + 1, r["rw"])):
                depth[t][child] = depth[t][node] + 1
                if depth[t][child] < s["depth"]:
                    (large if w > s["local_rows"] else small).add((t, child))
    if small and s["depth"]:
        for (t, node), sub in _subtrees(kept, trees, small, depth, p, s).items():
            trees[t].grafts = getattr(trees[t], "grafts", {}) | {node: sub}
    return [trees[t].grafted(getattr(trees[t], "grafts", {})) for t in batch]


def _subtrees(kept: DataFrame, trees: dict[int, Tree], small: set, depth: dict, p: int, s: dict) -> dict[tuple[int, int], Tree]:
    """Each small node's subtree, grown in the task that its rows are dealt to."""
    spark, seed = kept.sparkSession, s["seed"]
    shared = spark.sparkContext.broadcast((trees, {k: s["depth"] - depth[k[0]][k[1]] for k in small}))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown, left = shared.value
        for b in batches:
            bins = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.uint8).reshape(-1, p)
            row, y = b.column(0).to_numpy(), b.column(2).to_numpy()
            out = []
            for t, tree in grown.items():
                w, at = bootstrap(row, t, seed), tree.find(bins)
                for node in np.unique(at):
                    own = np.flatnonzero((at == node) & (w > 0))
                    if (t, int(node)) in left and len(own):
                        out.append((t, int(node), row[own].astype("<i8").tobytes(), bins[own].tobytes(), y[own].astype("<f8").tobytes(), w[own].astype("u1").tobytes()))
                if len(out) >= 64:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t_) for c, t_ in zip(zip(*out, strict=True), types, strict=True)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t_) for c, t_ in zip(zip(*out, strict=True), types, strict=True)], names=names)

    types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    names = ["tree", "node", "row", "bins", "y", "w"]
    schema = "tree int, node int, row binary, bins binary, y binary, w binary"

    def whole(key: tuple[int, int], held: list[list[bytes]]) -> tuple:
        row, bins, y, w = (np.frombuffer(b"".join(x[i] for x in held), dtype=d) for i, d in enumerate(("<i8", "u1", "<f8", "u1")))
        order = np.argsort(row)  # sums don't depend on how blocks arrive
        sub = grow(bins.reshape(-1, p)[order], y[order], w[order].astype(np.float64), shared.value[1][key], s["min_rows"])
        return (*key, *_packed(sub))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        done = []
        for b in batches:
            for t, node, *block in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if (t, node) != key:
                    if key is not None:
                        done.append(whole(key, held))
                    key, held = (t, node), []
                held.append(block)
        if key is not None:
            done.append(whole(key, held))
        for x in done:
            yield pa.RecordBatch.from_arrays([pa.array([v]) if not isinstance(v, int) else pa.array([v], pa.int32()) for v in x], names=["tree", "node", "feature", "cut", "left", "value", "gain"])

    n = max(1, min(len(small), 4 * spark.sparkContext.defaultParallelism))
    dealt = kept.mapInArrow(blocks, schema).repartition(n, "tree", "node").sortWithinPartitions("tree", "node")
    return {(r["tree"], r["node"]): _unpacked(r) for r in dealt.mapInArrow(run, _TREE).collect()}


class BinnedForestModel(Model, _Stored):
    def __init__(self, cuts: list, columns: dict, settings: dict, trees: list[Tree]):
        super().__init__()
        self.settings = {"cuts": cuts, "columns": dict(columns), "settings": settings}
        self.trees = trees

    @property
    def featureImportances(self) -> DenseVector:
        total = np.zeros(len(self.settings["cuts"]))
        for tree in self.trees:
            own = np.bincount(tree.feature[tree.feature >= 0], tree.gain[tree.feature >= 0], len(total))
            total += own / own.sum() if own.sum() > 0 else 0
        return Vectors.dense(total / total.sum() if total.sum() > 0 else total)

    def extractParamMap(self, extra=None) -> dict:
        """Settings as parameters (``name``) and values."""
        return {type("Setting", (), {"name": k})(): v for k, v in self.settings["settings"].items()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = len(self.settings["cuts"])
        shared = dataset.sparkSession.sparkContext.broadcast((self.trees, [np.array(c) for c in self.settings["cuts"]]))

        @F.pandas_udf(T.DoubleType())
        def predict(x: pd.Series) -> pd.Series:
            trees, cuts = shared.value
            if not len(x):
                return pd.Series([], dtype=float)
            bins = _bins_of(np.vstack(x.to_numpy()).astype(float).reshape(-1, p), cuts)
            return pd.Series(sum(t.value[t.find(bins)] for t in trees) / len(trees))

        c = self.settings["columns"]
        return dataset.withColumn(c["prediction"], predict(vector_to_array(c["features"])))

    def _write_tables(self, path: str) -> None:
        spark = SparkSession.active()
        rows = [(i, 0, *_packed(t)) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, _TREE).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def _restored(cls, values: dict, path: str, spark: SparkSession) -> BinnedForestModel:
        rows = sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: r["tree"])
        return cls(**values, trees=[_unpacked(r) for r in rows])
