"""The binned forest: its trees against a plain search, passes over all rows against local growth, and against Spark's forest."""

import tempfile

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from panelforge.operators import forest


def frame(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 4)).round(2)
    y = 3 * x[:, 0] + x[:, 1] ** 2 + rng.normal(0, 0.1, n)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, d double, y double").repartition(5)
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)


def plain(bins, y, w, depth, least):
    """Predictions of a greedy tree, found by trying every cut."""
    out = np.full(len(y), (w * y).sum() / w.sum())
    best = (1e-9, None)
    for f in range(bins.shape[1]):
        for c in np.unique(bins[:, f])[:-1]:
            go = bins[:, f] <= c
            lw, rw = w[go].sum(), w[~go].sum()
            if lw >= least and rw >= least:
                fall = (w * y)[go].sum() ** 2 / lw + (w * y)[~go].sum() ** 2 / rw - (w * y).sum() ** 2 / w.sum()
                if fall > best[0] * (1 + 1e-9) + 1e-12:
                    best = (fall, go)
    if depth and best[1] is not None:
        for side in (best[1], ~best[1]):
            out[side] = plain(bins[side], y[side], w[side], depth - 1, least)
    return out


@pytest.mark.parametrize(("depth", "least"), [(0, 3), (1, 3), (4, 3), (30, 1), (30, 10)])
def test_grown_trees_are_greedy(depth, least):
    rng = np.random.default_rng(depth)
    bins, y, w = rng.integers(0, 9, (120, 3)).astype(np.uint8), rng.normal(0, 3, 120), rng.integers(1, 4, 120).astype(float)
    tree = forest.grow(bins, y, w, depth, least)
    assert np.allclose(tree.value[tree.find(bins)], plain(bins, y, w, depth, least))


def test_passes_over_all_rows_grow_the_same_trees(spark):
    df = frame(spark)
    small = dict(trees=5, depth=8, batch=3)
    make = lambda **more: forest.BinnedForest(**small, **more).setLabelCol("y").fit(df)
    local, passes = make(), make(local_rows=60)
    a = sorted((r.a, r.b, round(r.prediction, 9)) for r in local.transform(df).collect())
    b = sorted((r.a, r.b, round(r.prediction, 9)) for r in passes.transform(df.repartition(2)).collect())
    assert a == b and np.allclose(local.featureImportances.toArray(), passes.featureImportances.toArray())


def test_forest_is_as_good_as_sparks_and_can_be_saved(spark):
    df, fresh = frame(spark), frame(spark, seed=2)
    own = forest.BinnedForest(trees=30, depth=12).setLabelCol("y").fit(df)
    other = RandomForestRegressor(numTrees=30, maxDepth=12, minInstancesPerNode=3, featureSubsetStrategy="all", maxBins=64, labelCol="y").fit(df)
    error = lambda m: m.transform(fresh).agg(F.avg(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0]
    assert error(own) < 1.15 * error(other)
    imp = own.featureImportances.toArray()
    assert abs(imp.sum() - 1) < 1e-9 and imp[0] > 0.5 and imp[:2].sum() > 0.9 and np.abs(imp - other.featureImportances.toArray()).max() < 0.05
    path = tempfile.mkdtemp(prefix="pf-f-")
    own.write().overwrite().save(path)
    loaded = forest.BinnedForestModel.load(path)
    key = lambda m: sorted((r.a, r.b, r.prediction) for r in m.transform(fresh).collect())
    assert key(loaded) == key(own) and {p.name: v for p, v in own.extractParamMap().items()}["trees"] == 30
