"""KNN imputation vs a numpy brute force; scaler; policy fills."""

import datetime as dt
import math

import numpy as np
from pyspark.sql import types as T

from panelforge.operators import impute as I
from panelforge.operators import scale as SC

D0 = dt.date(2021, 1, 1)


def brute_knn(train, rows, k):
    """NaN-Euclidean k-NN mean, donors with the column, ties by donor position."""
    p = train.shape[1]
    out = rows.copy()
    means = np.nanmean(train, axis=0)
    for i, x in enumerate(rows):
        for j in np.where(np.isnan(x))[0]:
            cands = []
            for t, y in enumerate(train):
                if np.isnan(y[j]):
                    continue
                both = ~np.isnan(x) & ~np.isnan(y)
                if not both.any():
                    continue
                d = math.sqrt(p / both.sum() * np.sum((x[both] - y[both]) ** 2))
                cands.append((d, t, y[j]))
            cands.sort()
            out[i, j] = np.mean([c[2] for c in cands[:k]]) if cands else means[j]
    return out


def _frame(spark, arr, offset=0):
    rows = [(offset + i, D0 + dt.timedelta(days=offset + i), *[None if math.isnan(v) else float(v) for v in r])
            for i, r in enumerate(arr)]
    return spark.createDataFrame(rows, "e int, d date, c0 double, c1 double, c2 double, c3 double, cal double")


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    train = rng.normal(0, 10, size=(40, 4))
    train[rng.random(train.shape) < 0.25] = np.nan
    train = np.column_stack([train, np.arange(40) % 5])  # never-NULL column
    test = rng.normal(0, 10, size=(15, 4))
    test[rng.random(test.shape) < 0.4] = np.nan
    test[0, :] = np.nan  # shares only the calendar column with donors
    test = np.column_stack([test, np.arange(15) % 5])
    cols = ["c0", "c1", "c2", "c3", "cal"]
    model = I.fit_knn(_frame(spark, train), ["e", "d"], cols, k=3)
    got = model.transform(_frame(spark, test, offset=100)).orderBy("e").select(*cols).toPandas().to_numpy()
    ref = brute_knn(train, test, 3)
    assert np.allclose(got, ref, rtol=1e-9, atol=1e-9)


def test_knn_no_donor_falls_back_to_mean(spark):
    train = np.array([[1.0, np.nan, 0.0], [3.0, np.nan, 1.0], [5.0, 7.0, 0.0]])
    rows = np.array([[np.nan, np.nan, 1.0]])
    t = spark.createDataFrame([(i, D0, *[None if math.isnan(v) else float(v) for v in r]) for i, r in enumerate(train)],
                              "e int, d date, a double, b double, cal double")
    r = spark.createDataFrame([(9, D0, None, None, 1.0)], "e int, d date, a double, b double, cal double")
    out = I.fit_knn(t, ["e", "d"], ["a", "b", "cal"], k=5).transform(r).first()
    assert out.a == 3.0 and out.b == 7.0  # all reachable donors (fewer than k)
    assert np.allclose(brute_knn(train, rows, 5)[0], [3.0, 7.0, 1.0])


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "x double, c double")
    params = SC.fit_scaler(df, ["x", "c"])
    assert abs(params["x"][1] - np.std([1, 2, 3, 4])) < 1e-12  # population std
    assert params["c"] == (5.0, 1.0)  # constant column: scale 1
    out = [r.x for r in SC.apply_scaler(df, params).collect()]
    assert np.allclose(out, (np.array([1, 2, 3, 4]) - 2.5) / np.std([1, 2, 3, 4]))


def test_ffill_bfill_across_chunks(spark):
    vals = [None, None, 1.0, None, None, None, None, None, 2.0, None]
    df = spark.createDataFrame([(1, D0 + dt.timedelta(days=i), v) for i, v in enumerate(vals)], "e int, d date, v double")
    got = [r.v for r in I.ffill_bfill(df, "e", ["d"], ["v"], chunk_days=2).orderBy("d").collect()]
    assert got == [1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 2.0, 2.0]


def test_json_records_skip_malformed_and_default_key(spark, tmp_path):
    from panelforge.sources import files as IO

    d = tmp_path / "metrics"
    d.mkdir()
    (d / "OLS_metrics.json").write_text('{"model_name": "OLS", "validation_r2": 0.9}')
    (d / "Tree_metrics.json").write_text('{"validation_r2": 0.7}')  # key from the file stem
    (d / "Bad_metrics.json").write_text('{"model_name": ')  # malformed: skipped
    (d / "notes.txt").write_text("ignored")
    got = IO.read_json_records(spark, str(d), IO.METRICS_SCHEMA, "_metrics.json", key="model_name")
    rows = sorted((r.model_name, r.validation_r2) for r in got.collect())
    assert rows == [("OLS", 0.9), ("Tree", 0.7)]
    good, report = IO.read_permissive(spark, str(d / "OLS_metrics.json"), T.StructType(
        [T.StructField("model_name", T.StringType())]), fmt="json")
    assert report.first().corrupt_rows == 0 and good.count() == 1


def test_knn_receivers_far_outside_and_donor_blocks(spark):
    """Donors b in 0..10, a = 2b; receivers far beyond them still get their true neighbours, also with many small buckets."""
    b = np.linspace(0, 10, 50)
    train = np.column_stack([2 * b, b, np.zeros(50), np.full(50, np.nan), np.arange(50) % 5])
    test = np.array([[np.nan, 200.0, 0, np.nan, 1], [np.nan, 150.0, 0, np.nan, 2], [np.nan, -90.0, 0, np.nan, 0]])
    cols = ["c0", "c1", "c2", "c3", "cal"]
    ref = brute_knn(train, test, 5)
    for size in (256, 3):
        model = I.fit_knn(_frame(spark, train), ["e", "d"], cols, k=5, bucket=size)
        got = model.transform(_frame(spark, test, offset=100)).orderBy("e").select(*cols).toPandas().to_numpy(dtype=float)
        assert np.allclose(got[:, 0], ref[:, 0])


def test_fill_keeps_null_entities(spark):
    rows = [(None, D0, 1.0), (None, D0 + dt.timedelta(days=1), None), (1, D0, 2.0)]
    got = I.ffill_bfill(spark.createDataFrame(rows, "e int, d date, v double"), "e", ["d"], ["v"]).collect()
    assert sorted(r.v for r in got) == [1.0, 1.0, 2.0]


def _numbers(spark, arr, keys=None):
    p = arr.shape[1]
    rows = [(int(i if keys is None else keys[i]), *[None if math.isnan(v) else float(v) for v in r]) for i, r in enumerate(arr)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("e", T.IntegerType())] + [T.StructField(f"c{i}", T.DoubleType()) for i in range(p)]))


def test_pruned_search_equals_brute_force_and_prunes(spark, monkeypatch):
    """Many buckets and patterns, ties, a dense region split into shares, and far fewer distances than all pairs."""
    from panelforge.operators import knn

    monkeypatch.setattr(knn, "VISITS", 7)
    monkeypatch.setattr(knn, "WIDE", 2)
    rng = np.random.default_rng(3)
    centre = rng.normal(0, 100, (12, 3))
    train = np.column_stack([centre[rng.integers(0, 12, 900)] + rng.normal(0, 1, (900, 3)), rng.integers(0, 3, 900)]).round(1)
    train[rng.random(train.shape) < 0.15] = np.nan
    train[:5] = np.nan  # donors without any value
    test = np.column_stack([centre[rng.integers(0, 12, 120)] + rng.normal(0, 1, (120, 3)), rng.integers(0, 3, 120)]).round(1)
    test[rng.random(test.shape) < 0.3] = np.nan
    test[0] = np.nan
    test[1] = [1e6, np.nan, -1e6, 0.0]
    cols = ["c0", "c1", "c2", "c3"]
    model = knn.fit_knn(_numbers(spark, train), ["e"], cols, k=4, bucket=16)
    got = model.transform(_numbers(spark, test)).orderBy("e").select(*cols).toPandas().to_numpy()
    assert np.allclose(got, brute_knn(train, test, 4), rtol=1e-9, atol=1e-9)
    assert len(model.directory.ids) > 30 and model.stats["compared"] < 0.35 * model.stats["all_pairs"]


def test_knn_fills_rows_that_share_a_key_each_for_itself(spark):
    rng = np.random.default_rng(4)
    train, test = rng.normal(0, 5, (60, 3)), rng.normal(0, 5, (20, 3))
    test[:, 1] = np.nan
    model = I.fit_knn(_numbers(spark, train), ["e"], ["c0", "c1", "c2"], k=3)
    got = sorted(map(tuple, model.transform(_numbers(spark, test, [7] * 20)).select("c0", "c1", "c2").collect()))
    assert np.allclose(got, sorted(map(tuple, brute_knn(train, test, 3))))


def test_bounds_never_exceed_distances():
    from panelforge.operators import knn

    rng = np.random.default_rng(5)
    y = rng.normal(0, 10, (400, 5))
    y[rng.random(y.shape) < 0.3] = np.nan
    x = rng.normal(0, 10, (30, 5))
    x[rng.random(x.shape) < 0.3] = np.nan
    b = knn.Buckets.fit(y[:150], 400, 10, 1 << 16).of(y)  # placed on a part of the rows
    ids = np.unique(b)
    there = ~np.isnan(y)
    column = lambda f: np.array([[f(y[b == i, c][there[b == i, c]]) if there[b == i, c].any() else np.nan for c in range(5)] for i in ids])
    d = knn.Directory(ids, np.array([(b == i).sum() for i in ids]), np.array([there[b == i].sum(axis=0) for i in ids]), column(np.min), column(np.max))
    bound, sure = d.bounds(x)
    for r, row in enumerate(x):
        for c, i in enumerate(ids):
            for z in y[b == i]:
                both = ~np.isnan(row) & ~np.isnan(z)
                assert both.any() or not sure[r, c]
                if both.any():
                    assert bound[r, c] <= math.sqrt(5 / both.sum() * ((row - z)[both] ** 2).sum())
