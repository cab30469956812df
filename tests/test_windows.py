"""Window features: ranges with carried rows == plain window == pandas, on edge panels."""

import datetime as dt
import math

import pandas as pd
import pytest

from panelforge.operators import windows as W

D0 = dt.date(2020, 1, 1)


def _panel(spark):
    rows = []
    # entity 1: gappy days and NULL runs, long enough to cross several chunks
    for i in range(60):
        if i % 7 == 3:
            continue  # missing calendar days
        v = None if 10 <= i < 18 or i in (0, 1) else float((i * 37) % 23)
        rows.append((1, D0 + dt.timedelta(days=i), v))
    rows.append((2, D0, 5.0))  # one-row entity
    for i in range(20):  # entity 3: dense
        rows.append((3, D0 + dt.timedelta(days=2 * i), float(i)))
    rows.append((3, None, 99.0))  # NULL date sorts last
    return spark.createDataFrame(rows, "e int, d date, v double")


FEATS = (W.lag_features({"v": [1, 2, 3, 7]}) + W.rolling_features("v") + W.change_features(["v"])
         + [W.Feature("v_med", "median", "v", 7)])


def _pandas_reference(pdf):
    out = []
    for _, g in pdf.sort_values(["e", "d"], na_position="last").groupby("e", sort=False):
        v = g["v"]
        r = g[["e", "d", "v"]].copy()
        for k in (1, 2, 3, 7):
            r[f"v_lag_{k}"] = v.shift(k)
        s = v.shift(1)
        r["v_roll_mean_3"] = s.rolling(3, min_periods=1).mean()
        r["v_roll_mean_7"] = s.rolling(7, min_periods=1).mean()
        r["v_roll_std_7"] = s.rolling(7, min_periods=2).std()
        r["v_roll_max_7"] = s.rolling(7, min_periods=1).max()
        r["v_roll_min_7"] = s.rolling(7, min_periods=1).min()
        r["v_change"] = v - v.shift(1)
        r["v_med"] = v.rolling(7, min_periods=1).median()
        out.append(r)
    return pd.concat(out)


def _cell(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return (0, "")
    if isinstance(x, float):
        return (1, repr(round(x, 9) + 0.0))
    if hasattr(x, "isoformat"):
        return (1, x.isoformat()[:10])
    return (1, repr(x))


def _rows(df):
    return sorted(tuple(_cell(x) for x in r) for r in df)


@pytest.mark.parametrize("parts", [None, 1, 3, 10, 90])
def test_ranges_equal_pandas(spark, parts):
    p = _panel(spark)
    made = W.add_window_features(p, "e", ["d"], FEATS, parts) if parts else W.window_features(p, "e", ["d"], FEATS)
    got = made.toPandas()
    ref = _pandas_reference(p.toPandas())
    cols = ["e", "d", "v"] + [f.name for f in FEATS]
    a = _rows(got[cols].itertuples(index=False))
    b = _rows(ref[cols].astype(object).where(ref[cols].notna(), None).itertuples(index=False))
    assert len(a) == len(b) == p.count()
    assert a == b


def test_threshold_crossing(spark):
    p = spark.createDataFrame([(1, D0 + dt.timedelta(days=i), float(v)) for i, v in enumerate([1, 5, 2, 6, 6, 1, 9])],
                              "e int, d date, v double")
    got = W.threshold_crossings(p, "e", ["d"], "v", 5.0, 3).orderBy("d").select("v", "v_prev").collect()
    assert [(r.v, r.v_prev) for r in got] == [(5.0, 1.0), (6.0, 2.0), (9.0, 1.0)]


@pytest.mark.parametrize(("parts", "batch"), [(1, 10_000), (1, 1), (7, 2), (40, 10_000)])
def test_ranges_equal_plain_windows_of_any_type(spark, parts, batch):
    """NULL entities and times, NaN, integers, decimals, dates, strings, repeated times; ranges and batches shorter than the look-back."""
    rows = []
    for i in range(80):
        e = None if i % 9 == 0 else "hot" if i % 3 else f"e{i % 4}"
        day = None if i % 13 == 0 else D0 + dt.timedelta(days=i // 2)
        rows.append((e, day, i, None if i % 5 == 0 else i * 31 % 17, float("nan") if i % 23 == 0 else None if i % 6 == 0 else i * 7.5 % 11, f"s{i * 5 % 7}"))
    p = spark.createDataFrame(rows, "e string, d date, k int, `v.1` int, x double, s string").withColumn("m", W.qcol("v.1").cast("decimal(10,2)"))
    feats = W.lag_features({"v.1": [1, 9], "s": [2], "m": [1], "d": [3]}) + W.rolling_features("x") + W.rolling_features("v.1", (12,), 3) + W.change_features(["x", "v.1"])
    feats += [W.Feature("x_med", "median", "x", 5), W.Feature("m_max", "max", "m", 4), W.Feature("s_min", "min", "x", 2), W.Feature("m_mean", "mean", "m", 2)]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, batch)
        got = W.add_window_features(p.repartition(5), "e", ["d", "k"], feats, parts)
        want = W.window_features(p, "e", ["d", "k"], feats)
        assert got.schema == want.schema
        assert sorted(map(_cell_row, got.collect())) == sorted(map(_cell_row, want.collect()))
    finally:
        spark.conf.set(key, before)
    assert W.add_window_features(p.limit(0), "e", ["d", "k"], feats, parts).count() == 0


def _cell_row(row):
    return tuple((0, "nan") if isinstance(x, float) and math.isnan(x) else _cell(x) for x in row)


def test_one_read_one_exchange_and_a_hot_entity_over_many_tasks(spark):
    p = spark.range(4000).selectExpr("'hot' AS e", "id AS d", "cast(id AS double) AS v")
    persisted = set(spark.sparkContext._jsc.getPersistentRDDs())
    got = W.add_window_features(p, "e", ["d"], [W.Feature("v_lag_1", "lag", "v", 1)], 8)
    sizes = [r["count"] for r in got.groupBy(W.F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2000
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()  # the one exchange lies before the checkpoint
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= persisted
