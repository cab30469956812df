"""Quantiles, moments, bands and categories (FIXTURES band_edges / category_edges)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelforge.functions import bands as B
from panelforge.operators import quality as Q
from panelforge.operators.quantiles import exact_quantiles, exact_quantiles_many


@pytest.mark.parametrize(("parts", "accuracy"), [(2, 10), (7, 50), (256, 10_000)])
def test_exact_quantiles_match_numpy(spark, parts, accuracy):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(50, 20, 900), np.full(200, 42.0), [np.nan] * 5])
    df = spark.createDataFrame([(None if np.isnan(v) else float(v),) for v in vals], "v double")
    probs = [0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
    got = exact_quantiles(df, "v", probs, parts, accuracy)
    ref = np.nanquantile(vals, probs)  # linear interpolation
    assert np.allclose(got, ref, rtol=0, atol=1e-9)


def test_quantiles_of_many_columns_at_once(spark):
    """Ties, one value, no value, infinities, magnitudes from 1e-300 to 1e300, both signs: exact, whatever the sketch says."""
    rng = np.random.default_rng(5)
    n = 600
    data = {
        "ties": np.repeat(7.0, n),
        "mostly": np.where(rng.random(n) < 0.9, 3.0, rng.normal(0, 1e6, n)),
        "wild": rng.choice([-1.0, 1.0], n) * 10.0 ** rng.uniform(-300, 300, n),
        "steep": 2.0 ** np.arange(-300, 300),
        "negative": -np.exp(rng.normal(0, 30, n)),
        "ends": np.concatenate([[np.inf] * 20, [-np.inf] * 20, rng.normal(0, 1, n - 40)]),
        "near": 1.0 + np.arange(n) * 2.0**-52,
        "none": np.full(n, np.nan),
    }
    rows = [tuple(None if np.isnan(x) else float(x) for x in r) for r in zip(*data.values(), strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}.x` double" for c in data)).repartition(3)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    for parts, accuracy in ((256, 10_000), (5, 10)):
        got = exact_quantiles_many(df, {f"{c}.x": probs for c in data}, parts, accuracy)
        for c, x in data.items():
            order = np.sort(x)
            at = np.array(probs) * (n - 1)
            low = np.floor(at).astype(int)
            high = np.minimum(low + 1, n - 1)
            with np.errstate(all="ignore"):
                want = [None] * len(probs) if c == "none" else [a if f == 0 else a + (b - a) * f for a, b, f in zip(order[low], order[high], at - low, strict=True)]
            assert [None if g is None else repr(float(g)) for g in got[f"{c}.x"]] == [None if w is None else repr(float(w)) for w in want], (c, parts)


def test_quantiles_take_few_aggregates_and_no_values(spark, monkeypatch):
    from panelforge.operators import quantiles

    passes = []
    real = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda v, pending, parts: passes.append(len(pending)) or real(v, pending, parts))
    df = spark.range(50_000).selectExpr("id * 37 % 50000 / 7.0 AS a", "pow(id % 1000, 3) AS b", "if(id % 3 = 0, 5.0, id) AS c")
    got = exact_quantiles_many(df, dict.fromkeys("abc", [0.25, 0.5, 0.75]))
    pdf = df.toPandas()
    assert all(np.allclose(got[c], np.quantile(pdf[c].astype(float), [0.25, 0.5, 0.75])) for c in "abc")
    assert len(passes) <= 3


def test_corrected_moments_match_pandas(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 7.0, 11.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = Q.distribution(df, "v").first()
    s = pd.Series(vals, dtype=float)
    assert abs(r.skewness - s.skew()) < 1e-12 and abs(r.kurtosis - s.kurt()) < 1e-12
    assert r.median == s.median() and r.missing == 1 and r.skew_direction == "right"


def test_band_edges_reference_and_continuous(spark):
    vals = [-1.0, None, 0.0, 30.0, 30.05, 30.1, 500.0, 500.1]
    df = spark.createDataFrame([(v,) for v in vals], "c double")
    ref = [r[0] for r in df.select(B.subindex("c", gaps="reference")).collect()]
    assert ref == [None, None, 0, 50, 500, 51, 500, 500]
    cont = [r[0] for r in df.select(B.subindex("c", gaps="continuous")).collect()]
    assert cont == [None, None, 0, 50, 51, 51, 500, 500]
    joined = [r.subindex for r in B.subindex_join(df.withColumn("i", F.monotonically_increasing_id()), "c",
                                                  B.band_table(spark)).orderBy("i").collect()]
    assert joined == ref


def test_category_edges(spark):
    vals = [50, 51, 100, 101, 200, 201, 300, 301, 400, 401, 501, None]
    df = spark.createDataFrame([(v,) for v in vals], "i int")
    got = [r[0] for r in df.select(B.category("i")).collect()]
    assert got == ["Good", "Satisfactory", "Satisfactory", "Moderate", "Moderate", "Poor", "Poor", "Very Poor",
                   "Very Poor", "Severe", "Severe", "Unknown"]
    sizes = [r[0] for r in df.select(F.size(B.advisories(B.category("i")))).collect()]
    assert sizes[:11] == [3, 3, 3, 4, 4, 5, 5, 5, 5, 6, 6]


def test_zero_reading_rule(spark):
    df = spark.createDataFrame([(0.0, 12.0), (0.0, None), (None, 4.0), (3.0, 9.0)], "a double, b double")
    parity = [r[0] for r in df.select(B.first_present(F.col("a"), F.col("b"), zero_is_missing=True)).collect()]
    assert parity == [12.0, None, 4.0, 3.0]
    fixed = [r[0] for r in df.select(B.first_present(F.col("a"), F.col("b"))).collect()]
    assert fixed == [0.0, 0.0, 4.0, 3.0]


def test_grouped_quantiles_match_pandas(spark):
    from panelforge.operators.quantiles import exact_quantiles_grouped

    rng = np.random.default_rng(11)
    rows = [("hot", float(x)) for x in rng.normal(0, 1, 700)] + [("b", 1.0), ("b", 4.0), ("c", None), ("d", 2.0)]
    rows += [("hot", 0.5)] * 50  # duplicates
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.q0, r.q1) for r in exact_quantiles_grouped(df, ["g"], "v", [0.5, 0.9]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g, grp in pdf.groupby("g"):
        ref = grp["v"].quantile([0.5, 0.9]).tolist()
        if grp["v"].notna().sum() == 0:
            assert got[g] == (None, None)
        else:
            assert np.allclose(got[g], ref, atol=1e-12)


def test_grouped_quantiles_of_many_columns_and_null_groups(spark):
    from panelforge.operators.quantiles import exact_quantiles_grouped

    rng = np.random.default_rng(12)
    rows = [(None if i % 5 == 0 else "ab"[i % 2], 1.0 if i % 3 else float(rng.normal()), None if i % 4 == 0 else float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(3)
    got = {r.g: (r.v_q0, r.w_q0, r.v_q1, r.w_q1) for r in exact_quantiles_grouped(df, ["g"], ["v", "w"], [0.5, 0.9]).collect()}
    for g in (None, "a", "b"):
        v, w = (np.array([r[c] for r in rows if r[0] == g and r[c] is not None]) for c in (1, 2))
        assert np.allclose(got[g], [np.quantile(v, 0.5), np.quantile(w, 0.5), np.quantile(v, 0.9), np.quantile(w, 0.9)])
