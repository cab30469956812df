"""Interval and containment lookups against plain loops."""

import math

import numpy as np
import pytest

from panelforge.operators.joins import longest_contained, range_lookup
from panelforge.operators.metrics import ordered_position
from panelforge.operators.rank import interpretability_join


def brute(v, bands):
    hits = [b for b in bands if v is not None and not math.isnan(v) and (b[0] if b[0] is not None else -math.inf) <= v <= (b[1] if b[1] is not None else math.inf)]
    return min(hits, key=lambda b: (b[0] if b[0] is not None else -math.inf, b[1] if b[1] is not None else math.inf, b[2]))[2] if hits else None


@pytest.mark.parametrize("kind", ["even", "uneven", "overlap", "open", "one", "none", "points"])
def test_range_lookup_equals_a_loop(spark, kind):
    rng = np.random.default_rng(len(kind))
    edges = np.sort(rng.choice([rng.uniform(-50, 50, 41), rng.lognormal(0, 3, 41)][kind == "uneven"], 41, replace=False)).round(2)
    bands = {
        "even": [(a, b, f"b{a}") for a, b in zip(edges, edges[1:], strict=False)],
        "uneven": [(a, b, f"b{a}") for a, b in zip(edges[::2], edges[1::2], strict=False)],
        "overlap": [(float(a), float(a + rng.uniform(0, 40)), f"b{i}") for i, a in enumerate(edges)],
        "open": [(None, edges[3], "low"), (edges[5], edges[9], "mid"), (edges[20], None, "high")],
        "one": [(None, None, "all")], "none": [], "points": [(a, a, f"b{a}") for a in edges],
    }[kind]
    bands = [tuple(float(x) if isinstance(x, np.floating) else x for x in b) for b in bands]
    values = [None, math.nan, math.inf, -math.inf, 0.0, *map(float, edges), *map(float, edges), *map(float, rng.uniform(-60, 200, 200).round(2))]
    df = spark.createDataFrame([(i // 2, v) for i, v in enumerate(values)], "k int, v double").repartition(3)
    table = spark.createDataFrame(bands, "lo double, hi double, label string")
    got = range_lookup(df, df["v"], table, "lo", "hi", ["label"])
    assert got.columns == ["k", "v", "label"]
    assert sorted(((r.k, repr(r.v), r.label) for r in got.collect()), key=str) == sorted(((i // 2, repr(v), brute(v, bands)) for i, v in enumerate(values)), key=str)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_longest_keyword_keeps_every_row(spark):
    names = ["Random Forest", "Forest", "RandomForestXL", "Tree", None, "", "Tree", "ForestTree", "é Baum"]
    rules = [("Forest", 0.5), ("Random", 0.3), ("RandomForest", 0.9), ("Tree", 0.7), ("é", 0.1), (None, 9.0)]
    df = spark.createDataFrame([(i % 3, n) for i, n in enumerate(names)] * 2, "k int, m string")

    def want(n, empty=0.4):
        hits = [(-len(k), k, s) for k, s in rules if k and n and k in n]
        return min(hits)[2] if hits else empty

    table = spark.createDataFrame(rules, "keyword string, score double")
    got = interpretability_join(df, "m", table)
    assert sorted(((r.m, r.interpretability) for r in got.collect()), key=str) == sorted([(n, want(n)) for n in names] * 2, key=str)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString() and "Cartesian" not in got._jdf.queryExecution().executedPlan().toString()
    with_empty = table.unionByName(spark.createDataFrame([("", 0.2)], table.schema))
    assert {r.m: r.interpretability for r in interpretability_join(df, "m", with_empty).collect()}["Tree"] == 0.7
    assert longest_contained(df, "m", table.limit(0), "keyword", "score", "s", 0.4).where("s = 0.4").count() == 18


def test_positions_in_groups_with_nulls_and_ties(spark):
    rows = [("a", 1, 3), ("a", 1, 3), ("a", None, 1), ("a", 0, None), ("b", 2, 2), (None, 5, 1)]
    got = ordered_position(spark.createDataFrame(rows, "g string, e int, t int"), ["g"], "e", "t").collect()
    assert sorted((str(r.g), r.Index) for r in got) == [("None", 0), ("a", 0), ("a", 1), ("a", 2), ("a", 3), ("b", 0)]
    assert {(r.e, r.t): r.Index for r in got if r.g == "a" and r.e != 1} == {(0, None): 0, (None, 1): 3}
