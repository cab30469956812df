"""Stages of the pipeline against brute force: what goes and what stays."""

import numpy as np

import corpus_pipeline as c
from panelforge.llm.common import table

from .test_operators import brute_components, brute_lines

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t)) for d, t in rows], SCHEMA).repartition(3)


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_near_duplicates_keep_rows_of_one_id(spark):
    word = lambda k, n=40: " ".join(f"{k}{i}" for i in range(n))
    rows = [(1, word("a")), (1, word("b")), (1, word("b")), (2, word("b") + " end"), (3, word("c")), (3, None), (None, word("a"))]
    got = kept(c.near_duplicates(spark, frame(spark, rows), ""))
    assert got == sorted([(1, word("a")), (1, word("b")), (3, word("c")), (3, None), (None, word("a"))], key=str)


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    base = [rng.integers(0, 400, rng.integers(3, 90)) for _ in range(12)]
    rows = []
    for d in range(120):
        x = base[d % 12].copy()
        for _ in range(rng.integers(0, 3)):
            x[rng.integers(0, len(x))] = rng.integers(0, 400)
        rows.append((d, " ".join(f"w{i}" for i in x)))
    sets, root = brute_components(rows, 5, 80)
    least = {r: min(d for (d, _), q in zip(sets, root, strict=True) if q == r) for r in root}
    assert kept(c.near_duplicates(spark, frame(spark, rows), "")) == sorted([r for r in rows if r[0] in least.values()], key=str)


def test_other_stages_keep_clean_documents(spark, sf):
    docs = table(spark, sf, "documents")
    good = {r.doc_id for r in table(spark, sf, "labels").where("quality = 1").collect()}
    stayed = {r.doc_id for r in c.quality(spark, docs, sf).select("doc_id").collect()}
    assert len(good - stayed) <= len(good) / 20
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = {d for (d, t), x in brute_lines(rows, 50).items() if x or not t.strip()}
    assert {r.doc_id for r in c.line_deduplication(spark, docs, sf).select("doc_id").collect()} == want
    items = [r.text.split() for r in table(spark, sf, "benchmark").select("text").collect()]
    clean = [(1, "a plain text of its own"), (2, " ".join(f"word{i}" for i in range(200))), (3, " ".join(items[0][:3])), (4, None)]
    leak = (5, "Before it. " + " ".join(items[0]) + " After it.")
    assert kept(c.decontamination(spark, frame(spark, [*clean, leak]), sf)) == sorted(clean, key=str)
