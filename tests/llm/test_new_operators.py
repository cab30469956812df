"""Exact dedup, importance resampling and fill-in-the-middle: against brute force, on awkward rows, and against their SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from panelforge.llm import exact_dedup, fim, importance
from panelforge.llm import queries as q
from panelforge.llm.common import table

LONG = "".join(f"line {i} of a text with {i % 7} ends\n" for i in range(20000))
ROWS = [
    (1, None, "x"),
    (2, "", "x"),
    (3, " \t\n\v\f\r", "x"),
    (4, "one two three", "x"),
    (5, "one  two\nthree ", None),
    (5, "one  two\nthree ", None),
    (None, "one\ttwo three", "x"),
    (6, LONG, "x"),
    (7, LONG[:-1], "x"),
    (8, "a <P> mark\nin it\n", "x"),
    (None, "no id\nbut lines\n\n", "x"),
    (None, "no id\nbut lines\n\n", "x"),
    (9, "é😀   é\nﬂ\n", "x"),
    (10, "<\nP>\n<P\n>S>\n<", "x"),
    (11, "Word " * 30, "x"),
    (12, "word " * 30, "x"),
    (13, "w" * 300 + " " + "v" * 70 + " ok " + "w" * 300, "x"),
]
SCHEMA = "doc_id bigint, text string, keep_id string, kept string, weight string, rank string, n string, k string, pos string, c string, _p string, _m string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *["x"] * 9) for r in ROWS], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def duck(sql, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return sorted(map(tuple, con.execute(f"SELECT * FROM ({sql}) ORDER BY ALL").fetchall()), key=str)


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op13_fim"])
def test_against_sql(spark, sf, name):
    got = q.QUERIES[name](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(q.ORACLE[name])
    assert [c[0] for c in want.description] == got.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


# --- 11 exact dedup


def bare(t):
    return re.sub("[\x20\x09-\x0d]", "", t or "")


def brute_groups(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(bare(t), []).append((-len(t or ""), d is None, d or 0, d))
    return {k: (min(v)[-1], len(v)) for k, v in groups.items()}


def check_groups(got, rows):
    want = brute_groups(rows)
    texts = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    assert len(got) == len(rows) and {r.text_sha256 for r in got} == set(texts)
    assert all((r.keep_id, r.group_size) == texts[r.text_sha256] for r in got)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(list(texts)) and all(r.doc_id == r.keep_id for r in got if r.kept)




@pytest.mark.parametrize(("parts", "fan"), [(1, 3), (2, 1), (13, 1), (13, 2), (40, 3)])
def test_exact_dedup_over_any_number_of_runs(spark, parts, fan):
    rng = np.random.default_rng(parts)
    rows = [(int(d), "hot text" + " " * int(rng.integers(0, 3)) if d % 3 == 0 else f"t{rng.integers(0, 150)}" + "\n" * int(rng.integers(0, 3))) for d in range(600)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    check_groups(exact_dedup.mark_copies(frame, fan_bits=fan).collect(), rows)


@pytest.mark.parametrize("size", [1, 7])
def test_operators_over_many_batches(spark, docs, size):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, size)
        rows = [r[:2] for r in ROWS]
        check_groups(exact_dedup.mark_copies(docs.coalesce(1)).collect(), rows)
        got = fim.round_trip(docs, chunk=1000).collect()
        assert sorted(map(tuple, got), key=str) == sorted([(*x, sha(out), sha(t)) for x, out, t in (brute_fim(*r) for r in rows)], key=str)
    finally:
        spark.conf.set(key, before)


def test_exact_dedup_edges(spark, docs, none):
    out = exact_dedup.mark_copies(docs)
    assert out.columns == [c for c in docs.columns if c not in ("keep_id", "kept")] + ["keep_id", "group_size", "kept", "text_sha256"]
    check_groups(out.collect(), [r[:2] for r in ROWS])
    assert exact_dedup.mark_copies(none).count() == 0
    stay = exact_dedup.drop_copies(docs)
    assert stay.columns == [c for c in docs.columns if c not in ("keep_id", "kept")] and stay.count() == len(brute_groups([r[:2] for r in ROWS]))
    named = spark.createDataFrame([("b", "x"), ("a", "x "), ("a", "x y")], "name string, body string")
    got = {(r.name, r.body): (r.keep_id, r.group_size, r.kept) for r in exact_dedup.mark_copies(named, "name", "body").collect()}
    assert got == {("b", "x"): ("a", 2, False), ("a", "x "): ("a", 2, True), ("a", "x y"): ("a", 1, True)}


def test_exact_dedup_tells_apart_texts_of_one_digest(spark, monkeypatch):
    real = exact_dedup.digest_of
    rows = [(1, "p"), (2, "q"), (3, "p "), (4, "qq")]
    same = {"p": 1, "q": 2, "qq": 2}
    fake = lambda t: (real(t)[0], 0, 0, 0, 0, same[(t or b"").decode().strip()], real(t)[-1])  # noqa: E731  the first digest says nothing
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    monkeypatch.setattr(exact_dedup, "digest_of", fake)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.mark_copies(frame).collect()}
    assert got == {1: (3, 2), 3: (3, 2), 2: (2, 1), 4: (4, 1)}


# --- 12 importance resampling


def brute_resample(rows, target, percent=5, least=20):
    def features(t):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return w, Counter(zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1))

    every = [(d, *features(t)) for d, t in rows]
    s, t = Counter(), Counter()
    for _, _, f in every:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    big, small = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big + 10000) / ((s[b] + 1) * (small + 10000)))) for b in range(10000)}
    out = []
    for d, w, f in every:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * n for b, n in f.items())
        out.append([d, sum(f.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= least])
    drawn = sorted((-x[3], x[0] is None, x[0] or 0, i) for i, x in enumerate(out) if x[4])
    rank = {x[-1]: r for r, x in enumerate(drawn[: percent * len(drawn) // 100], 1)}
    return sorted([(*x[:4], rank.get(i)) for i, x in enumerate(out)], key=str)


@pytest.mark.parametrize(("words", "pairs"), [(8192, 32768), (50, 20), (0, 0)])
def test_resampling_against_plain_counts(spark, sf, words, pairs):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    target = table(spark, sf, "benchmark").select("text")
    want = brute_resample(rows, [r.text for r in target.collect()])
    frame = table(spark, sf, "documents").select("doc_id", "text").repartition(3)
    got = importance.resample(frame, target, head_words=words, head_pairs=pairs, drop=("text",)).collect()
    assert sorted(map(tuple, got), key=str) == want
    if words == 8192:
        assert sorted(map(tuple, q.op12_importance(spark, sf).collect()), key=str) == want


def test_resampling_edges(spark, docs, none):
    target = spark.createDataFrame([("word word here",), (None,)], "text string")
    out = importance.resample(docs, target, percent=50)
    assert out.columns == [c for c in docs.columns if c not in ("weight", "rank")] + ["n_features", "weight", "score", "rank"]
    want = brute_resample([r[:2] for r in ROWS], ["word word here"], 50)
    assert sorted([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()], key=str) == want
    assert importance.resample(none, target).count() == 0
    empty = importance.resample(docs, target.limit(0), percent=100)
    assert sorted([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in empty.collect()], key=str) == brute_resample([r[:2] for r in ROWS], [], 100)


def test_crc_states_go_on_over_any_length():
    shift = importance.Shift()
    a = [b"", b"a", b"xyz" * 50]
    b = [b"b" * n for n in (0, 1, 5, 63, 64, 65, 129, 1000)]
    pairs = [(x, y) for x in a for y in b]
    state = np.array([zlib.crc32(x) for x, _ in pairs], dtype=np.uint32)
    got = shift(state, np.array([len(y) for _, y in pairs])) ^ np.array([zlib.crc32(y) for _, y in pairs], dtype=np.uint32)
    assert got.tolist() == [zlib.crc32(x + y) for x, y in pairs]


def test_summary_keeps_every_frequent_entry():
    seen = Counter({f"w{i}": 100 + i for i in range(10)} | {f"r{i}": 1 for i in range(1000)})
    left = importance._prune(seen, 20)
    assert {f"w{i}" for i in range(10)} <= set(left) and len(left) <= 20


# --- 13 fill in the middle


def brute_fim(d, t):
    t = t or ""
    u = re.findall("[^\n]*\n|[^\n]+", t)
    h = hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(u) + 1) for x in h[:2])
    x, y, z = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    form = "plain" if not t or re.search("<[PSM]>", t) else "spm" if h[3] % 100 < 50 else "psm"
    out = {"plain": t, "psm": f"<P>{x}<S>{z}<M>{y}", "spm": f"<S>{z}<P>{x}<M>{y}"}[form]
    return (d, len(u), form, *((None, None) if form == "plain" else (len(x), len(y)))), out, t


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("chunk", [1 << 16, 1, 3, 50])
def test_fim_round_trip(spark, docs, none, chunk):
    rows = [r[:2] for r in ROWS] if chunk > 50 else [(d, (t or "")[:300]) for d, t, _ in ROWS]
    frame = docs if chunk > 50 else spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = [brute_fim(*r) for r in rows]
    got = fim.round_trip(frame, chunk=chunk).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(*x, sha(out), sha(t)) for x, out, t in want], key=str)
    outputs = fim.texts(fim.transform(frame, chunk=chunk)).collect()
    assert sorted(map(tuple, outputs), key=str) == sorted([(*x, out) for x, out, _ in want], key=str)
    assert fim.round_trip(none).count() == 0


def test_fim_rates_and_one_exchange(spark, sf):
    docs = table(spark, sf, "documents")
    assert {r.form for r in fim.round_trip(docs, rate=0).select("form").distinct().collect()} == {"plain"}
    assert {r.form for r in fim.round_trip(docs, spm=100).select("form").distinct().collect()} <= {"plain", "spm"}
    assert q.op13_fim(spark, sf)._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1


def test_scanner_finds_marks_in_any_cuts():
    out = b"<P>a<\nP<S>s<S\n<M>m<"
    for size in range(1, 9):
        scan, parts = fim.Scanner(False), {0: b"", 1: b"", 2: b""}
        for i in range(0, len(out), size):
            for place, x in scan.feed(out[i : i + size]):
                parts[place] += x
        for place, x in scan.feed(b"", end=True):
            parts[place] += x
        assert parts == {0: b"a<\nP", 2: b"s<S\n", 1: b"m<"}, size
