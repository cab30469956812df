"""Quality classifier by co-training of two views.

View one is the text: hashed words, hashed n-grams of its character shapes (letter case,
digits, punctuation as it is) and how often its words repeat. View two is the
page's metadata: language, source, length and the layout of its lines. Each
view has a logistic regression, first fitted on the labelled texts. Over
``ROUNDS`` rounds *all* unlabelled texts are scored by both views in a Spark job; a
histogram of the log odds of all of them tells above and below which odds a view is
confident (at least ``SURE``, and a share of the corpus that grows with the rounds), and the *other*
view goes on learning from these texts too: gradients and curvatures are summed over all of them in the
tasks, combined in two levels, and added to those of the labelled texts. On labelled texts held back,
each view's log odds are calibrated and their combination is fitted; the
combined probability scores every document.

Features of every document are worked out once, as bytes, and written to the
shared folder; the rounds read them there. Only the *labelled* texts that are fitted on are bounded
(``labelled``, chosen by a hash of the id). What the driver gets of a round is a
histogram and at most ``MERGED`` pairs of vectors, whatever the number of documents.

Edge cases: null and empty texts have zero text features; very long texts are taken whole; null language or
source is a value of its own; without labels of both classes every document
gets score 1 and is kept; labels repeated for a document count as good only if
all are; repeated rows score alike, so there are no ties to break; an empty table gives no rows; columns of the
input named as the new ones are replaced, all others pass.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.session import materialize

from .common import append_columns, bounded, crc_mod, map_rows, shared_folder, small_batches

SHAPES, WORDS, CODES = 1 << 10, 1 << 11, 64
TEXT, META = SHAPES + WORDS + 3, 2 * CODES + 8
LABELLED = 3000
ROUNDS, SURE, SHARE = 4, 0.95, 0.15
#: Gradient steps of a round, weight of all confident texts against the labelled ones, partial sums that reach the driver, bins of a histogram (log odds of -30 to 30).
STEPS, TRUST, MERGED, BINS = 4, 0.2, 32, 1200
#: Square roots of shares times this are kept as bytes.
_SCALE = 1.5 * 255
_SHAPE = bytes(0x41 if 0x41 <= b <= 0x5A else 0x61 if 0x61 <= b <= 0x7A else 0x30 if 0x30 <= b <= 0x39 else 0x75 if b >= 0x80 else b for b in range(256))


def text_view(text: bytes | None) -> np.ndarray:
    """Bytes: shares of hashed shape n-grams (2 to 4 bytes) and of hashed words, then of distinct words, adjacent equal words and repeated lines."""
    out = np.zeros(TEXT, dtype=np.float32)
    if not text:
        return out.astype(np.uint8)
    a = np.frombuffer(text.translate(_SHAPE), dtype=np.uint8).astype(np.uint32)
    h = a.copy()
    for n in (2, 3, 4):
        if len(a) < n:
            break
        h = h[: len(a) - n + 1] * np.uint32(257) + a[n - 1 :]
        mixed = (h + np.uint32(n)) * np.uint32(2654435761)
        mixed ^= mixed >> np.uint32(15)
        out[:SHAPES] += np.bincount((mixed * np.uint32(2246822519)) >> np.uint32(32 - 10), minlength=SHAPES)
    out[:SHAPES] = np.sqrt(out[:SHAPES] / max(1.0, float(out[:SHAPES].sum())))
    words = text.lower().split()
    seen = Counter(words)
    n = max(1, len(words))
    if words:
        place = np.fromiter((zlib.crc32(w) % WORDS for w in seen), dtype=np.int64, count=len(seen))
        out[SHAPES : SHAPES + WORDS] = np.sqrt(np.bincount(place, np.fromiter(seen.values(), dtype=float, count=len(seen)), WORDS) / n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    again = sum(map(bytes.__eq__, words[1:], words))
    out[SHAPES + WORDS :] = len(seen) / n / 1.5, again / n / 1.5, (1 - len(set(lines)) / max(1, len(lines))) / 1.5
    return np.minimum(out * _SCALE + 0.5, 255).astype(np.uint8)


def meta_view(text: bytes | None, lang: bytes | None, source: bytes | None, n_chars: int | None) -> np.ndarray:
    """Codes of language and source, length, and numbers of the line layout: ten numbers."""
    t = text or b""
    raw = np.bincount(np.frombuffer(t, dtype=np.uint8), minlength=256) if t else np.zeros(256)
    size = max(1, len(t))
    lines = raw[0x0A] + 1
    letters = max(1, raw[0x41:0x5B].sum() + raw[0x61:0x7B].sum())
    spaces = raw[0x20] + raw[0x0A]
    marks = raw[0x21:0x30].sum() + raw[0x3A:0x41].sum() + raw[0x5B:0x61].sum() + raw[0x7B:0x7F].sum()
    plain = raw[[0x2C, 0x2E, 0x27, 0x2D]].sum()
    codes = [zlib.crc32(b"?" if x is None else b"=" + x) % CODES for x in (lang, source)]
    return np.array([*codes, np.log1p(max(0, n_chars or 0)) / 10, np.log1p(lines) / 5, np.log1p(size / lines) / 10, raw[0x41:0x5B].sum() / letters, 10 * raw[0x30:0x3A].sum() / size, spaces / size, 10 * (marks - plain) / size, 10 * plain / size], dtype=np.float32)


def matrices(a: list[bytes], b: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Both views of some texts, from their written form."""
    text = np.frombuffer(b"".join(a), dtype=np.uint8).reshape(-1, TEXT).astype(np.float32) / np.float32(_SCALE)
    m = np.frombuffer(b"".join(b), dtype="<f4").reshape(-1, 10)
    meta = np.zeros((len(m), META), dtype=np.float32)
    rows = np.arange(len(m))
    meta[rows, m[:, 0].astype(int)] = 1
    meta[rows, CODES + m[:, 1].astype(int)] = 1
    meta[:, 2 * CODES :] = m[:, 2:]
    return text, meta


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 150, decay: float = 1e-4) -> np.ndarray:
    """Weights and bias (last) by full-batch gradient steps with momentum on standardised columns."""
    mean = x.mean(axis=0, dtype=np.float64)
    spread = np.sqrt(np.maximum(np.einsum("ij,ij->j", x, x, dtype=np.float64) / len(x) - mean * mean, 0)) + 1e-3
    z = x  # the caller's copy, standardised in place: the matrices are the driver's largest objects
    z -= mean.astype(np.float32)
    z /= spread.astype(np.float32)
    w, b, vw, vb = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    weight = weight / weight.sum()
    rate = 4.0 / max(1.0, float(np.einsum("ij,ij->", z, z, dtype=np.float64)) / len(z))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w.astype(np.float32) + b, -30, 30)))
        e = weight * (p - y)
        vw, vb = 0.9 * vw - rate * (e.astype(np.float32) @ z + decay * w), 0.9 * vb - rate * e.sum()
        w, b = w + vw, b + vb
    w = w / spread
    return np.append(w, b - float(mean @ w)).astype(np.float64)


def _odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1].astype(x.dtype) + w[-1], -30, 30).astype(np.float64)


def _balanced(y: np.ndarray) -> np.ndarray:
    return np.where(y > 0.5, 0.5 / max(1e-9, (y > 0.5).mean()), 0.5 / max(1e-9, (y <= 0.5).mean()))


def _slopes(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Gradient and curvature (rows) of the weighted log loss in each weight and the bias."""
    p = 1 / (1 + np.exp(-_odds(x, w)))
    e, c = (weight * (p - y)).astype(np.float32), (weight * p * (1 - p)).astype(np.float32)
    return np.array([np.append(e @ x, e.sum()), np.append(c @ np.square(x), c.sum())], dtype=np.float64)


def _sums(features: DataFrame, size: int, work) -> np.ndarray:
    """Sum of ``work(text view, meta view)`` (``size`` numbers) over all unlabelled rows, combined in tasks twice."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, at = np.zeros(size), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                total += work(*matrices(part.column(0).to_pylist(), part.column(1).to_pylist()))
                at += 1
        if at:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, at = np.zeros(size), 0
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += np.frombuffer(x, dtype=float)
                at += 1
        if at:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    parts = features.where("y is null").select("a", "b").mapInArrow(add, "s binary").repartition(MERGED).mapInArrow(merge, "s binary")
    return sum((np.frombuffer(bytes(r["s"]), dtype=float) for r in parts.collect()), np.zeros(size))


def _bounds(counts: np.ndarray, most: int, good: float) -> tuple[float, float]:
    """Log odds from which, and up to which, a text is taken as good and as bad: SURE at least, and about ``most`` texts at most."""
    edges = np.linspace(-30, 30, len(counts) + 1)
    sure = float(np.log(SURE / (1 - SURE)))
    above, below = np.cumsum(counts[::-1])[::-1], np.cumsum(counts)
    high = np.flatnonzero(above <= max(1, most * good))
    low = np.flatnonzero(below <= max(1, most * (1 - good)))
    return max(sure, edges[high[0]] if len(high) else np.inf), min(-sure, edges[low[-1] + 1] if len(low) else -np.inf)


def cotrain(features: DataFrame, x: tuple[np.ndarray, np.ndarray], y: np.ndarray, total: int) -> list[np.ndarray]:
    """Weights of both views after the rounds of exchange over all ``total`` unlabelled rows of ``features``."""
    sizes = (TEXT + 1, META + 1)
    even = _balanced(y) / len(y)
    weights = [logistic(m.copy(), y, even) for m in x]
    for turn in range(ROUNDS if total else 0):
        old = weights

        def histogram(*views, old=old):
            return np.concatenate([np.histogram(_odds(m, w), BINS, (-30, 30))[0] for m, w in zip(views, old, strict=True)])

        counts = _sums(features, 2 * BINS, histogram).reshape(2, BINS)
        bounds = [_bounds(c, int(SHARE * total * (turn + 1) / ROUNDS), y.mean()) for c in counts]
        # rows that each view hands over, by its bounds
        taken = [(counts[v][np.linspace(-30, 30, BINS + 1)[:-1] >= bounds[v][0] - 1e-9].sum(), counts[v][np.linspace(-30, 30, BINS + 1)[1:] <= bounds[v][1] + 1e-9].sum()) for v in (0, 1)]
        for _ in range(STEPS):
            now = weights

            def slopes(*views, old=old, now=now):
                out = []
                for v in (0, 1):
                    told = _odds(views[1 - v], old[1 - v])
                    marks = np.where(told >= bounds[1 - v][0], 1.0, np.where(told <= bounds[1 - v][1], 0.0, np.nan))
                    own = ~np.isnan(marks)
                    good, bad = taken[1 - v]
                    weight = TRUST * np.where(marks[own] > 0.5, 0.5 / max(1, good), 0.5 / max(1, bad))
                    out.append(_slopes(views[v][own], marks[own], weight, now[v]).ravel())
                return np.concatenate(out)

            found = _sums(features, 2 * sum(sizes), slopes)
            weights = []
            for v, part in enumerate(np.split(found, [2 * sizes[0]])):
                g, c = part.reshape(2, -1) + _slopes(x[v], y, even, now[v])
                weights.append(now[v] - 0.3 * g / (c + 1e-3))
    return weights


_VIEWS = "y int, c boolean, a binary, b binary"


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text", lang: str = "lang", source: str = "source", n_chars: str = "n_chars", labelled: int = LABELLED) -> dict | None:
    """Model from bounded documents with a label and all without; None without labels of both classes."""
    marks = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg((F.min(label) > 0).cast("int").alias("_y"))
    counts = {r["_y"]: r["count"] for r in marks.groupBy("_y").count().collect()}
    if len(counts) < 2:
        return None
    own = bounded(marks.where("_y = 0"), key, labelled // 2, counts[0]).unionByName(bounded(marks.where("_y = 1"), key, labelled // 2, counts[1]))
    slim = docs.select(F.col(key), F.col(text).alias("t"), F.col(lang).cast("string").alias("l"), F.col(source).cast("string").alias("s"), F.col(n_chars).cast("bigint").alias("n"))
    # a bounded number of labelled rows is broadcast; the texts stay where they are
    joined = slim.join(F.broadcast(own), key, "left")

    def work():
        return lambda cols: [(y, bool(c), text_view(t).tobytes(), meta_view(t, lg, s, n).astype("<f4").tobytes()) for y, c, t, lg, s, n in zip(*cols, strict=True)]

    shared_folder(docs.sparkSession)
    small_batches(docs.sparkSession)
    features = materialize(map_rows(joined.select("_y", F.coalesce(crc_mod(key, 4) == 0, F.lit(False)).alias("c"), "t", "l", "s", "n"), _VIEWS, work))
    got = sorted(features.where("y is not null").collect(), key=lambda r: (r["y"], bytes(r["a"]), bytes(r["b"])))
    learn = [r for r in got if not r["c"]]
    held = [r for r in got if r["c"]]
    if len({r["y"] for r in learn}) < 2:
        return None
    held = held if len({r["y"] for r in held}) == 2 else learn
    x, h = (matrices([bytes(r["a"]) for r in rows], [bytes(r["b"]) for r in rows]) for rows in (learn, held))
    y, yh = (np.array([r["y"] for r in rows], dtype=float) for rows in (learn, held))
    del got, learn, held
    weights = cotrain(features, x, y, features.where("y is null").count())
    z = np.column_stack([_odds(m, w) for m, w in zip(h, weights, strict=True)])
    real = np.where(yh > 0.5, counts[1] / yh.sum(), counts[0] / (1 - yh).sum())  # the held rows count as often as their class occurs
    calibrated = [_platt(z[:, [v]], yh, real) for v in (0, 1)]
    both = np.column_stack([_odds(z[:, [v]], calibrated[v]) for v in (0, 1)])
    return {"weights": weights, "calibrated": calibrated, "both": _platt(both, yh, real)}


def _platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 1e-2) -> np.ndarray:
    """Logistic calibration (Newton), regularised since the classes may separate."""
    x = np.column_stack([z, np.ones(len(z))])
    w = np.zeros(x.shape[1])
    weight = weight / weight.mean()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + decay * np.eye(x.shape[1])
        w = w + np.clip(np.linalg.solve(h, x.T @ (weight * (y - p)) - decay * w), -2, 2)
    return w


def score(docs: DataFrame, model: dict | None, text: str = "text", lang: str = "lang", source: str = "source", n_chars: str = "n_chars", least: float = 0.5, drop: tuple = ()) -> DataFrame:
    """``docs`` (without the columns in ``drop``) plus p_text, p_meta (calibrated views), quality (combined) and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        m = shared.value

        def rows(texts, langs, sources, sizes):
            if m is None:
                return [(1.0, 1.0, 1.0, True) for _ in texts]
            a, b = matrices([text_view(t).tobytes() for t in texts], [meta_view(*x).astype("<f4").tobytes() for x in zip(texts, langs, sources, sizes, strict=True)])
            z = [_odds(_odds(x, w)[:, None], c) for x, w, c in zip((a, b), m["weights"], m["calibrated"], strict=True)]
            p = [1 / (1 + np.exp(-x)) for x in (*z, _odds(np.column_stack(z), m["both"]))]
            return [(*x, x[2] >= least) for x in zip(*[q.tolist() for q in p], strict=True)]

        return rows

    cast = docs.withColumns({lang: F.col(lang).cast("string"), source: F.col(source).cast("string"), n_chars: F.col(n_chars).cast("bigint")})
    return append_columns(cast, [text, lang, source, n_chars], "p_text double, p_meta double, quality double, kept boolean", work, drop)
