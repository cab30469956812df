"""Language identification with averaged subword embeddings.

A text, lower-cased, with everything but letters as one space, is cut into
byte n-grams of ``SIZES`` that lie within a word or touch its borders; each is
hashed to one of ``BUCKETS`` embeddings. The average embedding goes through a
linear softmax. Embeddings and softmax are trained by stochastic gradient
descent in numpy on at most ``per_language`` labelled texts of each language
(a documented bound; whole texts; chosen by a hash of the row). A third of
them is held back to fit the softmax's temperature and the score below which a
prediction is rejected.

Scoring is row-wise: the trained tables (a product of embeddings and softmax,
``BUCKETS`` x languages) are all that tasks need.

Edge cases: a text that is null or has no letter is ``und`` with score 0;
languages are the non-null values seen in training; with none of them every
text is ``und``; repeated rows are predicted alike; an empty table gives no
rows; texts are read whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append_columns, map_rows

SIZES, BUCKETS, WIDTH = (1, 2, 3, 4), 1 << 13, 12
PER_LANGUAGE = 1000
EPOCHS, BATCH, RATE = 8, 32, 0.3
#: Accuracy wanted among the predictions that are not rejected.
WANTED = 0.995
_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def buckets_of(text: bytes | None) -> np.ndarray:
    """Hashed n-grams of a text (with repeats); empty if it has no letter."""
    if not text:
        return np.empty(0, dtype=np.int64)
    shown = text.decode()
    if not any(map(str.isalpha, shown)):  # other numerals (one half, roman eight) are no letters
        return np.empty(0, dtype=np.int64)
    flat = shown.lower().encode().translate(_LETTERS).split()
    a = np.frombuffer(b" " + b" ".join(flat) + b" ", dtype=np.uint8).astype(np.uint32)
    space = a == 32
    parts = []
    h, inner = np.zeros(len(a), dtype=np.uint32), np.zeros(len(a), dtype=bool)
    for n in range(1, max(SIZES) + 1):
        if n > len(a):
            break
        h = h[: len(a) - n + 1] * np.uint32(257) + a[n - 1 :]
        if n > 2:  # a space may only stand at the ends
            inner = inner[: len(a) - n + 1] | space[n - 2 : len(a) - 1]
        if n in SIZES:
            mixed = (h + np.uint32(n)) * np.uint32(2654435761)
            mixed ^= mixed >> np.uint32(15)
            x = (mixed * np.uint32(2246822519)) >> np.uint32(32 - 13)
            parts.append(x[~inner[: len(x)] & ~space[: len(x)]] if n == 1 else x[~inner[: len(x)]] if n > 2 else x)
    return np.concatenate(parts).astype(np.int64)


def _sparse(text: bytes | None) -> tuple[bytes, bytes] | None:
    x = buckets_of(text)
    if not len(x):
        return None
    idx, n = np.unique(x, return_counts=True)
    return idx.astype("<u2").tobytes(), (n / len(x)).astype("<f4").tobytes()


def _dense(rows: list[tuple[bytes, bytes]]) -> np.ndarray:
    out = np.zeros((len(rows), BUCKETS), dtype=np.float32)
    for i, (idx, value) in enumerate(rows):
        out[i, np.frombuffer(idx, dtype="<u2")] = np.frombuffer(value, dtype="<f4")
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[bytes, bytes]], labels: np.ndarray, classes: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Logit table (buckets x classes) and biases: SGD with per-weight steps (squared gradients so far)."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (WIDTH, classes)).astype(np.float32), np.zeros(classes, dtype=np.float32)
    grown = [np.full(x.shape, 1e-8, dtype=np.float32) for x in (emb, out, bias)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            own = order[at : at + BATCH]
            x = _dense([rows[i] for i in own])
            hidden = x @ emb
            error = _softmax(hidden @ out + bias)
            error[np.arange(len(own)), labels[own]] -= 1
            error /= len(own)
            for w, g, step in zip((emb, out, bias), (x.T @ (error @ out.T), hidden.T @ error, error.sum(axis=0)), grown, strict=True):
                step += g * g
                w -= RATE * g / np.sqrt(step)
    return emb @ out, bias


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", calibrate: Column | None = None, per_language: int = PER_LANGUAGE) -> dict:
    """Model from labelled rows; ``calibrate`` marks those held back (default: a third by hash)."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[lang]: r["count"] for r in known.groupBy(lang).count().collect()}  # one row per language
    calibrate = F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(3)) == 0 if calibrate is None else calibrate
    scale = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(int((1 << 20) * min(1.0, per_language / n))))]) if counts else None
    got = []
    if counts:
        own = known.where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < scale[F.col(lang)]).select(lang, calibrate.alias("c"), text)

        def work():
            return lambda cols: [(a.decode(), bool(c), *s) for a, c, t in zip(*cols, strict=True) if (s := _sparse(t))]

        got = map_rows(own, "lang string, c boolean, idx binary, value binary", work).collect()
    got = sorted(got, key=lambda r: (r["lang"], bytes(r["idx"]), bytes(r["value"])))
    names = sorted({r["lang"] for r in got})
    at = {n: i for i, n in enumerate(names)}
    if not names:
        return {"names": [], "table": np.zeros((BUCKETS, 0), np.float32), "bias": np.zeros(0, np.float32), "heat": 1.0, "least": 0.0}
    pick = lambda held: [((bytes(r["idx"]), bytes(r["value"])), at[r["lang"]]) for r in got if r["c"] == held]
    fold, held = pick(False) or pick(True), pick(True) or pick(False)
    table, bias = train([x for x, _ in fold], np.array([y for _, y in fold]), len(names))
    z, y = _dense([x for x, _ in held]) @ table + bias, np.array([y for _, y in held])
    losses = {h: -np.log(_softmax(z / h)[np.arange(len(y)), y] + 1e-12).mean() for h in np.geomspace(0.05, 20, 49)}
    heat = min(losses, key=losses.get)
    p = _softmax(z / heat)
    order = np.argsort(-p.max(axis=1))
    right = np.cumsum((p.argmax(axis=1) == y)[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(right >= WANTED)
    least = float(p.max(axis=1)[order[good[-1]]]) if len(good) else 1.0
    return {"names": names, "table": table, "bias": bias, "heat": float(heat), "least": least}


def predict(docs: DataFrame, model: dict, text: str = "text", drop: tuple = ()) -> DataFrame:
    """``docs`` (without the columns in ``drop``) plus lang_pred, score and rejected (score under the fitted limit, or ``und``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats

    def work():
        m = shared.value
        names, table, bias = m["names"], m["table"] / m["heat"], m["bias"] / m["heat"]

        def rows(texts):
            out = []
            for t in texts:
                x = buckets_of(t)
                if not len(x) or not names:
                    out.append(("und", 0.0, True))
                    continue
                p = _softmax(((np.bincount(x, minlength=BUCKETS) / len(x)).astype(np.float32) @ table + bias)[None])[0]
                best = int(p.argmax())
                out.append((names[best], float(p[best]), bool(p[best] < m["least"])))
            return out

        return rows

    return append_columns(docs, [text], "lang_pred string, score double, rejected boolean", work, drop)
