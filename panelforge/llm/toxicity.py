"""Toxicity by a linear-chain conditional random field.

Words are tagged clean or toxic. Each word's emission is a sum of hashed
weights: the word, its prefixes and suffix, and the words beside it. Label
pairs have weights of their own. Forward-backward gives each word's marginal;
a logistic function of a text's marginals (their maximum and their sum) is the
document's score, and runs of words at 0.5 or more are the offending spans, in
code points of the text.

Token labels come from the labelled documents: a word or prefix that is
significantly tied to toxic documents (a binomial bound on its document
counts) marks words of toxic documents as toxic; every other word is clean.
The CRF is trained by gradient ascent in numpy on at most ``per_class``
labelled documents of each class (a documented bound; whole texts).

Scoring is row-wise. Forward-backward runs over all texts of a slice at once:
texts are cut into segments of ``SEGMENT`` words whose 2 x 2 transfer matrices
are multiplied side by side, then chained, so a long text costs no Python step
per word.

Edge cases: null, empty and word-less texts have no spans and the score of a
text without toxic words; without labels of both classes every score is the
share of toxic labels (0 if there are none); repeated rows score alike; labels
repeated for a document count as toxic if one of them is; an empty table
gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, bounded

FEATURES, SEGMENT = 1 << 17, 32
PER_CLASS = 1200
EPOCHS, BATCH, RATE, DECAY = 10, 64, 0.3, 1e-4
#: A feature is a seed if it is in SEED_DOCS toxic documents at least, PURE of its documents are toxic, and chance would do that with probability exp(-BOUND).
SEED_DOCS, PURE, BOUND = 4, 0.9, 14.0
CACHE = 300_000
_LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.decode().lower().encode().translate(_LETTERS).split() if text else []


def own_features(word: bytes) -> list[int]:
    """The word, its prefixes of 3 to 6 bytes and its last 3 bytes, hashed."""
    parts = [b"w" + word, b"s" + word[-3:], *[b"p%d" % n + word[:n] for n in (3, 4, 5, 6) if len(word) > n]]
    return [zlib.crc32(p) % FEATURES for p in parts]


def word_features(word: bytes) -> tuple[list[int], int, int]:
    return own_features(word), zlib.crc32(b"l" + word) % FEATURES, zlib.crc32(b"r" + word) % FEATURES


def marginals(emission: np.ndarray, lengths: np.ndarray, start: float, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each word and the expected label pairs (2 x 2 sums).

    ``emission``: log weight of toxic against clean, of all texts end to end;
    ``lengths``: words per text (all over 0); ``start``: log weight of
    starting toxic; ``pairs``: log weights of label pairs.
    """
    total = len(emission)
    if not total:
        return np.empty(0), np.zeros((2, 2))
    a = np.exp(pairs)
    segments = -(-lengths // SEGMENT)
    first = np.concatenate([[0], np.cumsum(segments)[:-1]])
    count = int(segments.sum())
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    text_of = np.repeat(np.arange(len(lengths)), segments)
    nth = np.arange(count) - first[text_of]
    at = begins[text_of][:, None] + nth[:, None] * SEGMENT + np.arange(SEGMENT)[None]
    real = at < (begins + lengths)[text_of][:, None]
    weight = np.ones((count, SEGMENT))
    weight[real] = np.exp(np.clip(emission[at[real]], -30, 30))
    opening = nth == 0
    # transfer matrix of each segment; the first word of a text has no pair before it
    m = np.zeros((2, 2, count))
    m[0, 0] = m[1, 1] = 1
    for t in range(SEGMENT):
        live = real[:, t]
        for r in range(2):
            x, y = m[r, 0], m[r, 1]
            nx, ny = x * a[0, 0] + y * a[1, 0], x * a[0, 1] + y * a[1, 1]
            if t == 0:
                nx, ny = np.where(opening, x, nx), np.where(opening, y, ny)
            m[r, 0], m[r, 1] = np.where(live, nx, x), np.where(live, ny * weight[:, t], y)
        if t % 4 == 3:
            m /= np.maximum(m.max(axis=(0, 1)), 1e-300)
    m /= np.maximum(m.max(axis=(0, 1)), 1e-300)
    # chain the segments of each text, all texts side by side
    fore, back = np.ones((2, count)), np.ones((2, count))
    fore[1, opening] = np.exp(start)
    order = np.argsort(-segments, kind="stable")
    sizes = segments[order]
    for k in range(1, int(sizes[0])):
        s = first[order[: np.searchsorted(-sizes, -k, side="left")]] + k
        x = fore[0, s - 1] * m[:, :, s - 1][0] + fore[1, s - 1] * m[:, :, s - 1][1]
        fore[:, s] = x / x.sum(axis=0)
    for k in range(int(sizes[0]) - 1, 0, -1):
        s = first[order[: np.searchsorted(-sizes, -k, side="left")]] + k
        x = m[:, 0, s] * back[0, s] + m[:, 1, s] * back[1, s]
        back[:, s - 1] = x / x.sum(axis=0)
    # within the segments
    alpha, beta = np.empty((SEGMENT, 2, count)), np.empty((SEGMENT, 2, count))
    x, y = fore
    for t in range(SEGMENT):
        nx, ny = x * a[0, 0] + y * a[1, 0], x * a[0, 1] + y * a[1, 1]
        if t == 0:
            nx, ny = np.where(opening, x, nx), np.where(opening, y, ny)
        ny = ny * weight[:, t]
        s = nx + ny
        x, y = np.where(real[:, t], nx / s, x), np.where(real[:, t], ny / s, y)
        alpha[t, 0], alpha[t, 1] = x, y
    x, y = back
    for t in range(SEGMENT - 1, -1, -1):
        beta[t, 0], beta[t, 1] = x, y
        z = y * weight[:, t]
        nx, ny = a[0, 0] * x + a[0, 1] * z, a[1, 0] * x + a[1, 1] * z
        s = nx + ny
        x, y = np.where(real[:, t], nx / s, x), np.where(real[:, t], ny / s, y)
    both = alpha * beta
    p = (both[:, 1] / both.sum(axis=1)).T
    out = np.empty(total)
    out[at[real]] = p[real]
    # pairs: the label before (its forward weight) with this label
    before = np.concatenate([fore[None], alpha[:-1]])
    joint = before[:, :, None] * a[None, :, :, None] * (np.stack([np.ones_like(weight.T), weight.T], axis=1) * beta)[:, None]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    valid = real.T.copy()
    valid[0] &= ~opening
    return out, (joint * valid[:, None, None, :]).sum(axis=(0, 3))


def seeds_of(docs: Iterable[np.ndarray], toxic: list[int]) -> np.ndarray:
    """Features tied to toxic documents; ``docs`` gives each document's distinct features."""
    hits, seen = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    for features, y in zip(docs, toxic, strict=True):
        seen[features] += 1
        hits[features] += y
    seen[FEATURES] = hits[FEATURES] = 0  # the filler of shorter words
    rate = min(max(sum(toxic) / max(1, len(toxic)), 1e-9), 1 - 1e-9)
    share = hits / np.maximum(seen, 1)
    rest = np.maximum(1 - share, 1e-12)
    split = share * np.log(np.maximum(share, 1e-12) / rate) + rest * np.log(rest / (1 - rate))
    return np.flatnonzero((hits >= SEED_DOCS) & (share >= PURE) & (seen * split >= BOUND))


class _Corpus:
    """Texts as word numbers, with the feature matrix of their distinct words."""

    def __init__(self, texts: list[list[bytes]]):
        flat = pa.array([w for t in texts for w in t], type=pa.binary()).dictionary_encode()
        self.ids = np.asarray(flat.indices, dtype=np.int64)
        self.words = flat.dictionary.to_pylist()
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        own = [word_features(w) for w in self.words]
        self.own = np.full((len(own), 6), FEATURES, dtype=np.int64)
        for i, (f, _, _) in enumerate(own):
            self.own[i, : len(f)] = f
        self.left = np.array([x[1] for x in own], dtype=np.int64)
        self.right = np.array([x[2] for x in own], dtype=np.int64)


def _emissions(ids: np.ndarray, lengths: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Emission of each word: its own, and what its neighbours in the text add (``left``: of the word before)."""
    e = own[ids]
    ends = np.cumsum(lengths)
    inner = np.ones(len(ids), dtype=bool)
    inner[ends[:-1][ends[:-1] < len(ids)]] = False  # first words of texts
    inner[:1] = False
    e[1:] += np.where(inner[1:], left[ids[:-1]], 0)
    e[:-1] += np.where(inner[1:], right[ids[1:]], 0)
    return e


def _signature(words: list[bytes]) -> int:
    """Least hash of three words in a row: alike for near copies."""
    return min((zlib.crc32(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0)


def train_crf(texts: list[list[bytes]], toxic: list[int], seed: int = 3) -> dict:
    corpus = _Corpus(texts)
    at = np.concatenate([[0], np.cumsum(corpus.lengths)])
    seeds = seeds_of((np.unique(corpus.own[np.unique(corpus.ids[a:b])]) for a, b in zip(at, at[1:], strict=False)), toxic)
    marked = np.isin(corpus.own, seeds).any(axis=1)
    y = marked[corpus.ids] & np.repeat(np.array(toxic, dtype=bool), corpus.lengths)
    w = np.zeros(FEATURES + 1)
    rest = np.array([0.0, 0, 0, 0, 0])  # start, then pairs 00 01 10 11
    rest[0] = -3
    grown, grown_rest = np.full(FEATURES + 1, 1e-6), np.full(5, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(np.flatnonzero(corpus.lengths))
        for i in range(0, len(order), BATCH):
            own = order[i : i + BATCH]
            ids = np.concatenate([corpus.ids[at[d] : at[d + 1]] for d in own])
            label = np.concatenate([y[at[d] : at[d + 1]] for d in own])
            lengths = corpus.lengths[own]
            v, ids = np.unique(ids, return_inverse=True)
            f, left, right = corpus.own[v], corpus.left[v], corpus.right[v]
            e = _emissions(ids, lengths, w[f].sum(axis=1), w[left], w[right])
            p, expected = marginals(e, lengths, rest[0], rest[1:].reshape(2, 2))
            error = label - p
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            g = np.zeros(FEATURES + 1)
            by = np.bincount(ids, weights=error, minlength=len(v))
            np.add.at(g, f.ravel(), np.repeat(by, f.shape[1]))
            inner = np.ones(len(ids), dtype=bool)
            inner[starts] = False
            np.add.at(g, left, np.bincount(ids[:-1], weights=error[1:] * inner[1:], minlength=len(v)))
            np.add.at(g, right, np.bincount(ids[1:], weights=error[:-1] * inner[1:], minlength=len(v)))
            g = g / len(own) - DECAY * w
            g[FEATURES] = 0
            grown += g * g
            w += RATE * g / np.sqrt(grown)
            seen = np.zeros((2, 2))
            np.add.at(seen, (label[:-1][inner[1:]].astype(int), label[1:][inner[1:]].astype(int)), 1)
            g = np.concatenate([[error[starts].sum()], (seen - expected).ravel()]) / len(own) - DECAY * rest
            grown_rest += g * g
            rest += RATE * g / np.sqrt(grown_rest)
    return {"w": w, "start": float(rest[0]), "pairs": rest[1:].reshape(2, 2).copy()}


class Tagger:
    """Marginals of texts under a trained CRF; emissions are kept by word in a bounded cache."""

    def __init__(self, crf: dict):
        self.crf, self.known = crf, {}

    def _word(self, word: bytes) -> tuple[float, float, float]:
        f, left, right = word_features(word)
        w = self.crf["w"]
        self.known[word] = x = (float(w[f].sum()), float(w[left]), float(w[right]))
        return x

    def marginals(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        out: list = [np.empty(0)] * len(texts)
        if not lengths.sum():
            return out
        if len(self.known) > CACHE:
            self.known.clear()
        flat = pa.array([w for t in texts for w in t], type=pa.binary()).dictionary_encode()
        known = self.known.get
        table = np.array([known(w) or self._word(w) for w in flat.dictionary.to_pylist()])
        full = np.flatnonzero(lengths)
        e = _emissions(np.asarray(flat.indices, dtype=np.int64), lengths[full], table[:, 0], table[:, 1], table[:, 2])
        p, _ = marginals(e, lengths[full], self.crf["start"], self.crf["pairs"])
        for d, x in zip(full, np.split(p, np.cumsum(lengths[full])[:-1]), strict=True):
            out[d] = x
        return out


def _summary(p: np.ndarray) -> tuple[float, float]:
    return (float(p.max()), float(np.log1p(p.sum()))) if len(p) else (0.0, 0.0)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + decay * len(y) * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (weight * (y - p)) - decay * len(y) * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic", per_class: int = PER_CLASS) -> dict:
    """Model from the documents that have a label; callers pass the training rows of ``labels`` only."""
    marks = labels.where(F.col(key).isNotNull() & F.col(toxic).isNotNull()).groupBy(key).agg((F.max(toxic) > 0).cast("int").alias("_y"))
    counts = {r["_y"]: r["count"] for r in marks.groupBy("_y").count().collect()}
    if len(counts) < 2:
        return {"crf": None, "share": float(counts.get(1, 0) > 0)}
    own = bounded(marks.where("_y = 0"), key, 2 * per_class, counts[0]).unionByName(bounded(marks.where("_y = 1"), key, per_class, counts[1]))
    # the sample has a bounded number of rows, so it is the side to broadcast: texts do not move
    rows = docs.select(F.col(key), F.col(text)).join(F.broadcast(own), key).where(F.col(text).isNotNull()).collect()
    rows = sorted(rows, key=lambda r: (r[key], r[text]))
    toxic_of = [r["_y"] for r in rows]
    if len(set(toxic_of)) < 2:
        return {"crf": None, "share": counts[1] / (counts[0] + counts[1])}
    texts = [words_of(r[text].encode()) for r in rows]
    # of near copies one is learnt from: else the rare words they share look tied to their label
    first = {(_signature(t), y): i for i, (t, y) in reversed(list(enumerate(zip(texts, toxic_of, strict=True))))}
    texts, toxic_of = [texts[i] for i in sorted(first.values())], [toxic_of[i] for i in sorted(first.values())]
    crf = train_crf(texts, toxic_of)
    tagger = Tagger(crf)
    x = np.array([_summary(p) for at in range(0, len(texts), 128) for p in tagger.marginals(texts[at : at + 128])])
    y = np.array(toxic_of, dtype=float)
    weight = np.where(y > 0, counts[1] / y.sum(), counts[0] / (1 - y).sum())
    crf["w"] = crf["w"].astype(np.float32)
    return {"crf": crf, "doc": _logistic(x, y, weight / weight.mean())}


def tag(docs: DataFrame, model: dict, text: str = "text", drop: tuple = ()) -> DataFrame:
    """``docs`` (without the columns in ``drop``) plus score, predicted and spans (start, end of toxic runs, in code points)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES floats

    def work():
        m = shared.value
        tagger = Tagger(m["crf"]) if m["crf"] else None

        def rows(texts):
            if tagger is None:
                return [(m["share"], int(m["share"] >= 0.5), []) for _ in texts]
            out = []
            for t, p in zip(texts, tagger.marginals([words_of(t) for t in texts]), strict=True):
                score = float(1 / (1 + np.exp(-np.clip(m["doc"][0] + m["doc"][1:] @ _summary(p), -30, 30))))
                out.append((score, int(score >= 0.5), _runs(t, p)))
            return out

        return rows

    return append_columns(docs, [text], "score double, predicted int, spans array<struct<start:int,end:int>>", work, drop)


def _runs(text: bytes | None, p: np.ndarray) -> list[dict]:
    hot = np.flatnonzero(p >= 0.5)
    if not len(hot):
        return []
    places = [m.span() for m in _WORD.finditer(text.decode())]
    runs = np.split(hot, np.flatnonzero(np.diff(hot) > 1) + 1)
    return [{"start": places[r[0]][0], "end": places[r[-1]][1]} for r in runs]
