"""Quality rules by weak supervision.

Each rule votes good (1), bad (0) or abstains (-1) on a text, from counts of
that text. The votes of all documents are grouped to patterns (at most
3 ** rules of them, usually a few hundred) with their counts; expectation
maximisation on the patterns estimates, for each rule and class, how often it
votes which way, and the share of good documents. A document is kept when its
posterior probability of being good is at least 0.5 and it meets the base
limits.

The counts are row-wise work; votes are written once to the checkpoint
folder, without texts, and the patterns are combined before the shuffle.

Edge cases: null, empty and word-less texts have zero counts, fail the base
limits and cast no vote on ratios; repeated rows each count; an empty table
gives no rows; a text of any length is read whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, cut

WINDOW = 8
#: A base failure: fewer words than MIN_WORDS, or more than MAX_REPEAT percent of the words in repeated windows.
MIN_WORDS, MAX_REPEAT = 20, 30
ROUNDS = 60
#: (name, feature, good if at most, bad if above): between the two a rule abstains.
RULES = (
    ("repetition", "repeat_share", 0.10, 0.30),
    ("symbols", "symbol_share", 0.02, 0.10),
    ("symbol_words", "symbol_per_word", 0.10, 0.30),
    ("duplicate_lines", "dup_line_share", 0.10, 0.40),
    ("capitals", "upper_share", 0.10, 0.40),
    ("exclamations", "exclaim_share", 0.02, 0.10),
    ("adjacent_repeats", "adjacent_share", 0.02, 0.10),
    ("word_variety", "same_share", 0.80, 0.95),
    ("short_text", "shortness", 1 / 40, 1 / 10),
    ("long_words", "mean_word", 9.0, 15.0),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"


def _ids(words: list[bytes]) -> tuple[np.ndarray, int]:
    """Numbers of the words by first appearance; how many there are."""
    seen: dict[bytes, int] = {}
    put = seen.setdefault
    return np.array([put(w, len(seen)) for w in words], dtype=np.uint64), len(seen)


def repeated_words(ids: np.ndarray, distinct: int, size: int = WINDOW) -> int:
    """Words that lie in a ``size``-word window found twice or more in the text."""
    n = len(ids) - size + 1
    if n < 2 or distinct == len(ids):
        return 0
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    h = mixed[:n].copy()
    for i in range(1, size):
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h += mixed[i : i + n]
    order = np.sort(h)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    found: dict[bytes, list[int]] = {}  # equal hashes are compared as ids
    for i in np.flatnonzero(np.isin(h, twice)).tolist():
        found.setdefault(ids[i : i + size].tobytes(), []).append(i)
    cover = np.zeros(len(ids) + 1, dtype=np.int64)
    for places in found.values():
        if len(places) > 1:
            np.add.at(cover, places, 1)
            np.add.at(cover, np.array(places) + size, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def counts_of(text: bytes | None) -> tuple:
    """The five base counts, then upper-case letters, letters, exclamation marks, adjacent equal words, distinct words, lines with a word."""
    if not text:
        return (0,) * 11
    words = text.split()
    n = len(words)
    raw = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    continuation = int(raw[0x80:0xC0].sum())
    word_chars = len(text) - continuation - int(sum(raw[b] for b in _SPACES))
    symbols = int(sum(raw[b] for b in _SYMBOLS))
    seen: set[bytes] = set()
    dup = lines = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    upper = int(raw[0x41:0x5B].sum())
    letters = upper + int(raw[0x61:0x7B].sum())
    ids, distinct = _ids(words)
    adjacent = int((ids[1:] == ids[:-1]).sum())
    return n, word_chars, symbols, dup, repeated_words(ids, distinct), upper, letters, int(raw[0x21]), adjacent, distinct, lines


def votes_of(c: tuple) -> list[int]:
    n, chars, symbols, dup, repeat, upper, letters, exclaim, adjacent, distinct, lines = c
    if not n:
        return [-1] * len(RULES)
    features = {
        "repeat_share": repeat / n,
        "symbol_share": symbols / max(1, chars),
        "symbol_per_word": symbols / n,
        "dup_line_share": dup / max(1, lines),
        "upper_share": upper / max(1, letters),
        "exclaim_share": exclaim / max(1, chars),
        "adjacent_share": adjacent / n,
        "same_share": 1 - distinct / n,
        "shortness": 1 / n,
        "mean_word": chars / n,
    }
    return [1 if features[f] <= good else 0 if features[f] > bad else -1 for _, f, good, bad in RULES]


def fit_label_model(patterns: np.ndarray, weights: np.ndarray, rounds: int = ROUNDS) -> dict:
    """EM over vote patterns (rows of -1, 0, 1): prior of good and p[rule, class, vote + 1].

    It starts from the belief that a bad vote speaks against a text more than
    a good vote speaks for it, and keeps a pseudo-count of that belief, so the
    classes cannot swap.
    """
    rules = patterns.shape[1]
    belief = np.array([[0.25, 0.2, 0.55], [0.18, 0.004, 0.816]])  # class bad, good x abstain, bad, good
    p = np.repeat(belief[None], rules, axis=0)
    prior = 0.8
    total = weights.sum()
    onehot = np.stack([(patterns == v - 1).astype(float) for v in range(3)], axis=2)
    for _ in range(rounds if total else 0):
        good = posterior(patterns, {"prior": prior, "p": p})
        for k, part in enumerate((1 - good, good)):
            mass = weights * part
            seen = np.einsum("n,nrv->rv", mass, onehot)
            strength = 0.01 * total
            p[:, k] = (seen + strength * belief[k]) / (mass.sum() + strength)
        prior = float(np.clip((weights * good).sum() / total, 0.05, 0.95))
    return {"prior": prior, "p": p}


def posterior(votes: np.ndarray, model: dict) -> np.ndarray:
    """Probability of good for rows of votes."""
    p = model["p"]
    rules = np.arange(p.shape[0])
    logs = [np.log(p[rules, k, votes + 1]).sum(axis=1) for k in (0, 1)]
    odds = np.log(model["prior"] / (1 - model["prior"])) + logs[1] - logs[0]
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def accuracies(model: dict) -> dict[str, float]:
    """Estimated chance that a rule's vote, when it gives one, is right."""
    pi = np.array([1 - model["prior"], model["prior"]])
    p = model["p"]
    right = pi[0] * p[:, 0, 1] + pi[1] * p[:, 1, 2]
    voted = (pi[:, None] * p[:, :, 1:].sum(axis=2).T).sum(axis=0)
    return dict(zip([r[0] for r in RULES], (right / voted).tolist(), strict=True))


def _count_work():
    def rows(texts):
        out = []
        for t in texts:
            c = counts_of(t)
            out.append((*c[:5], "".join("?01"[v + 1] for v in votes_of(c))))
        return out

    return rows


def apply_rules(docs: DataFrame, text: str = "text", drop: tuple = ("text",)) -> DataFrame:
    """``docs`` (without the columns in ``drop``) plus the five counts, votes, base_failed, quality (posterior) and kept."""
    counted = cut(append_columns(docs, [text], ", ".join(f"{c} bigint" for c in COUNTS) + ", votes string", _count_work, drop))
    seen = counted.groupBy("votes").count().collect()  # at most 3 ** len(RULES) rows, whatever the table's size
    patterns = np.array([["?01".index(v) - 1 for v in r["votes"]] for r in seen], dtype=int).reshape(-1, len(RULES))
    model = fit_label_model(patterns, np.array([r["count"] for r in seen], dtype=float))
    score = dict(zip([r["votes"] for r in seen], posterior(patterns, model).tolist(), strict=True)) if seen else {}

    def work():
        return lambda votes: [(score[v.decode()],) for v in votes]

    out = append_columns(counted, ["votes"], "quality double", work)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality") >= 0.5))
