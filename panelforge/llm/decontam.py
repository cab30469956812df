"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows.

Texts are normalised to words (A-Z lower-cased; every other ASCII character but digits
separates). The words of the benchmark are numbered, each number written as ``DIGITS`` digits from alphabets of their
own, and the automaton holds each window of ``window`` consecutive words of an item as these digits; few children
per node, whatever the vocabulary. A text is scanned once as its words' digits (other words have digits of none). For
texts with hits, word positions are mapped back to code points of the original.

The benchmark is the only thing broadcast, and its size is checked: items
beyond ``max_bytes`` (about 350 bytes of automaton for each) are split by hash into blocks, each with
an automaton and a scan of its own; hits of the blocks are united per text.

Edge cases: null, empty and word-less texts have no words and no hits;
repeated document rows each get their row; null or word-less items have no
window; items without an id mark words but are not listed; an empty benchmark
gives zero hits everywhere; very long texts are scanned whole; nothing depends on an order, so there are no ties. Columns
of the documents named as the new ones are replaced, all others pass.
"""

from __future__ import annotations

import re
import uuid
from itertools import repeat

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, cut, fresh

WINDOW = 10
#: A block of ``max_bytes`` has fewer words than BASE ** DIGITS.
BASE, DIGITS = 96, 3
_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_NORMAL = bytes(b if b in _KEEP else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BUILT: dict = {}


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


def _digits(n: int) -> str:
    """``DIGITS`` symbols of a word's number, each place with symbols of its own, so that no match is out of step."""
    return "".join([chr(1 + place * BASE + n // BASE**place % BASE) for place in range(DIGITS)])


def _automaton(block: tuple[str, list[tuple[str | None, str]]], window: int):
    """Symbols of the words and the automaton of one block of items; kept for the tasks of a worker by the block's name."""
    name, items = block
    if (name, window) not in _BUILT:
        symbols: dict[bytes, str] = {}
        owners: dict[str, set] = {}
        for item, text in items:
            line = [symbols.setdefault(w, _digits(len(symbols))) for w in words_of(text.encode())]
            for i in range(max(1, len(line) - window + 1) if line else 0):
                owners.setdefault("".join(line[i : i + window]), set()).add(item)
        a = ahocorasick.Automaton()
        for w, ids in owners.items():
            a.add_word(w, (len(w) // DIGITS, tuple(i for i in ids if i is not None)))
        if owners:
            a.make_automaton()
        _BUILT.clear()
        _BUILT[name, window] = symbols, a if owners else None
    return _BUILT[name, window]


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _scan(text: bytes | None, symbols: dict, automaton) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, hit word ranges (end exclusive) and items of a text."""
    words = words_of(text)
    if not words or automaton is None:
        return len(words), [], set()
    line = "".join(map(symbols.get, words, repeat("\0" * DIGITS)))
    found, items = [], set()
    for end, (size, ids) in automaton.iter(line):
        last = (end + 1) // DIGITS
        found.append((last - size, last))
        items.update(ids)
    return len(words), _united(found), items


def _offsets(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    places = [m.span() for m in _WORD.finditer(text.decode())]
    return [(places[a][0], places[b - 1][1]) for a, b in spans]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_bytes: int = 1 << 19, text: str = "text", item_id: str = "item_id", item_text: str = "text", with_spans: bool = True, drop: tuple = ()) -> DataFrame:
    """``docs`` (without the columns in ``drop``) plus n_words, n_hit, items (sorted strings), spans (code points, only ``with_spans``), contaminated."""
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).where("t is not null").distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // max_bytes))
    items = items.withColumn("b", F.pmod(F.xxhash64("t"), F.lit(blocks)))
    places = "array<struct<start:int,end:int>>"
    own_name = fresh(docs, "_s")
    out = docs.withColumns({own_name: F.expr(f"cast(array() as {places})"), "items": F.expr("cast(array() as array<string>)")})
    for block in range(blocks):
        own = sorted(((r["i"], r["t"]) for r in items.where(F.col("b") == block).collect()), key=lambda x: (x[0] or "", x[1]))
        shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, own))
        last = block == blocks - 1
        out = append_columns(out, [text, own_name, "items"], f"n_words bigint, {own_name} {places}, items array<string>, spans {places}", _work(shared, window, last and with_spans), drop if last else ())
        out = out if last else cut(out)
    hits = F.expr(f"aggregate({own_name}, 0L, (x, s) -> x + s.end - s.start)")
    out = out.withColumns({"n_hit": hits, "contaminated": F.size(own_name) > 0})
    return out.drop(own_name) if with_spans else out.drop(own_name, "spans")


def _work(shared, window: int, places: bool):
    def work():
        symbols, automaton = _automaton(shared.value, window)

        def one(t, before, items):
            n, found, ids = _scan(t, symbols, automaton)
            spans = _united(found + [(x["start"], x["end"]) for x in before])
            mapped = _offsets(t, spans) if places and spans else []
            return n, [{"start": a, "end": b} for a, b in spans], sorted(ids.union(items)), [{"start": a, "end": b} for a, b in mapped]

        return lambda texts, before, items: [one(*x) for x in zip(texts, before, items, strict=True)]

    return work
