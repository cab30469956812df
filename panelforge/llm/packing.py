"""Packing along a space-filling curve.

Each text is tokenised; its token counts, hashed into ``BUCKETS`` and scaled
to length 1, are projected by fixed random directions to ``DIMS`` coordinates;
their Hilbert index is the sort key, so documents of like content are
neighbours. The documents are laid end to end in the order of (key, doc_id)
and the line of tokens is cut every ``size`` tokens: all sequences are full
but the last one, and only documents that lie across a cut are split.

The order is a range sort of narrow rows with a distributed running total;
token ids (16 bits each where the vocabulary allows) are written once to the
checkpoint folder and shuffled once. No group is gathered anywhere.

The tokenizer drops white space and never merges across the pieces of its
pre-tokenizer, so ids are kept per piece in a bounded cache and only new
pieces are tokenised; texts with rarer characters, and other tokenizer files,
take the tokenizer's own path.

Edge cases: null and empty texts have the end id alone; repeated rows are
documents of their own; ties in the key are ordered by doc_id, then row; an
empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_rows, running_total

SIZE = 4096
END = 2
BUCKETS, DIMS, BITS = 256, 3, 16
CACHE = 400_000


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Texts of these characters need no normalisation but lower case and white space.
_PLAIN = re.compile(r"[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
_LETTER = "a-z\u00df-\u00f6\u00f8-\u00ff"
#: The vocabulary's split of lower-cased text (contractions, letters, single digits, the rest), for plain texts.
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\s{_LETTER}0-9]+")


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit values.

    A plain text is split into pieces as the tokenizer's pre-tokenizer does,
    and each new piece goes to the tokenizer's model; any other text goes
    through the whole tokenizer. The cache of pieces has two generations of
    at most ``CACHE`` each, so frequent ones stay.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = path.endswith("word_bpe_49k.json")
        self.bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _new(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            shown = piece if piece.isascii() else self.bytes_of.pre_tokenize_str(piece)[0][0]
            ids = [t.id for t in self.model.tokenize(shown)]
            found = struct.pack(f"<{len(ids)}I", *ids)
        self.known[piece] = found
        return found

    def text(self, raw: bytes | None) -> bytes:
        if not raw:
            return b""
        text = raw.decode()
        if not (self.plain and _PLAIN.fullmatch(text)) or "<|" in text:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if len(self.known) >= CACHE:
            self.older, self.known = self.known, {}
        known, new = self.known.get, self._new
        return b"".join([known(p) or new(p) for p in _PIECE.findall(text.lower())])


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (rows) in [0, 2**bits) per coordinate."""
    x = points.T.astype(np.int64).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the reflections and exchanges of each level, from the coarsest
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(high, x[0] ^ (q - 1), x[0] ^ swap)
            x[i] ^= swap if i else 0
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _directions() -> np.ndarray:
    return np.random.default_rng(11).standard_normal((BUCKETS, DIMS)) / np.sqrt(DIMS)


def curve_keys(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of token-id arrays."""
    vectors = np.zeros((len(ids), BUCKETS))
    for row, x in enumerate(ids):
        if len(x):
            vectors[row] = np.sqrt(np.bincount((x.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24), minlength=BUCKETS))
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    where = (vectors / np.where(norms > 0, norms, 1)) @ _directions()
    grid = np.clip((np.tanh(where) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert(grid, BITS)


def tokenized(docs: DataFrame, path: str, doc_id: str, text: str) -> DataFrame:
    """doc_id, n (with the end id), key, ids (binary, without the end id; 16 bits each if all fit)."""

    def work():
        words = WordIds(path)

        def rows(cols):
            ids = [np.frombuffer(b, dtype="<u4") for b in map(words.text, cols[1])]
            keys = curve_keys(ids)
            for d, x, k in zip(cols[0], ids, keys, strict=True):
                small = not len(x) or x.max() < 1 << 16
                yield d, len(x) + 1, int(k), bool(small), (x.astype("<u2") if small else x).tobytes()

        return rows

    id_type = docs.schema[doc_id].dataType.simpleString()
    return map_rows(docs.select(F.col(doc_id), F.col(text)), f"doc_id {id_type}, n bigint, key bigint, small boolean, ids binary", work)


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE, end: int = END, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded (its sequence's length with padding), ids."""
    held = cut(tokenized(docs, path or tokenizer_path(), doc_id, text)).withColumn("_r", F.monotonically_increasing_id())
    placed = running_total(held.select("_r", "doc_id", "n", "key"), [F.col("key"), F.col("doc_id"), F.col("_r")], "n", "at")
    total = placed.agg(F.sum("n")).first()[0] or 0
    joined = held.select("_r", "doc_id", "n", "small", "ids").join(placed.select("_r", "at"), "_r").drop("_r")
    id_type = joined.schema["doc_id"].dataType.simpleString()
    rest = total % size
    short = rest if rest and rest & (rest - 1) == 0 else size

    def work():
        def rows(cols):
            for d, n, small, ids, at in zip(*cols, strict=True):
                x = np.append(np.frombuffer(ids, dtype="<u2" if small else "<u4").astype("<u4"), np.uint32(end)).astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, size)
                    length = min(size - offset, n - start)
                    piece = x[start : start + length].tobytes()
                    yield d, start, length, zlib.crc32(piece), n, sequence, offset, short if sequence == total // size else size, piece
                    start += length

        return rows

    return map_rows(joined, f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, padded bigint, ids binary", work)
