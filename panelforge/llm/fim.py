"""Fill-in-the-middle transformation by secondary-sort assembly.

A document is cut into units (lines with their end, the last one perhaps
without) and, at two places drawn from a hash of its id, into prefix, middle
and suffix. The map side emits pieces: a header, the marks and the units of each part,
put together to chunks of at most ``CHUNK`` bytes (longer units are cut), keyed
by document and *output position*. One exchange by document, sorted by (document,
position) within its partitions (``repartition`` and ``sortWithinPartitions``:
the DataFrame form of ``repartitionAndSortWithinPartitions``), streams the
pieces of each document in the order of its output: an incremental SHA-256 runs
over them, and no output is ever put together in memory.

Restoration reads the same stream: a scanner finds the marks in the output's
bytes, wherever chunks are cut, and tells from the form and the marks which part
follows. The segments so found are sorted again within their partitions, by
(document, place in the original), with no second exchange, and streamed into a
second digest.

So memory is one Arrow batch of pieces for any number and length of documents;
a document is one key, and its pieces pass one task as a stream.

Row keys are numbers of the input rows, so the input must come in the same
order when it is read again (files, tables and checkpoints do).

Edge cases: null and empty texts, and texts that hold a mark, are plain: the output
is the text; repeated rows are transformed alike, each for itself; a null id
draws as the empty text; very long texts and lines are cut into chunks; an empty
table gives no rows; columns of the input other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

CHUNK = 1 << 16
#: Bytes of segments in one batch handed back to Spark.
BATCH = 4 << 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_MARK = re.compile(rb"<[PSM]>")
#: Place of the part after a mark in the original text.
_PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
HEADER, TRAILER = -1, 3


def draw(doc_id, seed: int) -> list[int]:
    """h1 to h4: the first four 8-digit groups of SHA-256 of "seed:id"."""
    shown = "" if doc_id is None else doc_id.decode() if isinstance(doc_id, bytes) else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{shown}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def unit_ends(text: bytes) -> np.ndarray:
    """Ends of the lines of a text, in bytes."""
    ends = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 10) + 1
    return ends if not len(text) or (len(ends) and ends[-1] == len(text)) else np.append(ends, len(text))


def plan(doc_id, text: bytes, seed: int, rate: int, spm: int) -> tuple[int, str, int, int]:
    """Number of units, form, and the ends of prefix and middle in bytes."""
    h1, h2, h3, h4 = draw(doc_id, seed)
    ends = unit_ends(text)
    n = len(ends)
    if not text or _MARK.search(text) or h3 % 100 >= rate:
        return n, "plain", 0, 0
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[c - 1]) if c else 0 for c in cuts)
    return n, "spm" if h4 % 100 < spm else "psm", a, b


def chunks(text: bytes, start: int, end: int, ends: np.ndarray, size: int) -> Iterator[bytes]:
    """Runs of whole units of at most ``size`` bytes; a longer unit is cut."""
    at = start
    while at < end:
        last = int(np.searchsorted(ends, at + size, side="right")) - 1
        to = int(ends[last]) if last >= 0 and ends[last] > at else at + size
        to = min(to, end)
        yield text[at:to]
        at = to


def pieces(docs: DataFrame, seed: int, rate: int, spm: int, doc_id: str, text: str, size: int) -> DataFrame:
    """k (row), pos (output position), the header's fields (null elsewhere) and piece."""

    def work():
        def rows(cols):
            for k, d, t in zip(*cols, strict=True):
                t = t or b""
                n, form, a, b = plan(d, t, seed, rate, spm)
                chars = (None, None) if form == "plain" else (len(t[:a].decode()), len(t[a:b].decode()))
                yield k, HEADER, d.decode() if isinstance(d, bytes) else d, n, form, *chars, None
                ends = unit_ends(t)
                prefix, middle, suffix = (0, a), (a, b), (b, len(t))
                parts = {"plain": [(b"", (0, len(t)))], "psm": [(PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle)], "spm": [(SUFFIX, suffix), (PREFIX, prefix), (MIDDLE, middle)]}[form]
                pos = 0
                for mark, (s, e) in parts:
                    for x in ([mark] if mark else []), chunks(t, s, e, ends, size):
                        for piece in x:
                            yield k, pos, None, None, None, None, None, piece
                            pos += 1

        return rows

    id_type = docs.schema[doc_id].dataType.simpleString()
    keyed = docs.select(F.monotonically_increasing_id().alias("k"), F.col(doc_id), F.col(text))
    return map_rows(keyed, f"k bigint, pos int, doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, piece binary", work)


class Scanner:
    """Finds the parts of an output in its bytes, fed in any cuts."""

    def __init__(self, plain: bool):
        self.plain, self.place, self.held = plain, 0, b""

    def feed(self, data: bytes, end: bool = False) -> Iterator[tuple[int, bytes]]:
        """(place in the original, bytes) of what is certain so far."""
        if self.plain:
            if data:
                yield 0, data
            return
        data = self.held + data
        at = 0
        for m in _MARK.finditer(data):
            if m.start() > at:
                yield self.place, data[at : m.start()]
            self.place, at = _PLACE[m.group()], m.end()
        # the last two bytes may begin a mark
        keep = 0 if end else next((i for i in (2, 1) if len(data) - at >= i and any(x.startswith(data[-i:]) for x in _PLACE)), 0)
        if len(data) - keep > at:
            yield self.place, data[at : len(data) - keep]
        self.held = data[len(data) - keep :] if keep else b""


_INFO = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``BATCH`` bytes of the last column and 8,192 rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if size >= BATCH or len(held) >= 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for at in range(0, b.num_rows, 256):
            yield from zip(*[c.to_pylist() for c in b.slice(at, 256).columns], strict=True)


def assembled(parts: DataFrame) -> DataFrame:
    """The output of each document as a stream: k, place, at, the header's fields, output_sha256 (on the trailer) and segment.

    ``place`` is where a segment of the output stands in the original, as told by form and marks.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    id_type = parts.schema["doc_id"].dataType.simpleString()
    out = StructType.fromDDL(f"k bigint, place int, at int, doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, segment binary")
    schema = to_arrow_schema(out)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        info = digest = scan = None
        key, at = None, 0

        def done():
            rest = [(key, place, at + i, *[None] * 6, x) for i, (place, x) in enumerate(scan.feed(b"", end=True))]
            return [*rest, (key, TRAILER, 0, *info, digest.hexdigest(), None)]

        for k, pos, *head, piece in _records(batches):
            if pos == HEADER:
                if key is not None:
                    yield from done()
                key, at, info, digest, scan = k, 0, head, hashlib.sha256(), Scanner(head[2] == "plain")
                continue
            digest.update(piece)
            for place, x in scan.feed(piece):
                yield k, place, at, *[None] * 6, x
                at += 1
        if key is not None:
            yield from done()

    dealt = parts.repartition("k").sortWithinPartitions("k", "pos")
    return dealt.mapInArrow(lambda batches: _batches(stream(batches), schema), out)


def restored(outputs: DataFrame) -> DataFrame:
    """One row per document with the digests of its output and of the text rebuilt from it."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    id_type = outputs.schema["doc_id"].dataType.simpleString()
    out = StructType.fromDDL(f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string")
    schema = to_arrow_schema(out)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        digest = hashlib.sha256()
        for _, place, _, *info, segment in _records(batches):
            if place == TRAILER:
                yield *info, digest.hexdigest()
                digest = hashlib.sha256()
            else:
                digest.update(segment)

    # still dealt by document: sorted again where it is
    return outputs.sortWithinPartitions("k", "place", "at").mapInArrow(lambda batches: _batches(stream(batches), schema), out)


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The outputs themselves, as pieces: k (row), pos, doc_id, n, form, prefix_chars, middle_chars (on the header, pos -1) and piece.

    Pieces of a row in the order of ``pos`` are its output. ``rate`` percent of the documents are transformed, ``spm`` percent of them with the suffix first.
    """
    return pieces(docs, seed, rate, spm, doc_id, text, chunk)


def texts(parts: DataFrame) -> DataFrame:
    """The outputs of ``transform`` as whole texts: doc_id, n, form, prefix_chars, middle_chars, output."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    id_type = parts.schema["doc_id"].dataType.simpleString()
    out = StructType.fromDDL(f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    schema = to_arrow_schema(out)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        info, held = None, []
        for _, pos, *head, piece in _records(batches):
            if pos == HEADER:
                if info is not None:
                    yield *info, b"".join(held).decode()
                info, held = head, []
            else:
                held.append(piece)
        if info is not None:
            yield *info, b"".join(held).decode()

    return parts.repartition("k").sortWithinPartitions("k", "pos").mapInArrow(lambda batches: _batches(stream(batches), schema), out)


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    return restored(assembled(transform(docs, **options)))
