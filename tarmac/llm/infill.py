"""Fill-in-middle examples by secondary sort.

A text is cut into units, a run of white space with the word after it (or the run at the
end). Digits of a seeded digest of the id pick two cuts and the form: ``plain`` leaves the
text, ``psm`` puts prefix, suffix and middle in this order and ``spm`` suffix, prefix and
middle, each behind its mark.

A document is not put together in one place. Its sections are emitted in pieces of up to
``UNITS`` units and ``CHARS`` characters, keyed by the document and the place in the output.
One shuffle by document, sorted by place within its partitions (``repartitionAndSort``
of the DataFrame: it spills, and a lost executor costs its tasks), brings the pieces of an output
one after the other, where they run through an incremental digest and are freed.
What comes out is told into sections again by its marks alone, sorted by the place in the
text within the same partitions, with no further shuffle, and runs through a second digest:
the restored text.

Defined results: a null text counts as empty; an empty one is plain and has no unit. A null
id counts as an empty string of digits. Repeated rows come out as often as they come in:
a key bears the partition a row was read in, so copies of one row, however many, are spread
by where they lay, and their pieces, equal and next to each other, are digested once. Rows
of one id and different texts are different documents. A text of any length is held whole
only by the task that reads its row (and by ``examples``, which returns it), and its pieces
are bounded by ``CHARS``. A text with one of the marks is plain, so marks never clash. Equal
cuts give empty sections, which keep their marks. An empty table gives none. Further columns
of whatever name are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED, PERCENT_CHANGED, PERCENT_SPM = 42, 50, 80
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}  # by the place of the section in the text
#: Bounds of a piece.
UNITS, CHARS = 1024, 8192
#: White space and every other byte of UTF-8; all white space is one byte.
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}


def unit_ends(text: bytes) -> list[int]:
    """Where the units of a text end."""
    ends = [m.end() for m in WORD.finditer(text)]
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return ends


def plan(text: bytes, n: int, doc_id: int | None, seed: int = SEED) -> tuple[str, int, int]:
    """The form, and the number of units before the middle and before the suffix."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= PERCENT_CHANGED:
        return "plain", 0, 0
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    return "spm" if h4 % 100 < PERCENT_SPM else "psm", *cuts


def characters(part: bytes) -> int:
    return len(part.decode("utf-8", "surrogatepass"))


def sections(text: bytes, doc_id: int | None, seed: int = SEED) -> tuple[str, int, list[tuple[bytes, int, int, int, int]]]:
    """The form, the number of units, and the sections in output order: mark, first and last byte, first and last unit."""
    ends = unit_ends(text)
    form, a, b = plan(text, len(ends), doc_id, seed)
    if form == "plain":
        return form, len(ends), [(b"", 0, len(text), 0, len(ends))]
    at = lambda units: ends[units - 1] if units else 0
    spans = {PREFIX: (0, at(a), 0, a), MIDDLE: (at(a), at(b), a, b), SUFFIX: (at(b), len(text), b, len(ends))}
    return form, len(ends), [(mark, *spans[mark]) for mark in ORDERS[form]]


def _cut(text: bytes, ends: list[int], first: int, last: int, low: int, high: int) -> Iterator[bytes]:
    """A section in pieces of bounded units and bytes; at least one, as the mark needs a piece."""
    begin = first
    for units in range(low + UNITS, high + UNITS, UNITS):
        end = ends[min(units, high) - 1] if high > low else last
        while begin < end:  # a unit may be of any length
            yield text[begin : min(end, begin + CHARS)]
            begin += CHARS
        begin = end
    if first == last:
        yield b""


PIECES_DDL = "doc_id bigint, key binary, place int, piece binary, form string, n bigint, prefix_chars bigint, middle_chars bigint"
PARTS_DDL = PIECES_DDL.replace("place int", "section int, place int") + ", output_sha256 string, copies int"
DIGESTS_DDL = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _batches(rows: Iterator[tuple], ddl: str) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded bytes."""
    names, types = zip(*((name, _ARROW[kind]) for name, kind in (column.split() for column in ddl.split(", "))))
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, bytes))
        if size > 4_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def pieces_of(doc_id: int | None, text: bytes, where: int, seed: int = SEED) -> Iterator[tuple]:
    """The pieces of one document by their places in the output."""
    form, n, parts = sections(text, doc_id, seed)
    key = xxhash.xxh128_digest(text, seed=where)
    ends = unit_ends(text) if len(text) > CHARS or n > UNITS else None
    of = {mark: characters(text[first:last]) for mark, first, last, _, _ in parts if mark}
    place = 0
    for mark, first, last, low, high in parts:
        for piece in [text[first:last]] if ends is None else _cut(text, ends, first, last, low, high):
            yield doc_id, key, place, mark + piece, form, n, of.get(PREFIX), of.get(MIDDLE)
            mark, place = b"", place + 1


def pieces(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """All pieces of the documents, in no order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(
            (piece for doc_id, text, where in _rows(batches) for piece in pieces_of(doc_id, text or b"", where, seed)),
            PIECES_DDL,
        )

    read = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
        F.spark_partition_id().alias("where"),
    )
    return read.mapInArrow(run, PIECES_DDL)


def assembled(cut: DataFrame) -> DataFrame:
    """The pieces in the order of each output, those of a document in one partition."""
    return cut.repartition("doc_id", "key").sortWithinPartitions("doc_id", "key", "place")


def _documents(rows: Iterator[tuple]) -> Iterator[Iterator[tuple]]:
    for _, document in groupby(rows, lambda row: row[:2]):
        yield document


def told(document: Iterator[tuple]) -> Iterator[tuple]:
    """The pieces of an output with their section, and at the end its digest and how many copies there are.

    The sections are told by the marks in the output and its form, by nothing else.
    """
    digest, section, copies, last = hashlib.sha256(), 0, 0, -1
    for doc_id, key, place, piece, form, *known in document:
        copies += place == 0
        if place == last:  # the same piece of a copy
            continue
        last = place
        digest.update(piece)
        if form != "plain" and piece[:3] in MARKS:
            section, piece = MARKS[piece[:3]], piece[3:]
        yield doc_id, key, section, place, piece, form, *known, None, None
    yield doc_id, key, len(MARKS), 0, b"", form, *known, digest.hexdigest(), copies


def restored(document: Iterator[tuple]) -> Iterator[tuple]:
    """The result of a document, from its pieces in the order of the text."""
    digest = hashlib.sha256()
    for row in document:
        digest.update(row[4])
    doc_id, _, _, _, _, form, n, prefix, middle, output, copies = row
    for _ in range(copies):
        yield doc_id, n, form, prefix, middle, output, digest.hexdigest()


def _each(step, ddl: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((row for document in _documents(_rows(batches)) for row in step(document)), ddl)

    return run


def digests(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output_sha256``, ``restored_sha256``."""
    parts = assembled(pieces(docs, seed)).mapInArrow(_each(told, PARTS_DDL), PARTS_DDL)
    # Documents lie in one partition each already.
    parts = parts.sortWithinPartitions("doc_id", "key", "section", "place")
    return parts.mapInArrow(_each(restored, DIGESTS_DDL), DIGESTS_DDL)


def joined(document: Iterator[tuple]) -> Iterator[tuple]:
    """The whole output of a document, once for each copy."""
    parts, copies, last = [], 0, -1
    for doc_id, _, place, piece, form, n, *_ in document:
        copies += place == 0
        if place != last:
            parts.append(piece)
        last = place
    output = b"".join(parts)
    for _ in range(copies):
        yield doc_id, n, form, output


def examples(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The training examples: ``doc_id``, ``n``, ``form`` and ``output`` as text.

    Here a task does hold one output at a time.
    """
    ddl = "doc_id bigint, n bigint, form string, output binary"
    found = assembled(pieces(docs, seed)).mapInArrow(_each(joined, ddl), ddl)
    return found.withColumn("output", F.col("output").cast("string"))
