"""Codes of vectors by part codebooks, learned by Lloyd rounds over active entries.

Components become whole numbers (``floor(SCALE * x)``), vectors are cut into ``PARTS``
equal parts, and each part position has a codebook of up to ``ENTRIES`` entries that
starts as that part of the vectors of smallest id. A round assigns every part to its
nearest entry and moves each entry to the floored mean of its parts.

Assignments are kept with their exact squared distances. In a later round a part whose
entry stayed where it was compares that stored distance with the entries that moved, and
no others; a part whose entry moved scans the whole codebook. Both give the nearest entry,
the lower index on a tie: the unmoved entries are as far as they were, and of those the
stored one was nearest and of lowest index.

All sums are of whole numbers, so they do not depend on the order or number of tasks.
Tasks send one row of sums per part and entry used, never vectors; the driver holds the
codebooks alone. Each round's state (vectors, codes, distances) is written to the shared
folder, so a lost executor costs the tasks of one round.

Defined results: rows whose vector is null, empty, or holds a null or non-finite component
are dropped, and so are vectors whose length is not that of the vector of smallest id or
not a multiple of ``PARTS``. Components beyond ``LIMIT`` count as ``LIMIT`` (2 ** 24, an
``x`` of 65,536). A row without an id gets a code but starts no entry; of rows of one id
the least vector does. Fewer ids than ``ENTRIES`` make shorter codebooks; without any id
to start from, or of an empty table, the result is empty. Repeated rows get equal results.
Null labels are one label. Further columns of whatever name are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import keep, quoted

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE, LIMIT = 256, 2**24
#: Vectors compared at once.
ROWS = 2048
#: Labels that hold more than one in so many rows are few, so their sums are broadcast.
LABEL_SHARE = 1000

STATE = "vec_id bigint, label string, vector binary, codes binary, distances binary"


def whole(vectors: np.ndarray) -> np.ndarray:
    """Components as whole numbers."""
    return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -LIMIT, LIMIT).astype(np.int64)


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every part to every entry."""
    most = max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * parts.shape[1] * int(most) ** 2 < 2**53:  # whole numbers that floats hold exactly
        x, c = parts.astype(np.float64), entries.astype(np.float64)
        found = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
        return found.astype(np.int64)
    return np.stack([((parts - c) ** 2).sum(1) for c in entries], axis=1)


def scan(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, the lower on a tie, and its distance."""
    found = distances(parts, entries)
    nearest = found.argmin(1)
    return nearest, found[np.arange(len(parts)), nearest]


def update(
    parts: np.ndarray, entries: np.ndarray, moved: np.ndarray, codes: np.ndarray, stored: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entries after some have moved, from the codes and distances before."""
    codes, stored = codes.copy(), stored.copy()
    active = np.flatnonzero(moved)
    if not len(active):
        return codes, stored
    lost = moved[codes]
    rest = np.flatnonzero(~lost)
    if len(rest):
        found = distances(parts[rest], entries[active])
        at = found.argmin(1)
        nearest, near = active[at], found[np.arange(len(rest)), at]
        better = (near < stored[rest]) | ((near == stored[rest]) & (nearest < codes[rest]))
        codes[rest[better]], stored[rest[better]] = nearest[better], near[better]
    again = np.flatnonzero(lost)
    if len(again):
        codes[again], stored[again] = scan(parts[again], entries)
    return codes, stored


def centroids(entries: np.ndarray, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> np.ndarray:
    """The codebooks (part, entry, position) with every used entry at the floored mean of its parts."""
    out = entries.copy()
    for (part, entry), (count, total) in sums.items():
        out[part, entry] = [x // count for x in total]
    return out


def _vectors(rows: DataFrame, vector: str, label: str) -> DataFrame:
    """Usable rows, components as 64-bit floats."""
    numbers = F.col(quoted(vector)).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(quoted(label)).cast("string").alias("label"), numbers.alias("vector"))
    return rows.filter((F.size("vector") > 0) & ~F.exists("vector", bad))


def _seeds(vectors: DataFrame) -> np.ndarray:
    """The starting codebooks; of no entry if there is no id."""
    first = vectors.filter("vec_id IS NOT NULL").withColumn("width", F.size("vector"))
    smallest = lambda df: df.select("vec_id", "width").distinct().orderBy("vec_id", "width").limit(ENTRIES).collect()
    ids = smallest(first)
    width = ids[0]["width"] if ids else 0
    if not ids or width % PARTS:
        return np.zeros((PARTS, 0, 0), np.int64)
    if any(r["width"] != width for r in ids):
        ids = smallest(first.filter(F.col("width") == width))
    # All rows of so few ids, one vector of each: the maps' minima are what is shuffled.
    chosen = first.filter((F.col("width") == width) & F.col("vec_id").isin([r["vec_id"] for r in ids]))
    chosen = chosen.groupBy("vec_id").agg(F.min("vector").alias("vector")).collect()
    start = whole(np.array([r["vector"] for r in sorted(chosen, key=lambda r: r["vec_id"])]))
    return start.reshape(len(chosen), PARTS, -1).transpose(1, 0, 2).copy()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _integers(column: pa.Array, kind, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, -1)


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _state(batch: pa.RecordBatch, vectors: pa.Array, codes: np.ndarray, stored: np.ndarray) -> pa.RecordBatch:
    columns = [batch.column("vec_id"), batch.column("label"), vectors, _bytes(codes.astype(np.uint8)), _bytes(stored)]
    return pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector", "codes", "distances"])


def _first(entries: np.ndarray):
    """Whole numbers, and the first assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            n = batch.num_rows
            x = whole(np.array(batch.column("vector").flatten()).reshape(n, -1))
            parts = x.reshape(n, PARTS, -1)
            found = [scan(parts[:, p], entries[p]) for p in range(PARTS)]
            codes, stored = (np.stack(c, axis=1) for c in zip(*found))
            yield _state(batch, _bytes(x.astype(np.int32)), codes, stored)

    return run


def _next(before: np.ndarray, entries: np.ndarray):
    """The assignment after entries have moved."""
    moved = (before != entries).any(axis=2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            n = batch.num_rows
            parts = _integers(batch.column("vector"), np.int32, n).astype(np.int64).reshape(n, PARTS, -1)
            codes = _integers(batch.column("codes"), np.uint8, n).astype(np.int64)
            stored = _integers(batch.column("distances"), np.int64, n)
            found = [update(parts[:, p], entries[p], moved[p], codes[:, p], stored[:, p]) for p in range(PARTS)]
            codes, stored = (np.stack(c, axis=1) for c in zip(*found))
            yield _state(batch, batch.column("vector"), codes, stored)

    return run


def _sums(entries: np.ndarray):
    """Counts and sums of the parts of each entry, once for a task."""
    shape = entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(shape[:2], np.int64), np.zeros(shape, np.int64)
        for batch in _blocks(batches):
            n = batch.num_rows
            parts = _integers(batch.column("vector"), np.int32, n).reshape(n, PARTS, -1)
            codes = _integers(batch.column("codes"), np.uint8, n)
            for p in range(PARTS):
                np.add.at(sums[p], codes[:, p], parts[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=shape[1])
        part, entry = np.nonzero(counts)
        columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry])]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

    return run


def _moved(state: DataFrame, entries: np.ndarray) -> np.ndarray:
    """The entries after a round, from sums that Spark adds up."""
    sums = state.select("vector", "codes").mapInArrow(_sums(entries), "part int, entry int, n bigint, total array<bigint>")
    width = entries.shape[2]
    # Decimals hold the sum of any number of rows.
    total = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(width)]
    rows = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect()
    return centroids(entries, {(r["part"], r["entry"]): (r["n"], [int(r[f"t{i}"]) for i in range(width)]) for r in rows})


def learn(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The final state of the usable rows, and the codebooks."""
    entries = _seeds(vectors)
    of_width = vectors.filter(F.size("vector") == PARTS * entries.shape[2])
    if not entries.shape[1]:
        return vectors.sparkSession.createDataFrame([], STATE), entries
    state = keep(of_width.mapInArrow(_first(entries), STATE))
    for _ in range(rounds):
        before, entries = entries, _moved(state, entries)
        state = keep(state.mapInArrow(_next(before, entries), STATE))
    return state, entries


def _digest(entries: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, entries.ravel().tolist())).encode()).hexdigest()


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = [c.hex() for c in batch.column("codes").to_pylist()]
        errors = _integers(batch.column("distances"), np.int64, batch.num_rows).sum(axis=1)
        columns = [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])


def compress(rows: DataFrame, vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable row.

    ``code`` has two hexadecimal digits a part; ``error`` is the row's squared distance to
    its entries, ``label_error`` that of all rows of its label (at most the largest long).
    """
    state, entries = learn(_vectors(rows, vector, label), rounds)
    found = state.mapInArrow(_results, "vec_id bigint, label string, code string, error bigint")
    found = found.withColumn("name", F.coalesce(F.concat(F.lit("="), "label"), F.lit("")))
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    label_error = F.least(F.sum(F.col("error").cast("decimal(28,0)")), most).cast("bigint")
    sums = keep(found.groupBy("name").agg(label_error.alias("label_error"), F.count("*").alias("rows")))
    total = sums.agg(F.sum("rows")).first()[0] or 0
    often = F.col("rows") * LABEL_SHARE > total
    # Fewer than LABEL_SHARE labels can be this frequent; any other is a small part of the rows.
    few, many = sums.filter(often), sums.filter(~often)
    found = found.join(F.broadcast(few.select("name", F.col("label_error").alias("few_error"))), "name", "left")
    settled = found.filter("few_error IS NOT NULL").withColumn("label_error", F.col("few_error"))
    rest = found.filter("few_error IS NULL").join(many.select("name", "label_error"), "name")
    columns = ("vec_id", "code", "error", "label_error")
    return settled.select(*columns).unionByName(rest.select(*columns)).withColumn("codebooks_sha256", F.lit(_digest(entries)))
