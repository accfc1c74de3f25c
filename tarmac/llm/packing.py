"""Packing of documents into sequences: shortest-pack-first over the histogram of lengths.

Documents are tokenised once and cut into pieces of ``SIZE`` ids and a rest. Only the
histogram of piece lengths, at most ``SIZE`` numbers, reaches the driver, which places
lengths longest first, each into the pack with the most room, and counts patterns
instead of packs. Pieces of one length are numbered by their rank, counted in buckets
of bounded size, and each rank range of a length belongs to one place of one pattern.

Defined results: a null text is empty, so its document is the end mark alone.
Repeated rows are packed one by one. Equal pieces of equal rows are interchangeable. A
text of any length is cut into as many pieces as it needs. An empty table gives none;
further columns of whatever name are not read.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import keep

SIZE = 1024
END = 0
#: Pieces to a bucket of ranks, about.
BUCKET = 100_000


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """A function from a text to ids of a vocabulary file of ``tokenizers``.

    Beside ``byte_bpe_50k.json`` lies the same vocabulary as ranks, for which the ids
    are taken from ``tiktoken``, five times as fast; texts with a special token's
    string go to ``tokenizers``.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    plain = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    ranks = vocabulary.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks):
        return plain
    import tiktoken
    from public_tokenizers import PATTERN

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return lambda text: plain(text) if any(s in text for s in special) else fast.encode_ordinary(text)


def pieces(docs: DataFrame, vocabulary: str, size: int = SIZE) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``ids_crc32`` and ``doc_tokens`` of each piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            out: list[tuple] = []
            for i, t in zip(batch.column(0), batch.column(1)):
                ids = np.array([*encode(t.as_py() or ""), END], "<u4")
                doc_id = i.as_py()
                for at in range(0, len(ids), size):
                    part = ids[at : at + size]
                    out.append((doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(5)], NAMES)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, ", ".join(f"{n} bigint" for n in NAMES))


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """How many packs there are of each pattern of lengths."""
    open_packs: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        added: list[tuple[int, tuple[int, ...]]] = []
        while left:
            room = max((r for r, packs in open_packs.items() if packs and r >= length), default=None)
            if room is None:
                fit = size // length  # nothing open has room: new packs, the last one with fewer
                whole, rest = divmod(left, fit)
                added += [(whole, (length,) * fit)] * bool(whole) + [(1, (length,) * rest)] * bool(rest)
                break
            n, pattern = open_packs[room].pop()
            used = min(n, left)
            if used < n:
                open_packs[room].append((n - used, pattern))
            open_packs.setdefault(room - length, []).append((used, (*pattern, length)))
            left -= used
        for n, pattern in added:
            open_packs.setdefault(size - sum(pattern), []).append((n, pattern))
    return [pack for room in sorted(open_packs) for pack in open_packs[room]]


def places(packs: list[tuple[int, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """For each length and first rank of a range: the first sequence of the range and the offset in it."""
    rows, used, sequence = [], {}, 0
    for n, pattern in packs:
        offset = 0
        for length in pattern:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + n
            offset += length
        sequence += n
    rows.sort()
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(("length", "rank", "sequence", "offset"))}


def pack(docs: DataFrame, vocabulary: str, size: int = SIZE) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    cut = keep(pieces(docs, vocabulary, size))
    counts = cut.groupBy("length").count().collect()  # at most `size` rows
    histogram = {r["length"]: r["count"] for r in counts}
    place = cut.sparkSession.sparkContext.broadcast(places(patterns(histogram, size)))
    n_buckets = max(1, sum(histogram.values()) // BUCKET)
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(n_buckets)))
    # A column tells the buckets of one length apart, so the common lengths spread.
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cut.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    firsts = keep(firsts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    own = Window.partitionBy("length", "bucket").orderBy(*(c for c in NAMES if c != "length"))
    ranked = cut.withColumn("rank", F.row_number().over(own) - 1).join(firsts, ["length", "bucket"])
    ranked = ranked.select(*NAMES, (F.col("first") + F.col("rank")).alias("rank"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = place.value
        key = p["length"] * 2**48 + p["rank"]
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 5))
            at = np.searchsorted(key, length * 2**48 + rank, "right") - 1
            sequence = p["sequence"][at] + rank - p["rank"][at]
            columns = [*batch.columns[:5], pa.array(sequence), pa.array(p["offset"][at])]
            yield pa.RecordBatch.from_arrays(columns, [*NAMES, "sequence_id", "offset"])

    return ranked.mapInArrow(join, ", ".join(f"{n} bigint" for n in [*NAMES, "sequence_id", "offset"]))
