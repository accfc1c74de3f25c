"""Removal of word sequences that occur more than once in the corpus.

A window is ``WINDOW`` consecutive words. All windows of a text are put into shards by
their least 10-gram hash, so equal windows meet in one shard, and runs of windows of
one shard travel as one stretch of text. Only stretches whose shard key occurs twice
or more travel. For each shard a compressed FM-index is built over its stretches
(``fmindex``), which are then streamed against it: backward search over the wavelet
matrix gives matching statistics, and ends with a match of ``WINDOW`` words that
occurs twice are reported.

Equal texts are one row with a count, and equal stretches of a shard are indexed once
with a count. A shard key with more than ``HOT`` windows, say of a line found in a
third of all documents, is not given to one task: its windows are counted by their
hashes, combined before the shuffle.

Defined results: a null, empty or short text has no windows and keeps its words.
Repeated rows are copies of each other, so all their windows are removed. An empty table
gives none; further columns of whatever name are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import byte_words, keep, keep_in_buckets
from tarmac.llm.fmindex import FMIndex

WINDOW, GRAM = 35, 10
HOT = 50_000
#: A shard's index is closed at the first key after so many words.
SHARD_WORDS = 60_000

_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words; forgets all when it grows beyond a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _grams(h: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = (out ^ h[k : k + len(out)]) * _STEP
        out ^= out >> np.uint64(29)
    return out


def stretches(words: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shard key, first window and number of windows of each run of windows of one shard, and whether its gram recurs."""
    if len(words) < WINDOW:
        return (*[np.empty(0, np.int64)] * 3, np.empty(0, bool))
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    grams = _grams(h, GRAM)
    least, span, wide = grams, 1, WINDOW - GRAM + 1
    while span * 2 <= wide:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    if span < wide:
        least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
    begin = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    key, n = least[begin], np.diff(np.append(begin, len(least)))
    again = np.zeros(len(key), bool)
    if len(np.unique(grams)) < len(grams):
        again[:] = [np.count_nonzero(grams[a : a + m + wide - 1] == k) > 1 for k, a, m in zip(key, begin, n)]
    return key.view(np.int64), begin, n, again


def _rows(columns: list[list], schema: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c) if len(c) and isinstance(c[0], np.ndarray) else c, t) for c, t in zip(columns, schema.values())],
        list(schema),
    )


def _shard_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    schema = {"key": pa.int64(), "text_id": pa.int64(), "first": pa.int32(), "windows": pa.int32(), "again": pa.bool_()}
    for batch in batches:
        columns: list[list] = [[] for _ in schema]
        for i, t in zip(batch.column(0), batch.column(1)):
            key, *runs = stretches(byte_words(t.as_py()), hashes)
            for column, part in zip(columns, (key, np.full(len(key), i.as_py(), np.int64), *runs)):
                column.append(part)
        yield _rows(columns, schema)


_CUT = {"key": pa.int64(), "text_id": pa.int64(), "first": pa.int32(), "windows": pa.int32(), "words": pa.binary(), "hash": pa.int64()}


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each stretch; those of hot keys as hashes of their windows."""
    hashes = WordHashes()
    for batch in batches:
        out: list[tuple] = []
        for i, t, runs in zip(batch.column(0), batch.column(1), batch.column(2)):
            words, text_id, grams = byte_words(t.as_py()), i.as_py(), None
            for run in runs.as_py():
                first, n = run["first"], run["windows"]
                if run["hot"]:
                    if grams is None:
                        h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                        grams = _grams(h, WINDOW).view(np.int64)
                    out += [(None, text_id, first + k, 1, None, int(grams[first + k])) for k in range(n)]
                else:
                    out.append((run["key"], text_id, first, n, b" ".join(words[first : first + n + WINDOW - 1]), None))
            if len(out) > 20_000:
                yield _rows([list(c) for c in zip(*out)], _CUT)
                out = []
        if out:
            yield _rows([list(c) for c in zip(*out)], _CUT)


def repeated_windows(shard: list[tuple[int, list[bytes]]]) -> list[list[int]]:
    """For each stretch of a shard, given how often it occurs and its words, the windows that occur elsewhere."""
    numbers: dict[bytes, int] = {}
    number = lambda w: numbers.setdefault(w, len(numbers) + 1)  # noqa: E731  0 parts the stretches
    text = np.fromiter((x for _, words in shard for x in (*map(number, words), 0)), np.int64)
    begin = np.cumsum([0, *(len(words) + 1 for _, words in shard)])
    once = [k for k, (n, _) in enumerate(shard) if n == 1]
    out: list[list[int]] = [list(range(len(words) - WINDOW + 1)) if n > 1 else [] for n, words in shard]
    if once:
        ends = np.concatenate([np.arange(begin[k] + WINDOW - 1, begin[k + 1] - 1) for k in once])
        owner = np.repeat(once, [len(shard[k][1]) - WINDOW + 1 for k in once])
        hit = FMIndex(text).matching_statistics(text, ends, WINDOW) >= WINDOW
        for k, end in zip(owner[hit], ends[hit]):
            out[k].append(int(end - begin[k]) - WINDOW + 1)
    return out


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of the stretches of a partition, which come in the order of their keys."""
    schema = {"text_id": pa.int64(), "first": pa.int32(), "windows": pa.int32()}

    def report(shard: dict[tuple[int, bytes], list[tuple[int, int]]]) -> pa.RecordBatch:
        places = list(shard.values())
        found = repeated_windows([(len(p), words.split(b" ")) for (_, words), p in zip(shard, places)])
        runs: list[tuple[int, int, int]] = []
        for windows, own in zip(found, places):
            if windows:
                w = np.array(windows)
                cut = np.flatnonzero(np.diff(w) > 1) + 1
                runs += [(t, f + int(r[0]), len(r)) for r in np.split(w, cut) for t, f in own]
        return _rows([list(c) for c in zip(*runs)] or [[], [], []], schema)

    shard: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
    last, size = None, 0
    for batch in batches:
        for key, text_id, first, words in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if key != last and size > SHARD_WORDS:
                yield report(shard)
                shard, size = {}, 0
            last = key
            own = shard.setdefault((key, words), [])
            if not own:
                size += words.count(b" ") + 1
            own.append((text_id, first))
    if shard:
        yield report(shard)


_REMOVED = {"text_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()}


def _remove(batches: Iterator[pa.RecordBatch], with_text: bool = False) -> Iterator[pa.RecordBatch]:
    schema = _REMOVED | ({"kept_text": pa.string()} if with_text else {})
    for batch in batches:
        out = []
        for i, t, copies, runs in zip(*(batch.column(k) for k in range(4))):
            words = byte_words(t.as_py())
            gone = np.zeros(len(words), bool)
            if copies.as_py() > 1 and len(words) >= WINDOW:
                gone[:] = True
            for run in runs.as_py() or ():
                gone[run["first"] : run["first"] + run["windows"] + WINDOW - 1] = True
            kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
            row = (i.as_py(), len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest())
            out.append((*row, kept.decode("utf-8", "surrogatepass")) if with_text else row)
        yield _rows([list(c) for c in zip(*out)] or [[]] * len(schema), schema)


def _with_text_id(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``text_id``, one number for each different text.

    The number is a 64-bit hash; texts that share it, if any, take another hash.
    """
    text = F.coalesce("text", F.lit(""))
    df = docs.select(F.col("doc_id").cast("bigint"), text.alias("text"))
    df = df.withColumns({"text_id": F.xxhash64("text"), "other": F.xxhash64(F.lit(1), "text")})
    shared = df.groupBy("text_id").agg(F.min("other").alias("a"), F.max("other").alias("b")).filter("a <> b")
    shared = keep(shared.select(F.col("text_id").alias("shared")))
    if not shared.isEmpty():
        df = df.join(shared, df["text_id"] == shared["shared"], "left")
        df = df.withColumn("text_id", F.when(F.col("shared").isNull(), F.col("text_id")).otherwise(F.col("other")))
    return df.select("doc_id", "text", "text_id")


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of every document, and ``kept_text`` if asked for."""
    rows = _with_text_id(docs)
    texts = rows.groupBy("text_id").agg(F.any_value("text").alias("text"), F.count("*").alias("copies"))
    texts = keep_in_buckets(texts, "text_id")
    runs = "key bigint, text_id bigint, first int, windows int"
    keys = keep(texts.select("text_id", "text").mapInArrow(_shard_keys, runs + ", again boolean"))
    often = keys.groupBy("key").agg(F.count("*").alias("n"), F.sum("windows").alias("windows"), F.bool_or("again").alias("again"))
    often = keep(often.filter("n > 1 OR again").select("key", (F.col("windows") > HOT).alias("hot")))
    shared = keys.join(often, "key").groupBy("text_id")
    shared = shared.agg(F.collect_list(F.struct("key", "first", "windows", "hot")).alias("runs"))
    cut = texts.join(shared, "text_id").select("text_id", "text", "runs")
    cut = keep(cut.mapInArrow(_cut, runs + ", words binary, hash bigint"))
    by_key = cut.filter("hash IS NULL").select("key", "text_id", "first", "words").repartition("key")
    found = by_key.sortWithinPartitions("key").mapInArrow(_search, "text_id bigint, first int, windows int")
    hot = cut.filter("hash IS NOT NULL").select("hash", "text_id", "first", "windows")
    twice = keep(hot.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"))
    found = found.unionByName(hot.join(twice, "hash").select("text_id", "first", "windows"))
    found = found.groupBy("text_id").agg(F.collect_list(F.struct("first", "windows")).alias("runs"))
    done = texts.join(found, "text_id", "left").select("text_id", "text", "copies", "runs")
    schema = "text_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * with_text
    done = done.mapInArrow(partial(_remove, with_text=with_text), schema)
    return rows.select("doc_id", "text_id").join(done, "text_id").drop("text_id")
