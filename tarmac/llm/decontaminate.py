"""Benchmark passages in training documents: n-gram seeds, then Smith-Waterman alignment.

The test items are a stated query set. They are taken in blocks of at most
``BLOCK_ITEMS``, each sent to the executors, so what is broadcast has a bound and a
larger benchmark only takes more passes. One pass over whole documents finds those with
a 4-gram of an item and writes them down with the grams; how many documents hold each
gram is counted from that table. Of each ``GRAM`` grams of an item in a row, the rarest
among those that occur is a seed. The documents written down are joined to the items by the seeds
they hold, and by a commoner gram only where no seed of the item lies near, so any four
words left unchanged bring a copy to its item, however often it was copied; a copy
without four unchanged words in a row is not found. The item is aligned with the text
around each seed, if enough of its words are there: a match scores 2, another word or a
gap -1.

``score`` is the best alignment's share of an item's perfect score. Words are runs of
letters and digits in lower case.

Defined results: null or blank texts and items of fewer than four words match
nothing; of an empty benchmark or table nothing is found. Repeated rows are found as
often as they occur. Several places in one document count once, by the best and then
first of them. A text of any length is searched whole. Rows without an id are found with
a null id; ``decontaminate`` tells rows by id and text, so rows of one id are judged
each by its text. It returns further columns of whatever name as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import keep, quoted

GRAM = 4
BLOCK_ITEMS = 20_000
MATCH, MISS, GAP = 2, -1, -1

_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class Items:
    """A block of test items, ready to be looked up."""

    def __init__(self, rows: list[tuple[int, str]]):
        lists = [(i, words(t)) for i, t in rows]
        lists = [(i, w) for i, w in lists if len(w) >= GRAM]
        self.ids = [i for i, _ in lists]
        self.vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for _, ws in lists for w in ws))}
        self.words = [self.numbers(w) for _, w in lists]
        codes = [self.codes(w)[1] for w in self.words]
        self.grams = np.unique(np.concatenate(codes)) if codes else np.empty(0, np.uint64)
        self.places = [np.searchsorted(self.grams, c) for c in codes]
        self.seeds: dict[int, list[tuple[int, int, bool]]] = {}

    def numbers(self, ws: list[str]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))

    @staticmethod
    def codes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a run of known words begins, and its hash."""
        known = numbers >= 0
        n = len(numbers) - GRAM + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        all_known = np.logical_and.reduce([known[k : k + n] for k in range(GRAM)])
        at = np.flatnonzero(all_known)
        code = np.zeros(len(at), np.uint64)
        for k in range(GRAM):
            code = (code ^ numbers[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(31)
        return at, code

    def found(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of item 4-grams in a document, and which they are."""
        at, code = self.codes(numbers)
        if not len(at) or not len(self.grams):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        which = np.minimum(np.searchsorted(self.grams, code), len(self.grams) - 1)
        hit = self.grams[which] == code
        return at[hit], which[hit]

    def choose(self, counts: dict[int, int]) -> None:
        """Mark the rarest gram of each ``GRAM`` in a row as seeds, of those that some document holds."""
        for item, places in enumerate(self.places):
            held = [(counts.get(int(gram), 0), j) for j, gram in enumerate(places)]
            rare = set()
            for at in range(max(1, len(held) - GRAM + 1)):
                window = [h for h in held[at : at + GRAM] if h[0]]
                rare |= {min(window)[1]} if window else set()
            for j, gram in enumerate(places):
                if held[j][0]:
                    self.seeds.setdefault(int(gram), []).append((item, j, j in rare))


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The best local alignment's score and the place after its last word in the text."""
    j = np.arange(len(text) + 1)
    row, best, end = np.zeros(len(text) + 1, np.int64), 0, 0
    for word in item:
        new = np.maximum(row + GAP, 0)
        np.maximum(new[1:], row[:-1] + np.where(text == word, MATCH, MISS), out=new[1:])
        row = np.maximum.accumulate(new - GAP * j) + GAP * j
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def matches(items: Items, text: str | None, least: float) -> list[tuple[int, float, int, int]]:
    """Item, score, first and last word of the stretch searched, of each item found in a text."""
    numbers = items.numbers(words(text))
    stretches: dict[int, list[list[int]]] = {}
    common: list[tuple[int, int, list[int]]] = []
    for at, which in zip(*items.found(numbers)):
        for item, place, rare in items.seeds.get(int(which), ()):
            size = len(items.words[item])
            slack = int(MATCH * size * (1 - least) / -GAP)  # as many words inserted cost the score its share
            stretch = [max(0, int(at) - place - slack), min(len(numbers), int(at) - place + size + slack)]
            if rare:
                stretches.setdefault(item, []).append(stretch)
            else:
                common.append((item, int(at), stretch))
    for item, at, stretch in common:  # commoner grams, where the item has no stretch yet
        own = stretches.setdefault(item, [])
        if not any(lo <= stretch[0] and stretch[1] <= hi for lo, hi in own):
            own.append(stretch)
    out = []
    for item, own in stretches.items():
        size, parts = len(items.words[item]), []
        for lo, hi in sorted(own):
            if parts and lo <= parts[-1][1]:
                parts[-1][1] = max(parts[-1][1], hi)
            else:
                parts.append([lo, hi])
        # No alignment scores more than the item's words that the stretch holds at all.
        parts = [(lo, hi) for lo, hi in parts if np.isin(items.words[item], numbers[lo:hi]).sum() >= least * size]
        if not parts:
            continue
        scored = [(align(items.words[item], numbers[lo:hi]), lo) for lo, hi in parts]
        (score, end), lo = max(scored, key=lambda x: (x[0][0], -x[1]))
        if score >= least * MATCH * size:
            out.append((items.ids[item], score / (MATCH * size), max(lo, lo + end - size), lo + end))
    return out


def blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator[tuple[Items, DataFrame]]:
    """The items in blocks, and of each the documents (``doc_id``, ``text``) that hold a gram of it."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint"), "text").filter("text IS NOT NULL")
    n_blocks = -(-items.count() // BLOCK_ITEMS)
    for k in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k)
        own = Items(sorted(block.collect(), key=lambda r: (r[0] is None, r[0], r[1])))
        shared = spark.sparkContext.broadcast(own)

        def hold(batches, shared=shared):
            items = shared.value
            for batch in batches:
                texts = batch.column("text")
                grams = [np.unique(items.found(items.numbers(words(t.as_py())))[1]) for t in texts]
                some = pa.array([len(g) > 0 for g in grams], pa.bool_())
                held = pa.array([g for g in grams if len(g)], pa.list_(pa.int64()))
                columns = [batch.column("doc_id").filter(some), texts.filter(some), held]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "grams"])

        texts = docs.select(F.col("doc_id").cast("bigint"), "text")
        held = keep(texts.mapInArrow(hold, "doc_id bigint, text string, grams array<bigint>"))
        counted = held.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*"))
        own.choose(dict(map(tuple, counted.collect())))  # at most the grams of a block
        yield own, held


FOUND = "doc_id bigint, item_id bigint, score double, first_word bigint, end_word bigint"


def _found(docs: DataFrame, benchmark: DataFrame, least: float, schema: str, row) -> DataFrame:
    """Rows made of the matches of the documents that hold a gram, over all blocks of items."""
    kinds = {"bigint": pa.int64(), "double": pa.float64()}
    names, types = zip(*((name, kinds[kind]) for name, kind in (column.split() for column in schema.split(", "))))
    out = docs.sparkSession.createDataFrame([], schema)
    for items, held in blocks(docs, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def find(batches, shared=shared):
            for batch in batches:
                pairs = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), *(batch.column(c).to_pylist() for c in batch.schema.names[2:]))
                found = [row(i, m, *more) for i, t, *more in pairs for m in matches(shared.value, t, least)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate(types)], names)

        # The two hashes tell rows of one id apart.
        hashes = (F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
        out = out.unionByName(held.select("doc_id", "text", *hashes).mapInArrow(find, schema))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.5) -> DataFrame:
    """``doc_id``, ``item_id``, ``score``, ``first_word`` and ``end_word`` of each item found in a document."""
    return _found(docs, benchmark, least, FOUND, lambda doc_id, match, *_: (doc_id, *match))


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents without a benchmark passage, with their columns."""
    bad = _found(docs, benchmark, least, "id bigint, h1 bigint, h2 bigint", lambda doc_id, _, h1, h2: (doc_id, h1, h2))
    bad = keep(bad.distinct())
    row = F.struct(*(docs[quoted(c)] for c in docs.columns)).alias("row")
    hashes = (F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    df = docs.select(row, F.col("doc_id").cast("bigint").alias("id"), *hashes)
    same = df["id"].eqNullSafe(bad["id"]) & (df["h1"] == bad["h1"]) & (df["h2"] == bad["h2"])
    # How many go grows with the corpus, so the join is by shuffle at every size.
    return df.join(bad.hint("merge"), same, "left_anti").select("row.*")
