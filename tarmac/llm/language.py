"""Language of documents and of spans within them.

Every language is a table of character trigram log-probabilities, learnt from a
bounded sample of labelled documents, and a set of scripts. The script of a word
narrows the languages it can belong to; a word's score for a language is the sum over
its trigrams. Viterbi search with a penalty for each switch labels the words, for many
documents at a time. The document's language is the one with the most letters in its
spans, and ``score`` is its share of the letters.

Defined results: a null text, or one without letters, is ``und`` with score 0; marks and
digits are no letters. Equal shares go to the first name. Without a labelled document
every text is ``und``. Repeated rows get equal results. A text of any length is read
whole. An empty table gives none; further columns of whatever name are not read. There is
one table of scores for each language (``BINS`` of them) on every executor, so there
are to be at most ``MOST_LANGUAGES`` labels; more are refused.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: So many documents of a language teach it, about, chosen by a hash of their id.
SAMPLE = 5_000
BINS = 1 << 16
#: Nats that a switch of language costs.
SWITCH = 18.0
#: Labels at most: what is collected and sent to the executors has a row for each and trigram.
MOST_LANGUAGES = 256
#: A language has a script if it makes up this share of its letters.
SCRIPT_SHARE = 0.01
#: Scores held at a time: words times languages.
HELD = 8_000_000

# First code points of Unicode ranges and the script of each, by name.
_RANGES = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Odia"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1780, "Khmer"), (0x1E00, "Latin"),
    (0x1F00, "Greek"), (0x2000, "Latin"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"),
    (0x3190, "Han"), (0xAC00, "Hangul"), (0xD7B0, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"),
    (0xFB50, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"), (0x10000, "other"), (0x20000, "Han"),
)
_FIRST = np.array([a for a, _ in _RANGES])
SCRIPTS = sorted({s for _, s in _RANGES})
_SCRIPT = np.array([SCRIPTS.index(s) for _, s in _RANGES])


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters, 2, or marks, 1, which only join letters within trigrams."""
    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


@dataclass
class Words:
    """The words of several texts, one after another: trigrams, and where words and texts begin."""

    bins: np.ndarray
    begin: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    texts: np.ndarray


def words_of_texts(texts: list[str]) -> Words:
    """Words of texts in lower case; what is not a letter is a boundary within trigrams."""
    joined = " ".join(["", *(t.lower().replace("\x00", " ") for t in texts), ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _letters()[points]
    letter, true_letter = kind > 0, kind == 2
    space = (points == 32) | ((points >= 9) & (points <= 13))
    first = ~space
    first[1:] &= space[:-1]
    begin = np.flatnonzero(first)
    p = np.where(letter, points, 0).astype(np.uint32)
    code = p * np.uint32(0x9E3779B1)
    code[1:] ^= p[:-1] * np.uint32(0x85EBCA77)
    code[2:] ^= p[:-2] * np.uint32(0xC2B2AE3D)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    # A trigram counts if it ends in a letter or is the end of a word.
    ends = np.zeros(len(p), bool)
    ends[1:] = letter[:-1]
    bins = np.where(letter | ends, (code >> np.uint32(16)).astype(np.int32), BINS)
    if not len(begin):
        empty = np.empty(0, np.int64)
        return Words(bins, empty, empty, empty, np.zeros(len(texts) + 1, np.int64))
    n_letters = np.add.reduceat(true_letter.astype(np.int64), begin)
    nearest = np.minimum.accumulate(np.where(true_letter, np.arange(len(p)), len(p) - 1)[::-1])[::-1]
    script = _SCRIPT[np.searchsorted(_FIRST, points[nearest[begin]], "right") - 1]
    starts = np.cumsum([0, *(len(t.lower()) + 1 for t in texts)])
    return Words(bins, begin, n_letters, script, np.searchsorted(begin, starts))


@dataclass
class Languages:
    names: list[str]
    table: np.ndarray  # BINS + 1 by languages; the last row, of no trigram, is 0
    scripts: np.ndarray  # scripts by languages: whether the language is written in it


def label_words(words: Words, known: Languages) -> np.ndarray:
    """The language of each word by Viterbi search, all texts together, the longest first."""
    n, k = np.diff(words.texts), len(known.names)
    scores = np.add.reduceat(known.table[words.bins], words.begin, axis=0) if len(words.begin) else np.zeros((0, k))
    can = known.scripts[words.script]
    can |= ~can.any(axis=1, keepdims=True)
    scores[~can & (words.letters > 0)[:, None]] -= 1000.0
    order = np.argsort(-n, kind="stable")
    first, n = words.texts[:-1][order], n[order]
    out = np.zeros(len(words.begin), np.int64)
    if not len(n) or n[0] == 0:
        return out
    live = np.searchsorted(-n, -np.arange(n[0]), "left")  # texts with more than t words
    value = scores[first[: live[0]]]
    switched, came = [], []
    for t in range(1, n[0]):
        value = value[: live[t]]
        best = value.argmax(axis=1)
        other = value[np.arange(len(best)), best] - SWITCH
        jump = other[:, None] > value
        value = np.where(jump, other[:, None], value) + scores[first[: live[t]] + t]
        switched.append(jump)
        came.append(best)
        if t + 1 < n[0] and live[t + 1] < live[t]:
            ended = slice(live[t + 1], live[t])
            out[first[ended] + t] = value[ended].argmax(axis=1)
    last = n[0] - 1
    out[first[: live[last]] + last] = value[: live[last]].argmax(axis=1)
    ends = first[: live[0]] + n[: live[0]] - 1
    if last > 0:
        only = np.flatnonzero(n[: live[0]] == 1)
        out[ends[only]] = scores[ends[only]].argmax(axis=1)
    for t in range(last, 0, -1):
        rows = first[: live[t]]
        state = out[rows + t]
        jump = switched[t - 1][np.arange(len(rows)), state]
        out[rows + t - 1] = np.where(jump, came[t - 1], state)
    return out


def spans_of(labels: np.ndarray, names: list[str]) -> str:
    """Language, first word and word after the last of each span, joined."""
    cut = np.flatnonzero(np.diff(labels)) + 1
    edges = [0, *cut.tolist(), len(labels)]
    return ",".join(f"{names[labels[a]]}:{a}:{b}" for a, b in zip(edges, edges[1:]) if b > a)


def identify_texts(texts: list[str | None], known: Languages) -> list[tuple[str, float, str]]:
    """Language, score and spans of each text."""
    out: list[tuple[str, float, str]] = []
    step, k = [], max(1, len(known.names))
    size = 0

    def run() -> None:
        words = words_of_texts(step)
        labels = label_words(words, known) if known.names else np.zeros(len(words.begin), np.int64)
        for a, b in zip(words.texts, words.texts[1:]):
            letters = np.bincount(labels[a:b], words.letters[a:b], k) if b > a else np.zeros(k)
            if not letters.sum() or not known.names:
                out.append(("und", 0.0, ""))
            else:
                best = int(letters.argmax())
                out.append((known.names[best], float(letters[best] / letters.sum()), spans_of(labels[a:b], known.names)))
        step.clear()

    for t in texts:
        step.append(t or "")
        size += len(t or "") * k
        if size > HELD:
            run()
            size = 0
    run()
    return out


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame) -> Languages:
    """Trigram tables and scripts of the labelled languages, from documents that are not held out."""
    text = F.col("text")
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    number = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(1 << 20))
    labelled = labelled.select("lang", text, number.alias("number"))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels of languages")
    chosen = F.lit(False)
    for lang, n in sizes.items():
        chosen |= (F.col("lang") == lang) & (F.col("number") < int(min(1.0, SAMPLE / n) * (1 << 20)) + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of_texts([t])
                own = total.setdefault(lang, np.zeros(BINS + 1 + len(SCRIPTS), np.int64))
                own[: BINS + 1] += np.bincount(words.bins, minlength=BINS + 1)
                own[BINS + 1 :] += np.bincount(words.script, words.letters, len(SCRIPTS)).astype(np.int64)
        for lang, own in total.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(own[at])], ["lang", "bin", "n"])

    counted = labelled.filter(chosen).select("lang", "text").mapInArrow(count, "lang string, bin bigint, n bigint")
    counted = counted.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()  # at most BINS rows per language
    names = sorted(sizes)
    table = np.zeros((BINS + 1 + len(SCRIPTS), len(names)))
    column = counted["lang"].map({x: k for k, x in enumerate(names)})
    table[counted["bin"].to_numpy(np.int64), column.to_numpy(np.int64)] = counted["n"]
    letters = table[BINS + 1 :]
    grams = table[:BINS] + 0.05
    logs = np.log(grams / grams.sum(axis=0)) if names else grams
    scripts = letters >= SCRIPT_SHARE * np.maximum(1, letters.sum(axis=0))
    return Languages(names, np.vstack([logs, np.zeros(len(names))]).astype(np.float32), scripts)


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``spans`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, spans = zip(*identify_texts(batch.column(2).to_pylist(), shared.value)) if len(batch) else ((),) * 3
            columns = [*batch.columns[:2], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "spans"])

    own = docs.select(F.col("doc_id").cast("bigint"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return own.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, spans string")
