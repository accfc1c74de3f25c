from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import SF_DIR, rows
from pyspark.sql import functions as F

from tarmac.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 40 and right >= 0.95


def slow_labels(scores):
    """Viterbi search over one text, state by state."""
    value, back = scores[0].copy(), []
    for s in scores[1:]:
        best = int(value.argmax())
        came = [best if value[best] - language.SWITCH > value[k] else k for k in range(len(value))]
        value = np.array([max(value[k], value[best] - language.SWITCH) for k in range(len(value))]) + s
        back.append(came)
    state = int(value.argmax())
    out = [state]
    for came in reversed(back):
        state = came[state]
        out.append(state)
    return out[::-1]


def test_labels_equal_those_of_single_texts():
    rng = random.Random(1)
    table = np.random.default_rng(1).normal(0, 3, (language.BINS + 1, 3)).astype(np.float32)
    table[-1] = 0
    known = language.Languages(["a", "b", "c"], table, np.ones((len(language.SCRIPTS), 3), bool))
    texts = [" ".join("".join(rng.choice("abcdé1") for _ in range(rng.randrange(1, 7))) for _ in range(n)) for n in (0, 1, 2, 40, 1, 40, 7)]
    words = language.words_of_texts(texts)
    labels = language.label_words(words, known)
    scores = np.add.reduceat(table[words.bins], words.begin, axis=0)
    for a, b in zip(words.texts, words.texts[1:]):
        if b > a:
            assert labels[a:b].tolist() == slow_labels(scores[a:b].astype(np.float32))


def test_mixed_texts_and_scripts(spark):
    rng = random.Random(3)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(5))
    text = lambda letters, n: " ".join(word(letters) for _ in range(n))
    kinds = {"xa": "abcdefg", "xb": "nopqrst", "ru": "абвгдеж"}
    docs = [(i, text(kinds[k], 60), k) for i, k in enumerate(list(kinds) * 40)]
    mixed = text("abcdefg", 50) + "\n" + text("абвгдеж", 30) + " 12 " + text("nopqrst", 20)
    docs += [(500, mixed, None), (501, "123 !?", "xa"), (502, None, "xa"), (503, "漢字", None)]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(docs, "doc_id BIGINT, text STRING, lang STRING")).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in docs[:120])
    assert got[500]["lang_pred"] == "xa" and abs(got[500]["score"] - 0.5) < 1e-9
    assert [s.split(":")[0] for s in got[500]["spans"].split(",")] == ["xa", "ru", "xb"]
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (501, 502)] == [("und", 0.0)] * 2
    assert got[503]["lang_pred"] in kinds


def test_learns_from_nothing_held_out(spark):
    docs = spark.createDataFrame([(i, "abc def", f"l{i}") for i in range(60)], "doc_id BIGINT, text STRING, lang STRING")
    held = {r["doc_id"] for r in docs.filter(language.held_out(F.col("doc_id"))).collect()}
    assert set(language.learn(docs).names) == {f"l{i}" for i in range(60) if i not in held}


def test_marks_are_no_letters(spark):
    docs = [(i, "some words of one language and more of them", "en") for i in range(30)]
    asked = [(100, "❤️ 123"), (101, "́"), (102, "12 ́́ !"), (103, "café")]
    table = spark.createDataFrame([*docs, *((i, t, None) for i, t in asked)], "doc_id BIGINT, text STRING, lang STRING")
    got = dict(rows(language.identify(table).filter("doc_id >= 100"), "doc_id", "lang_pred"))
    assert got == {100: "und", 101: "und", 102: "und", 103: "en"}


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    table = spark.createDataFrame([(i, "text", f"l{i}") for i in range(40)], "doc_id BIGINT, text STRING, lang STRING")
    with pytest.raises(ValueError, match="more than 3 labels"):
        language.identify(table)
