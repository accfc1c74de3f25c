from __future__ import annotations

import random
from collections import Counter

from conftest import SF_DIR, rows

from tarmac.llm import quality


def brute_force(text):
    text = text or ""
    blank = " \t\n\x0b\x0c\r"
    words = [w for w in "".join(" " if c in blank else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(blank)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, again = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            again |= set(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again), failed


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(spark, odd):
    rng = random.Random(1)
    texts = [r["text"] for r in odd.collect()]
    for _ in range(60):
        words = [rng.choice(("a", "b", "é#", "c|", "\n", "\x0b", " ", " x", "\U0001f600")) for _ in range(rng.randrange(80))]
        texts.append(rng.choice((" ", "  ", "\n")).join(words))
    texts += [" ".join(f"w{i % 9}" for i in range(n)) for n in (7, 8, 9, 16, 17, 18, 40)]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, lang STRING")
    got = rows(quality.quality(docs), "row.doc_id", *COLUMNS)
    assert sorted(got) == [(i, *brute_force(t)) for i, t in enumerate(texts)]


def test_only_functions_of_spark(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = quality.quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_divergent_documents_go(spark):
    rng = random.Random(2)
    usual = lambda n: " ".join(rng.choice(("the", "of", "and", "to", "nation", "reason", "winter", "gather")) for _ in range(n))
    docs = [(i, usual(200), "en") for i in range(50)]
    shouted = " ".join(f"{w.upper()}{i}!!" for i, w in enumerate(usual(200).split()))
    strange = " ".join(f"q{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    docs += [(100, shouted, "en"), (101, strange, "en"), (102, shouted, None), (103, strange, "zz"), (104, usual(25), "en")]
    got = dict(rows(quality.quality(spark.createDataFrame(docs, "doc_id BIGINT, text STRING, lang STRING")), "row.doc_id", "kept"))
    assert [got[i] for i in (100, 101, 102, 103, 104)] == [False, False, True, True, True]
    assert all(got[i] for i in range(50))
