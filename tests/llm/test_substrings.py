from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
from conftest import rows

from tarmac.llm import substrings
from tarmac.llm.fmindex import FMIndex

W = substrings.WINDOW


def brute_force(texts):
    words = [t.encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + W]) for w in words for i in range(len(w) - W + 1))
    out = []
    for k, w in enumerate(words):
        gone = [False] * len(w)
        for i in range(len(w) - W + 1):
            if seen[tuple(w[i : i + W])] > 1:
                gone[i : i + W] = [True] * W
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((k, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = lambda n, v=400: [f"w{rng.randrange(v)}" for _ in range(n)]
    passage, line = words(50), words(34)
    texts = [words(rng.choice((10, 34, 35, 36, 200))) for _ in range(30)]
    for t in texts[:12]:
        at = rng.randrange(len(t) + 1)
        t[at:at] = rng.choice((passage, passage[3:40], line))
    texts += [texts[0], list(texts[1]), ["x"] * 36, ["x"] * 35, ["a", "b"] * 40, words(40) * 3, []]
    return [" ".join(t) for t in texts]


def test_equals_brute_force(docs_of):
    for seed in (1, 2, 3):
        texts = corpus(seed)
        got = rows(substrings.remove_repeats(docs_of(*texts)), "doc_id", "n_words", "n_removed", "kept_sha256")
        assert sorted(got) == brute_force(texts)


def test_hot_keys_and_small_shards(docs_of, monkeypatch):
    texts = corpus(4)
    monkeypatch.setattr(substrings, "HOT", 1)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 50)
    got = rows(substrings.remove_repeats(docs_of(*texts)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(got) == brute_force(texts)


def test_shared_text_ids(docs_of, monkeypatch):
    from pyspark.sql import functions as F

    texts = corpus(5)
    real = F.xxhash64
    monkeypatch.setattr(substrings.F, "xxhash64", lambda *c: real(*c) if len(c) > 1 else F.pmod(real(*c), F.lit(5)))
    ids = substrings._with_text_id(docs_of(*texts)).collect()
    assert len({r["text_id"] for r in ids}) == len(set(texts))


def test_kept_text(docs_of):
    found = substrings.remove_repeats(docs_of("a b", "c"), with_text=True)
    assert rows(found, "doc_id", "kept_text") == [(0, "a b"), (1, "c")]


def test_matching_statistics():
    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 5, 400), 0)
    ends = np.arange(len(text) - 1)
    got = FMIndex(text).matching_statistics(text, ends, 12)
    whole = text.tolist()
    for e in range(len(whole) - 1):
        best = 0
        for n in range(1, min(12, e + 1) + 1):
            part = whole[e - n + 1 : e + 1]
            if 0 in part or sum(whole[i : i + n] == part for i in range(len(whole) - n + 1)) < 2:
                break
            best = n
        assert got[e] == best
