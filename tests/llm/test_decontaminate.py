from __future__ import annotations

import random

import numpy as np
from conftest import rows

from tarmac.llm import decontaminate as d


def words(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def slow_align(item, text):
    best, table = 0, [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            step = table[i - 1][j - 1] + (d.MATCH if a == b else d.MISS)
            table[i][j] = max(0, step, table[i - 1][j] + d.GAP, table[i][j - 1] + d.GAP)
            best = max(best, table[i][j])
    return best


def test_alignment():
    rng = random.Random(1)
    for _ in range(50):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 25))] for _ in range(2))
        assert d.align(np.array(a), np.array(b))[0] == slow_align(a, b)


def test_planted_passages(spark, monkeypatch):
    rng = random.Random(2)
    items = [(i, words(rng, rng.randrange(15, 60))) for i in range(30)]
    docs, planted = [], set()
    for k in range(150):
        body = words(rng, rng.randrange(20, 400))
        if k % 3 == 0:
            i, passage = items[rng.randrange(30)]
            passage = list(passage)
            for _ in range(len(passage) // 12 if k % 2 else 0):  # edited copies
                at = rng.randrange(len(passage))
                passage[at : at + 1] = rng.choice(([], ["new"], ["new", passage[at]]))
            at = rng.randrange(len(body))
            body[at:at] = passage
            planted.add((k, i))
        docs.append((k, " ".join(body).capitalize()))
    # An item that nearly all documents hold is found as well, by its own rarest grams.
    docs += [(1000 + k, " ".join([*words(rng, 10), *items[0][1], "end."])) for k in range(300)]
    planted |= {(1000 + k, 0) for k in range(300)}
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    bench = spark.createDataFrame([(i, " ".join(w) + "!") for i, w in items], "item_id BIGINT, text STRING")
    assert set(rows(d.contaminated(df, bench), "doc_id", "item_id")) == planted
    clean = {r["doc_id"] for r in d.decontaminate(df, bench).collect()}
    assert clean == {k for k, _ in docs} - {k for k, _ in planted}
    monkeypatch.setattr(d, "BLOCK_ITEMS", 7)
    assert set(rows(d.contaminated(df, bench), "doc_id", "item_id")) == planted


def test_edited_copies(spark):
    """A copy with every fifth to seventh word changed, the only one of its item, is found with its score."""
    rng = random.Random(8)
    items, docs, expected = [], [], set()
    for k in range(45):
        item = words(rng, rng.randrange(15, 56))
        copy = [f"new{k}" if i % (5 + k % 3) == 4 else w for i, w in enumerate(item)]
        if k % 2:  # words put in as well
            copy[9:9] = [f"in{k}x{i}" for i in range(len(item) // 3)]
        copy = [*words(rng, rng.randrange(40)), *copy, *words(rng, rng.randrange(40))]
        items.append((k, " ".join(item)))
        docs.append((k, " ".join(copy)))
        score = slow_align(item, copy) / (d.MATCH * len(item))
        if score >= 0.5:
            expected.add((k, k, score))
    assert len(expected) > 20
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    assert set(rows(d.contaminated(df, bench), "doc_id", "item_id", "score")) == expected


def test_every_item_by_every_document(spark):
    """Copies with 15 to 30 % of their words replaced at random, against the alignment of all pairs."""
    rng = random.Random(4)
    items = [(k, words(rng, rng.randrange(15, 56))) for k in range(25)]
    docs = []
    for k in range(100):
        item, share = items[k % 25][1], (0.15, 0.2, 0.25, 0.3)[k // 25]
        copy = [f"x{k}y{i}" if rng.random() < share else w for i, w in enumerate(item)]
        docs.append((k, [*words(rng, rng.randrange(60)), *copy, *words(rng, rng.randrange(60))]))
    want, lost = set(), set()
    for k, text in docs:
        numbers = {w: i for i, w in enumerate(dict.fromkeys(text))}
        for i, item in items:
            whole = d.align(np.array([numbers.get(w, -1) for w in item]), np.arange(0) if not text else np.array([numbers[w] for w in text]))
            score = whole[0] / (d.MATCH * len(item))
            if score >= 0.5:
                want.add((k, i, score))
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in docs], "doc_id BIGINT, text STRING")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id BIGINT, text STRING")
    got = set(rows(d.contaminated(df, bench), "doc_id", "item_id", "score"))
    lost = want - got
    assert got <= want and len(want) > 60
    for k, i, _ in lost:  # only those without four words in a row are missed
        text, item = docs[k][1], items[i][1]
        grams = lambda ws: {tuple(ws[j : j + 4]) for j in range(len(ws) - 3)}
        assert not grams(text) & grams(item)
    assert len(lost) <= 2


def test_rare_grams_lead_and_common_ones_fill_in():
    block = d.Items([(1, " ".join(f"w{i}" for i in range(12))), (2, "w0 w1 w2 w3 z1 z2 z3")])
    block.choose({int(g): 100 if n < 4 else 1 for n, g in enumerate(block.places[0])} | {int(g): 3 for g in block.places[1][1:]})
    rare = {(item, j) for seeds in block.seeds.values() for item, j, r in seeds if r}
    assert (0, 4) in rare and (0, 0) in rare and (0, 1) not in rare
    # An intact gram that is not the rarest of its neighbours finds the copy by itself.
    text = "a b w1 w2 w3 w4 c w6 w7 d w9 w10 w11"
    assert [m[0] for m in d.matches(block, text, 0.4)] == [1]


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    item = "one two three four five six seven"
    docs = spark.createDataFrame([(1, item), (1, "clean"), (None, item), (None, None), (2, item), (2, item)], "doc_id BIGINT, text STRING")
    bench = spark.createDataFrame([(9, item)], "item_id BIGINT, text STRING")
    left = d.decontaminate(docs.selectExpr("*", "1 AS id", "2 AS h1", "3 AS `a.b`", "4 AS row"), bench)
    assert left.columns == ["doc_id", "text", "id", "h1", "a.b", "row"]
    assert rows(left, "doc_id", "text") == [(1, "clean"), (None, None)]
    assert rows(d.contaminated(docs, bench), "doc_id") == [(1,), (2,), (2,), (None,)]
