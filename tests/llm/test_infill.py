from __future__ import annotations

import hashlib
import random
import re

from conftest import rows

from tarmac.llm import infill

SCHEMA = "doc_id BIGINT, text STRING"


def by_hand(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n, digest = len(units), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        form, out, known = "plain", text, (None, None)
    elif h[3] % 100 < 80:
        form, out, known = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", (len(prefix), len(middle))
    else:
        form, out, known = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", (len(prefix), len(middle))
    return doc_id, n, form, *known, out, text


def hashed(doc_id, n, form, prefix, middle, out, text):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return doc_id, n, form, prefix, middle, sha(out), sha(text)


DIGESTS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def corpus(seed):
    rng = random.Random(seed)
    kinds = ["a", "é", " ", "\n", "\x0b", "<P", "漢字", " foo", "x" * 40, "<", "\x85", " ", "S>"]
    docs = [(i, "".join(rng.choice(kinds) for _ in range(rng.choice((0, 1, 3, 40, 200))))) for i in range(300)]
    return [*docs, (300, None), (301, "<P>x"), (None, "one two three"), (302, " \n "), (303, "one")]


def test_equals_plain_python(spark, monkeypatch):
    docs = corpus(1)
    table = spark.createDataFrame(docs, SCHEMA).repartition(5)
    assert rows(infill.digests(table), *DIGESTS) == sorted((hashed(*by_hand(*d)) for d in docs), key=repr)
    assert rows(infill.examples(table), "doc_id", "n", "form", "output") == sorted(
        ((d, n, form, out) for d, n, form, _, _, out, _ in (by_hand(*d) for d in docs)), key=repr
    )


def test_pieces_of_any_size_meet_again(monkeypatch):
    monkeypatch.setattr(infill, "UNITS", 5)
    monkeypatch.setattr(infill, "CHARS", 30)
    for doc_id, text in corpus(2):
        cut = list(infill.pieces_of(doc_id, (text or "").encode(), 0))
        assert max(len(row[3]) for row in cut) <= 33
        parts = sorted(infill.told(iter(cut)), key=lambda row: row[2:4])
        assert list(infill.restored(iter(parts))) == [hashed(*by_hand(doc_id, text))]


def test_copies_and_long_texts(spark):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(1000)}" for _ in range(60_000))
    docs = [(1, long), (2, "x" * 100_000), (3, " " * 50_000), *[(4, "same text here")] * 50, (4, "another text"), (None, None), (None, None), (None, "")]
    table = spark.createDataFrame(docs, SCHEMA).repartition(3)
    assert rows(infill.digests(table), *DIGESTS) == sorted((hashed(*by_hand(*d)) for d in docs), key=repr)


def test_odd_rows(odd, crowded, empty):
    want = sorted((hashed(*by_hand(r["doc_id"], r["text"])) for r in odd.collect()), key=repr)
    assert rows(infill.digests(odd), *DIGESTS) == rows(infill.digests(crowded), *DIGESTS) == want
    assert infill.digests(empty).count() == infill.examples(empty).count() == 0


def test_one_shuffle(spark, docs_of):
    plan = infill.digests(docs_of("a b", "c"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
