from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import rows

from tarmac.llm import interleave

SCHEMA = "doc_id BIGINT, text STRING, source STRING"


def by_hand(docs, shards=16):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    by_source = defaultdict(list)
    for doc_id, text, source in docs:
        digest = md5(f"42:{'' if doc_id is None else doc_id}:{'' if text is None else '=' + text}")
        by_source["" if source is None else f"={source}"].append((digest, doc_id, text))
    order = []
    for name, members in by_source.items():
        begin = int(md5(f"42:{name}")[:8], 16) / 2**32
        for rank, (digest, doc_id, text) in enumerate(sorted(members, key=lambda m: m[0])):
            order.append(((rank + begin) / len(members), name, digest, doc_id, (text or "").encode()))
    order.sort(key=lambda o: o[:3])
    begins = [-(-s * len(order) // shards) for s in range(shards)]
    out = []
    for place, (_, _, _, doc_id, text) in enumerate(order):
        shard = place * shards // len(order)
        out.append((doc_id, len(text) + 1, zlib.crc32(text), "rows", shard, place - begins[shard], None))
    return sorted(out, key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    names = ["big"] * 5 + ["mid", "é", None, "", "rare"]
    texts = ["", None, "é 漢", "x" * 1000, *(f"text {i}" for i in range(20))]
    return [(i, rng.choice(texts), rng.choice(names)) for i in range(n)]


PLACED = ("doc_id", *interleave.ADDED)


@pytest.mark.parametrize("n", [1, 7, 500])
def test_equals_one_sorted_list(spark, monkeypatch, n):
    monkeypatch.setattr(interleave, "RANGE_ROWS", 30)
    docs = corpus(n, n)
    table = spark.createDataFrame(docs, SCHEMA)
    assert rows(interleave.places(table), *PLACED) == by_hand(docs)
    assert rows(interleave.interleave(table), *PLACED) == by_hand(docs)


def test_shards_match_the_mixture(spark):
    docs = corpus(2, 3000) + [(10_000 + i, "t", f"only {i}") for i in range(160)]
    found = interleave.places(spark.createDataFrame(docs, SCHEMA)).collect()
    sizes = Counter(r["shard"] for r in found)
    assert sorted(sizes) == list(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(size))
    of = Counter(r["source"] for r in found)
    for (shard, source), n in Counter((r["shard"], r["source"]) for r in found).items():
        # One row by rounding, and a source's share of the rounding of 166 sources, by which equal counts move a cut.
        assert abs(n - of[source] / 16) <= 1 + 13 * of[source] / len(found), (shard, source)
    lone = Counter(r["shard"] for r in found if (r["source"] or "").startswith("only"))
    assert len(lone) >= 14  # sources of one row do not meet in one shard


def test_odd_rows(spark, odd, crowded, empty, tmp_path):
    placed = interleave.interleave(crowded)
    assert placed.count() == odd.count()
    assert set(placed.columns) == {*crowded.columns, *interleave.ADDED}
    assert rows(placed, *PLACED) == rows(interleave.interleave(odd), *PLACED) == rows(interleave.places(crowded), *PLACED)
    clash = odd.selectExpr("*", "'x' AS shard", "1 AS size", "2 AS `a.b`", "map(1, 2) AS m")
    assert rows(interleave.interleave(clash), *PLACED) == rows(interleave.places(odd), *PLACED)
    assert interleave.interleave(empty).count() == interleave.places(empty).count() == 0


def test_written_shards(spark, tmp_path):
    docs = corpus(5, 200)
    table = spark.createDataFrame(docs, SCHEMA)
    interleave.write_shards(table, f"{tmp_path}/out", shards=4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert rows(back, "doc_id", "text", "shard", "slot") == rows(interleave.interleave(table, 4), "doc_id", "text", "shard", "slot")
