from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from conftest import rows

from tarmac.llm import codes

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def by_hand(given, rounds=2):
    """Lloyd with whole scans, in Python integers."""
    good = [r for r in given if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    vectors = [[math.floor(256 * float(np.float32(x))) for x in r[1]] for r in good]
    width = len(vectors[0]) // 16
    part = lambda v, p: v[p * width : (p + 1) * width]
    start = sorted({r[0] for r in good if r[0] is not None})[:64]
    first = {i: min(v for r, v in zip(good, vectors) if r[0] == i) for i in start}
    books = [[part(first[i], p) for i in start] for p in range(16)]

    def assign():
        near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(part(v, p), c)), k) for k, c in enumerate(books[p]))
        return [[near(v, p) for p in range(16)] for v in vectors]

    for _ in range(rounds):
        found = assign()
        for p in range(16):
            for k in range(len(start)):
                own = [part(v, p) for v, f in zip(vectors, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    of = lambda label: sum(e for r, e in zip(good, errors) if r[2] == label)
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(r[0], "".join(f"{k:02x}" for _, k in f), e, of(r[2]), digest) for r, f, e in zip(good, found, errors)]


def vectors(seed, n, width=32):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in np.float32(rng.normal(0, 0.02, width))], int(i) % 3) for i in rng.permutation(n)]


def compressed(spark, given, **options):
    found = codes.compress(spark.createDataFrame(given, SCHEMA), **options)
    return rows(found, "vec_id", "code", "error", "label_error", "codebooks_sha256")


@pytest.mark.parametrize("n", [1, 40, 300])
def test_equals_lloyd_by_hand(spark, n):
    given = vectors(n, n)
    assert compressed(spark, given) == sorted(by_hand(given), key=repr)


def test_odd_rows(spark):
    given = vectors(3, 90)
    same = given[5][1]
    given += [(None, same, None), (None, given[7][1], None), (200, same, None), (3, same, 1), (3, same, 1), (201, None, 1), (202, [], 1)]
    given += [(203, [*same[:-1], None], 1), (204, [*same[:-1], math.nan], 1), (205, [*same[:-1], -math.inf], 2)]
    assert compressed(spark, given) == sorted(by_hand(given), key=repr)
    # Vectors of other lengths are left out.
    assert compressed(spark, [*given, (206, same[:16], 1), (207, same[:5], 1)]) == compressed(spark, given)
    huge = compressed(spark, [*given, (208, [3e38] * 32, 1)])
    assert len(huge) == len(compressed(spark, given)) + 1


def test_nothing_to_start_from(spark):
    assert compressed(spark, []) == []
    assert compressed(spark, [(None, [0.1] * 16, 1), (2, None, 1)]) == []
    assert compressed(spark, [(1, [0.1] * 15, 1)]) == []


def test_names_within_and_labels_alone(spark, monkeypatch):
    given = vectors(4, 80)
    rare = [(i, v, i) for i, v, _ in given]  # every label once: none is frequent
    monkeypatch.setattr(codes, "LABEL_SHARE", 1)
    assert compressed(spark, rare) == sorted(by_hand(rare), key=repr)
    extra = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in given], f"{SCHEMA}, codes STRING, code STRING, `a.b` INT, name STRING")
    assert rows(codes.compress(extra)) == rows(codes.compress(spark.createDataFrame(given, SCHEMA)))


def test_active_entries_equal_whole_scans():
    rng = np.random.default_rng(0)
    for _ in range(100):
        x, c = rng.integers(-4, 5, (60, 4)), rng.integers(-4, 5, (9, 4))
        before = codes.scan(x, c)
        after = c.copy()
        for k in rng.choice(9, rng.integers(0, 10), replace=False):
            after[k] = rng.integers(-4, 5, 4)
        got = codes.update(x, after, (c != after).any(axis=1), *before)
        assert all((a == b).all() for a, b in zip(got, codes.scan(x, after)))


def test_settled_parts_scan_moved_entries_alone(monkeypatch):
    compared = []
    real = codes.distances
    monkeypatch.setattr(codes, "distances", lambda x, c: compared.append((len(x), len(c))) or real(x, c))
    x = np.array([[0], [10], [20], [30]])
    entries = np.array([[0], [12], [20], [33]])
    moved = np.array([False, True, False, False])
    nearest, far = codes.update(x, entries, moved, np.array([0, 1, 2, 3]), np.array([0, 0, 0, 9]))
    assert compared == [(3, 1), (1, 4)] and nearest.tolist() == [0, 1, 2, 3] and far.tolist() == [0, 4, 0, 9]


def test_distances_of_large_numbers_are_exact():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-codes.LIMIT, codes.LIMIT, (5, 64)), rng.integers(-codes.LIMIT, codes.LIMIT, (4, 64))
    assert codes.distances(x, c).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, s)) for s in c] for r in x]
