from __future__ import annotations

import random

import pytest

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
#: Names that the operators use within.
EXTRA = "words STRING, row STRING, kept BOOLEAN, text_id BIGINT, key STRING, verdict STRING, hash INT, key_id STRING, n_words STRING, `a.b` INT"


def sentence(rng: random.Random, n: int, vocabulary: int = 300) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, repeated rows, one id with two texts."""
    rng = random.Random(5)
    long = sentence(rng, 30_000, 5_000)
    plain = sentence(rng, 120)
    return [
        (1, None, "en", "s", None),
        (2, "", "en", "s", 0),
        (3, " \t\n\x0b\x0c\r ", None, None, 7),
        (None, plain, "en", "s", len(plain)),
        (None, None, None, None, None),
        (4, long, "en", None, len(long)),
        (5, plain, "fr", "s", len(plain)),
        (5, plain, "fr", "s", len(plain)),
        (6, plain, None, "s", None),
        (7, sentence(rng, 60), "xx", "s", 3),
        (7, sentence(rng, 70), "xx", "s", 3),
        (8, "x" * 50_000, "en", "s", 50_000),
        (9, "a " * 3_000, "en", "s", 6_000),
        (10, "é ñ   漢字 \U0001f600 <|endoftext|> \x00", "de", "s", 1),
        (11, "solo", "en", "s", 4),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="session")
def crowded(spark):
    """The same rows with further columns of the names used within."""
    extra = (None,) * len(EXTRA.split(", "))
    return spark.createDataFrame([(*r, *extra) for r in odd_rows()], f"{DOCS}, {EXTRA}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def docs_of(spark):
    return lambda *texts: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
