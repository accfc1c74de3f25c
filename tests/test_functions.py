from __future__ import annotations

import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.functions import half_day, mean32, padded_date, pct32, pct32_int, whole_number


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "part, n, percent",
    [(29, 100, 29), (58, 200, 29), (29, 50, 58), (53, 100, 52), (59, 100, 58), (106, 200, 52), (0, 3, 0), (3, 3, 100)],
)
def test_truncated_percent(spark, part, n, percent):
    assert one(spark, pct32_int(F.lit(part), F.lit(n))) == percent


def test_percent_equals_32_bit_floats(spark):
    pairs = [(a, b) for b in range(1, 200, 7) for a in range(0, b + 1, 3)]
    df = spark.createDataFrame(pairs, "a BIGINT, b BIGINT")
    got = df.select("a", "b", pct32(F.col("a"), F.col("b")), mean32(F.col("a"), F.col("b"))).collect()
    for a, b, percent, mean in got:
        assert np.float32(mean) == np.float32(a) / np.float32(b)
        assert np.float32(percent) == np.float32(a) / np.float32(b) * np.float32(100)


def test_measures_are_32_bit(spark):
    df = spark.range(1).select(pct32(F.lit(1), F.lit(3)), mean32(F.lit(1), F.lit(3)))
    assert [t for _, t in df.dtypes] == ["float", "float"]


@pytest.mark.parametrize(
    "text, number",
    [("16.00", 16), ("16.99", 16), ("-16.9", -16), ("1", 1), ("0.00", 0), ("1e2", 100), ("NaN", 0),
     ("3e9", 2**31 - 1), ("-3e9", -(2**31)), ("x", None), ("", None), (None, None)],
)
def test_whole_number(spark, text, number):
    assert one(spark, whole_number(F.lit(text).cast("string"))) == number


@pytest.mark.parametrize(
    "text, day",
    [("2008-01-03", datetime.date(2008, 1, 3)), ("2008-1-3", None), ("2008-13-01", None),
     ("2008-02-30", None), ("2008-01-3T", None), ("x", None), ("", None)],
)
def test_padded_date(spark, text, day):
    assert one(spark, padded_date(F.lit(text))) == day


@pytest.mark.parametrize(
    "time, period", [("0000", "AM"), ("1159", "AM"), ("1200", "PM"), ("2400", "PM"), ("0600", "AM"), ("900", "AM")]
)
def test_half_day(spark, time, period):
    assert one(spark, half_day(F.lit(time))) == period


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, width=32), min_size=1, max_size=20))
def test_whole_number_cuts_fraction(spark, numbers):
    df = spark.createDataFrame([(i, repr(x)) for i, x in enumerate(numbers)], "i INT, s STRING")
    got = dict(df.select("i", whole_number(F.col("s"))).collect())
    assert got == {i: int(np.float32(x)) for i, x in enumerate(numbers)}
