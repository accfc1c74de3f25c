from __future__ import annotations

import datetime

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.functions import half_day
from tarmac.operators.aggregate import (
    DELAY_HIGH,
    DELAY_LOW,
    _least_by_text,
    airport_counts,
    best_flight,
    delay_tally,
)
from tarmac.operators.rank import first_k, top_k_per_group
from tarmac.plans import QUESTIONS
from tarmac.plans import QUESTIONS, shared_answers, shared_tally

DAY = datetime.date(2008, 1, 3)
FLIGHT = (
    "flight_date DATE, carrier STRING, flight_num STRING, origin STRING, destination STRING,"
    " dep_time STRING, arr_delay INT"
)

# Carriers, numbers, times and delays of the usual form and beyond it.
FLIGHTS = st.tuples(
    st.just(DAY),
    st.sampled_from(["AA", "A1", "9E", "ZZ", "aa", "AAA", "A", "", "É1", "A "]),
    st.sampled_from(["1", "10", "100", "0010", "45", "456", "9999999", "12345678", "12A", "", "0", "00"]),
    st.sampled_from(["BOS", "LGA"]),
    st.just("ATL"),
    st.sampled_from(["0600", "0900", "1159", "1200", "2400", "600", "09000", "0000", "2499", "2500", "9999"]),
    st.sampled_from([0, 1, 5, -1024, -1025, 7167, 7168, 2**31 - 1, -(2**31)]),
)


def least_by_hand(flights):
    best = {}
    for day, carrier, number, origin, destination, time, delay in flights:
        key = (day, "AM" if int(time) < 1200 else "PM", origin, destination)
        found = (delay, time, f"{carrier} {number}")
        best[key] = min(best.get(key, found), found, key=lambda f: (f[0], f[1].encode(), f[2].encode()))
    return sorted(((*key, *value) for key, value in best.items()), key=repr)


COLUMNS = ("flight_date", "period", "origin", "destination", "arr_delay", "dep_time", "flight")


@settings(max_examples=25, deadline=None)
@given(st.lists(FLIGHTS, min_size=1, max_size=40))
def test_best_flight_equals_brute_force(spark, flights):
    df = spark.createDataFrame(flights, FLIGHT)
    assert rows(best_flight(df), *COLUMNS) == least_by_hand(flights)


@pytest.mark.parametrize("delay", [DELAY_LOW, DELAY_HIGH])
@pytest.mark.parametrize("carrier, number", [("00", "0"), ("ZZ", "9999999"), ("9E", "0000000")])
@pytest.mark.parametrize("time", ["0000", "2400", "2499"])
def test_best_flight_at_the_bounds_of_its_code(spark, delay, carrier, number, time):
    flights = [(DAY, carrier, number, "BOS", "ATL", time, delay)]
    df = spark.createDataFrame(flights, FLIGHT).repartition(1)
    assert rows(best_flight(df), *COLUMNS) == least_by_hand(flights)


def test_both_forms_of_best_flight_agree(flights):
    rows_ = flights.withColumn("period", half_day(F.col("dep_time")))
    assert rows(best_flight(flights)) == rows(_least_by_text(rows_))


def test_best_flight_does_not_sort_the_flights(flights):
    plan = best_flight(flights)._jdf.queryExecution().executedPlan().toString()
    first_shuffle = plan.split("Exchange")[-1]
    assert "HashAggregate" in first_shuffle and "Sort" not in first_shuffle


def test_tie_on_delay_goes_to_earlier_time_then_name(spark):
    same = [
        (DAY, "WN", "2", "BOS", "ATL", "0900", 5),
        (DAY, "WN", "3", "BOS", "ATL", "0600", 5),
        (DAY, "WN", "10", "BOS", "ATL", "0600", 5),
    ]
    assert best_flight(spark.createDataFrame(same, FLIGHT)).first().flight == "WN 10"


def test_one_trip_with_a_third_of_the_rows(spark):
    hot = spark.range(30_000).selectExpr(
        "DATE'2008-01-03' AS flight_date",
        "'WN' AS carrier",
        "CAST(id AS STRING) AS flight_num",
        "IF(id % 3 = 0, 'BOS', CONCAT('X', id % 500)) AS origin",
        "'ATL' AS destination",
        "'0600' AS dep_time",
        "CAST(30000 - id AS INT) AS arr_delay",
    )
    best = {r.origin: r.flight for r in best_flight(hot).collect()}
    assert len(best) == 501 and best["BOS"] == "WN 29997"


def test_counts(spark):
    tokens = spark.createDataFrame([("A",), ("B",), ("A",)], "airport STRING")
    assert rows(airport_counts(tokens)) == [("A", 2), ("B", 1)]


def test_tally(spark):
    df = spark.createDataFrame([("A", 1), ("A", 0), ("B", 1)], "k STRING, m INT")
    tally = delay_tally(df, ["k"], "m")
    assert rows(tally, "k", "total", "n") == [("A", 1, 2), ("B", 1, 1)]
    assert dict(tally.dtypes) == {"k": "string", "total": "bigint", "n": "bigint"}


def test_top_k_cuts_and_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("O", f"D{i:02}", 0) for i in range(12)] + [("P", "B", 0), ("P", "A", 0), ("P", "C", 100)],
        "g STRING, name STRING, pct INT",
    )
    ranked = top_k_per_group(df, ["g"], ["pct", "name"])
    assert rows(ranked.filter("g = 'O'"), "rank", "name") == sorted(
        [(i + 1, f"D{i:02}") for i in range(10)], key=repr
    )
    assert rows(ranked.filter("g = 'P'"), "rank", "name") == [(1, "A"), (2, "B"), (3, "C")]


def test_top_k_is_cut_before_the_shuffle(flights):
    plan = QUESTIONS["origin_top10_destinations"].on_records(flights)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 10, Partial" in text and "row_number(), 10, Final" in text


def test_first_k_has_no_full_sort(spark):
    df = spark.range(100).withColumn("n", F.col("id") % 7)
    top = first_k(df, [F.desc("n"), "id"], 10)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    got = [tuple(r) for r in top.orderBy("rank").collect()]
    ordered = sorted(((i, i % 7) for i in range(100)), key=lambda r: (-r[1], r[0]))[:10]
    assert got == [(i, n, rank) for rank, (i, n) in enumerate(ordered, 1)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 3), st.integers(0, 30)), min_size=1, max_size=50))
def test_ranks_are_without_gaps_and_percent_never_falls(spark, triples):
    named = {(g, name): (g, name, pct) for g, pct, name in triples}
    df = spark.createDataFrame(list(named.values()), "g STRING, name INT, pct INT")
    ranked = top_k_per_group(df, ["g"], ["pct", "name"], 5)
    by_group: dict = {}
    for g, rank, pct in ranked.select("g", "rank", "pct").collect():
        by_group.setdefault(g, []).append((rank, pct))
    for found in by_group.values():
        found.sort()
        assert [r for r, _ in found] == list(range(1, len(found) + 1)) and len(found) <= 5
        assert [p for _, p in found] == sorted(p for _, p in found)


@pytest.mark.parametrize("name", [n for n, q in QUESTIONS.items() if q.columns])
def test_order_and_split_of_the_input_do_not_matter(flights, name):
    shuffled = flights.repartition(7).orderBy(F.rand(3))
    assert rows(QUESTIONS[name].on_records(shuffled)) == rows(QUESTIONS[name].on_records(flights))


def test_shared_tally_gives_the_same_answers(flights):
    for name, answer in shared_answers(shared_tally(flights)).items():
        assert rows(answer) == rows(QUESTIONS[name].on_records(flights)), name


@pytest.mark.parametrize("name", list(QUESTIONS))
def test_answer_has_the_table_columns_and_key(flights, name):
    from tarmac.sources.derived import on_time_lines, origin_destination_lines

    question = QUESTIONS[name]
    lines = on_time_lines(flights) if question.columns else origin_destination_lines(flights)
    answer = question.on_lines(lines)
    assert dict(answer.dtypes) == {f.name: f.dataType.simpleString() for f in question.table.schema}
    assert answer.select(*question.table.key).distinct().count() == answer.count()


def test_all_weekdays_are_ranked(spark):
    flights = [(f"day {i}", i % 2) for i in range(12)]
    answer = QUESTIONS["weekday_rank"].on_records(spark.createDataFrame(flights, "weekday STRING, arr_delayed INT"))
    assert sorted(r[0] for r in rows(answer, "rank")) == list(range(1, 13))


NULLS = "flight_date DATE, origin STRING, destination STRING, carrier STRING, flight_num STRING, dep_time STRING, arr_delay INT"


def test_typed_rows_without_a_field_are_no_records(spark):
    day = datetime.date(2008, 1, 3)
    flights = [
        (day, "A", "B", "WN", "1", "0600", 10),
        (day, "A", "B", "WN", "2", "0600", None),
        (day, "A", "B", "WN", "3", None, 1),
        (day, "A", "B", "WN", "4", "noon", 1),
        (None, "A", "B", "WN", "5", "0600", 0),
    ]
    df = spark.createDataFrame(flights, NULLS)
    best = QUESTIONS["best_flight"].on_records(df).collect()
    assert [(r.flight, r.departure_time, r.delay) for r in best] == [("WN 1", "0600", 10)]
    mean = QUESTIONS["pair_mean_delay"].on_records(df).first().mean_delay
    assert mean == 3.0
    tokens = spark.createDataFrame([("A",), (None,), ("",)], "airport STRING")
    assert rows(QUESTIONS["airport_top10"].on_records(tokens), "airport", "n") == [("A", 1)]
