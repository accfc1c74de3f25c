from __future__ import annotations

import datetime
import re

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.operators.parse import FIELDS, airport_tokens, parse_on_time, rejects
from tarmac.schema import ON_TIME
from tarmac.sources.derived import damaged_lines, on_time_lines

# The documented sample record (fixed value).
LINE = "2008-01-03 Thursday WN WN 588 HOU LIT 1325 1 1435 16.00 1.00"
SHORT = "2008-01-03 Thursday WN WN 588"
BAD_DELAY = LINE.replace("16.00", "x")
BAD_DATE = LINE.replace("2008-01-03", "2008-1-3")


def test_sample_line(lines_of):
    parsed = parse_on_time(lines_of(LINE))
    assert parsed.schema == ON_TIME
    assert tuple(parsed.first()) == (
        datetime.date(2008, 1, 3), "Thursday", "WN", "WN", "588", "HOU", "LIT", "1325", 1, "1435", 16, 1,
    )


def test_bad_lines_are_rejected_with_reason(lines_of):
    lines = lines_of(LINE, SHORT, BAD_DELAY, BAD_DATE, "", None)
    assert parse_on_time(lines).count() == 1
    assert dict(tuple(r) for r in rejects(lines).collect()) == {
        SHORT: "missing origin",
        BAD_DELAY: "unreadable arr_delay",
        BAD_DATE: "unreadable flight_date",
        "": "unreadable flight_date",
        None: "missing flight_date",
    }


@pytest.mark.parametrize("bad", [SHORT, BAD_DELAY, BAD_DATE, "", None])
def test_strict_raises(lines_of, bad):
    with pytest.raises(Exception, match="bad on-time line"):
        parse_on_time(lines_of(LINE, bad), mode="strict").collect()


def test_strict_passes_good_lines(lines_of):
    assert parse_on_time(lines_of(LINE), mode="strict").count() == 1


def test_unknown_mode(lines_of):
    with pytest.raises(ValueError):
        parse_on_time(lines_of(LINE), mode="lenient")


def test_a_line_is_bad_only_for_the_columns_read(lines_of):
    lines = lines_of(LINE, SHORT, BAD_DELAY, BAD_DATE)
    assert parse_on_time(lines, ["weekday", "arr_delayed"]).count() == 3
    assert parse_on_time(lines, ["weekday"]).count() == 4


def test_spaces_at_the_end_are_no_fields(lines_of):
    eleven = LINE.rsplit(" ", 1)[0]
    assert rejects(lines_of(eleven + "   ")).first().reason == "missing arr_delayed"
    assert parse_on_time(lines_of(LINE + "  ")).count() == 1


def test_empty_field_in_the_middle_shifts_as_given(lines_of):
    row = parse_on_time(lines_of("2008-01-03  WN"), ["weekday", "carrier_id"]).first()
    assert tuple(row) == ("", "WN")


def test_lines_give_the_flights_back(flights):
    back = parse_on_time(on_time_lines(flights))
    assert rows(back) == rows(flights)


def test_every_line_is_parsed_or_rejected(lineitem):
    lines = damaged_lines(lineitem)
    assert parse_on_time(lines).count() + rejects(lines).count() == lineitem.count()
    assert rejects(lines).select("reason").distinct().count() == 4


@pytest.mark.parametrize("columns", [FIELDS, ("weekday", "arr_delayed")])
def test_line_is_split_once(lines_of, columns):
    plan = parse_on_time(lines_of(LINE), columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


@pytest.mark.parametrize(
    "line, tokens", [("A  B ", ["A", "B"]), ("", []), ("  ", []), ("ATL", ["ATL"]), ("A A", ["A", "A"])]
)
def test_tokens(lines_of, line, tokens):
    assert [r.airport for r in airport_tokens(lines_of(line)).collect()] == tokens


def whole(text):
    return int(float(text))


def day(text):
    if not re.fullmatch("[0-9]{4}-[0-9]{2}-[0-9]{2}", text):
        raise ValueError(text)
    return datetime.date.fromisoformat(text)


def hhmm(text):
    int(text)
    return text


READERS = (day, str, str, str, str, str, str, hhmm, whole, str, whole, whole)


def parse_by_hand(line):
    """The twelve fields, or the name of the first field at fault."""
    fields, typed = line.rstrip(" ").split(" "), []
    for column, read in enumerate(READERS):
        if column >= len(fields):
            return f"missing {FIELDS[column]}"
        try:
            typed.append(read(fields[column]))
        except ValueError:
            return f"unreadable {FIELDS[column]}"
    return tuple(typed)


@st.composite
def any_line(draw):
    fields = LINE.split(" ")
    for _ in range(draw(st.integers(0, 2))):
        at = draw(st.integers(0, 11))
        fields[at] = draw(
            st.sampled_from(["", "x", "2008-02-30", "2008-2-03", "1e1", "-16.9", "16.", ".5", "0600", "-5", "1,0"])
        )
    fields = fields[: draw(st.integers(8, 14))] + draw(st.lists(st.just("extra"), max_size=1))
    return " ".join(fields) + " " * draw(st.integers(0, 2))


@settings(max_examples=20, deadline=None)
@given(st.lists(any_line(), min_size=1, max_size=30))
def test_lines_are_parsed_as_by_hand(spark, lines):
    expected = [(line, parse_by_hand(line)) for line in lines]
    df = spark.createDataFrame([(line,) for line in lines], "value STRING")
    good = sorted((found for _, found in expected if isinstance(found, tuple)), key=repr)
    bad = sorted((found, line) for line, found in expected if isinstance(found, str))
    assert rows(parse_on_time(df), *FIELDS) == good
    assert rows(rejects(df)) == sorted(bad, key=repr)
