"""Counts, delay tallies and the least delayed flight, for tables and streams alike.

All aggregates combine on the map side, so a key holding a large part of the
rows reaches its reducer as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import half_day

TRIP = ("flight_date", "period", "origin", "destination")


def airport_counts(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("airport").agg(F.count(F.lit(1)).alias("n"))


def delay_tally(flights: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """``total`` of the measure and the number of flights ``n`` per key."""
    return flights.groupBy(*keys).agg(
        F.sum(measure).alias("total"), F.count(F.lit(1)).alias("n")
    )


def best_flight(flights: DataFrame) -> DataFrame:
    """The flight of least arrival delay per date, half-day, origin and destination.

    Ties go to the earlier departure time, then to the flight's name. A stream
    keeps the least (delay, time, flight) of a key as its state; a table takes
    the route of ``_least_by_code``, which gives the same rows.
    """
    rows = flights.select(
        "flight_date",
        half_day(F.col("dep_time")).alias("period"),
        "origin",
        "destination",
        "carrier",
        "flight_num",
        "dep_time",
        "arr_delay",
    )
    return _least_by_text(rows) if flights.isStreaming else _least_by_code(rows)


FLIGHT = "concat_ws(' ', carrier, flight_num)"


def _least_by_text(rows: DataFrame) -> DataFrame:
    return least(rows.selectExpr(*TRIP, "arr_delay", "dep_time", f"{FLIGHT} AS flight"))


def least(rows: DataFrame) -> DataFrame:
    """The least (delay, time, flight) per trip."""
    first = F.min(F.struct("arr_delay", "dep_time", "flight")).alias("first")
    return rows.groupBy(*TRIP).agg(first).select(*TRIP, "first.*")


# The digits of a flight code, highest first: delay, time (0000 to 2499), two
# characters (ASCII 48 to 90, less 32), flight number padded to seven digits,
# its length. Their product is below 2 ** 63.
DELAY_LOW, DELAY_HIGH = -1024, 7167
TIMES, LETTERS, NUMBERS, LENGTHS = 2_500, 64, 10_000_000, 8
FIRST_LETTER = 32

USUAL = f"""
    coalesce(
      arr_delay BETWEEN {DELAY_LOW} AND {DELAY_HIGH}
        AND dep_time RLIKE '^([01][0-9]|2[0-4])[0-9]{{2}}$'
        AND carrier RLIKE '^[0-9A-Z]{{2}}$'
        AND flight_num RLIKE '^[0-9]{{1,7}}$',
      false)
"""
# Text order of digit strings is by the digits padded on the right, then by length.
CODE = f"""
    (((((arr_delay - {DELAY_LOW}) * {TIMES}L + try_cast(dep_time AS BIGINT)) * {LETTERS}
      + ascii(carrier) - {FIRST_LETTER}) * {LETTERS}
      + ascii(substring(carrier, 2, 1)) - {FIRST_LETTER}) * {NUMBERS}
      + try_cast(rpad(flight_num, 7, '0') AS BIGINT)) * {LENGTHS}
      + length(flight_num)
"""


def _least_by_code(rows: DataFrame) -> DataFrame:
    """Least flight of a table without sorting it.

    ``min`` over a struct holding strings makes Spark sort all input of every
    task. Flights of the usual form (four-digit time, two-character carrier,
    number of one to seven digits) are therefore coded as one BIGINT that orders
    as (delay, time, flight) does, and hash-aggregated. Any other flight keeps
    its own text as an extra key, so none is lost. The few rows left, one per
    trip when all are of the usual form, go through the struct.
    """
    coded = rows.selectExpr("*", f"{USUAL} AS usual").selectExpr(
        *TRIP,
        f"CASE WHEN usual THEN {CODE} ELSE arr_delay END AS code",
        f"CASE WHEN NOT usual THEN struct(dep_time, {FLIGHT} AS flight) END AS unusual",
    )
    codes = coded.groupBy(*TRIP, "unusual").agg(F.min("code").alias("code"))
    return least(_decoded(codes))


def _decoded(codes: DataFrame) -> DataFrame:
    second = LENGTHS * NUMBERS
    first = second * LETTERS
    time = first * LETTERS
    delay = time * TIMES
    flight = f"""
        concat(
          char(code DIV {first} % {LETTERS} + {FIRST_LETTER}),
          char(code DIV {second} % {LETTERS} + {FIRST_LETTER}),
          ' ',
          left(lpad(CAST(code DIV {LENGTHS} % {NUMBERS} AS STRING), 7, '0'), CAST(code % {LENGTHS} AS INT)))
    """
    return codes.selectExpr(
        *TRIP,
        f"CAST(if(unusual IS NULL, code DIV {delay} + {DELAY_LOW}, code) AS INT) AS arr_delay",
        f"""if(unusual IS NULL, lpad(CAST(code DIV {time} % {TIMES} AS STRING), 4, '0'), unusual.dep_time)
            AS dep_time""",
        f"if(unusual IS NULL, {flight}, unusual.flight) AS flight",
    )
