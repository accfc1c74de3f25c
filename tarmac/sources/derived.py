"""Flights and record lines derived from the TPC-H-like test tables.

Those tables hold no flights. Every ``lineitem`` row becomes one flight, by the
rules of FIXTURES.md section 3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.schema import ON_TIME

# Fixed values.
AIRPORTS = tuple("ATL BOS CLT DEN DFW DTW IAH JFK LAX LGA MSP ORD PHX SEA STL".split())
CARRIERS = tuple("AA AS B6 CO DL EV FL MQ NW OH OO UA US WN".split())
WEEKDAYS = tuple("Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split())


def _pick(names: tuple[str, ...], index: str) -> str:
    return f"element_at(split('{' '.join(names)}', ' '), CAST({index} + 1 AS INT))"


DATE = "date_add(DATE'2008-01-01', CAST(l_orderkey % 60 AS INT))"
CARRIER = _pick(CARRIERS, "l_partkey DIV 14 % 14")
TIME = """
    lpad(CAST((l_orderkey * 7 + l_linenumber * 5) % 24 * 100 + l_partkey % 60 AS STRING), 4, '0')
"""


def flights_of(lineitem: DataFrame, *keep: str) -> DataFrame:
    """Typed flights (``ON_TIME``), one per ``lineitem`` row, next to the columns to keep."""
    return lineitem.selectExpr(
        f"{DATE} AS flight_date",
        f"{_pick(WEEKDAYS, f'weekday({DATE})')} AS weekday",
        f"{CARRIER} AS carrier_id",
        f"{CARRIER} AS carrier",
        "CAST(l_orderkey % 9999 + 1 AS STRING) AS flight_num",
        f"{_pick(AIRPORTS, 'l_suppkey % 15')} AS origin",
        f"{_pick(AIRPORTS, '(l_suppkey % 15 + 1 + l_partkey % 14) % 15')} AS destination",
        f"{TIME} AS dep_time",
        "if(l_discount >= 0.08D, 1, 0) AS dep_delayed",
        f"{TIME} AS arr_time",
        "CAST(greatest(l_quantity - 20, 0D) AS INT) AS arr_delay",
        "if(l_quantity >= 35, 1, 0) AS arr_delayed",
        *keep,
    )


def on_time_lines(flights: DataFrame, *keep: str) -> DataFrame:
    """``on-time`` lines of typed flights, delay and arrival flag with two decimals."""
    fields = [
        F.concat(F.col(c).cast("string"), F.lit(".00"))
        if c in ("arr_delay", "arr_delayed")
        else F.col(c).cast("string")
        for c in ON_TIME.names
    ]
    return flights.select(F.concat_ws(" ", *fields).alias("value"), *keep)


def origin_destination_lines(flights: DataFrame) -> DataFrame:
    return flights.select(F.concat_ws(" ", "origin", "destination").alias("value"))


def damaged_lines(lineitem: DataFrame) -> DataFrame:
    """``on-time`` lines of all ``lineitem`` rows, broken in four ways by their tax.

    0.05: an unreadable delay; 0.06: a month without its leading zero; 0.07: the
    first five fields only; 0.08: nothing after the space that ends field eleven.
    """
    tax, value = F.round("l_tax", 2), F.col("value")
    broken = (
        F.when(tax == 0.05, F.regexp_replace(value, r" [0-9]+\.00 ", " x "))
        .when(tax == 0.06, F.regexp_replace(value, "^2008-0", "2008-"))
        .when(tax == 0.07, F.substring_index(value, " ", 5))
        .when(tax == 0.08, F.concat(F.substring_index(value, " ", 11), F.lit(" ")))
        .otherwise(value)
    )
    return on_time_lines(flights_of(lineitem, "l_tax"), "l_tax").select(broken.alias("value"))


def trip_requests(orders: DataFrame) -> DataFrame:
    """One two-leg trip wish per ``orders`` row: origin, via, destination, date of leg one."""
    start = "o_custkey % 15"
    via = f"({start} + 1 + o_orderkey % 14) % 15"
    end = f"({via} + 1 + o_orderkey DIV 14 % 14) % 15"
    return orders.selectExpr(
        "date_add(DATE'2008-01-01', CAST(o_orderkey % 60 AS INT)) AS flight_date",
        f"{_pick(AIRPORTS, start)} AS origin",
        f"{_pick(AIRPORTS, via)} AS via",
        f"{_pick(AIRPORTS, end)} AS destination",
    )
