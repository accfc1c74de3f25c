"""Lookups on the serving tables, and two-leg trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.schema import BEST_FLIGHT

MONTH = BEST_FLIGHT.part[0]


def destinations_of(top10air: DataFrame, *origins: str) -> DataFrame:
    """Ranked destinations of the given origins."""
    return top10air.filter(F.col("origin").isin(*origins)).orderBy("origin", "rank")


def _pair(table: DataFrame, origin: str, destination: str) -> DataFrame:
    return table.filter((F.col("origin") == origin) & (F.col("destination") == destination))


def carriers_of_pair(xytop10carriers: DataFrame, origin: str, destination: str) -> DataFrame:
    """Ranked carriers from origin to destination."""
    return _pair(xytop10carriers, origin, destination).orderBy("rank")


def mean_delay_of_pair(xymeandelay: DataFrame, origin: str, destination: str) -> DataFrame:
    return _pair(xymeandelay, origin, destination)


def best_flight_on(
    xyz: DataFrame, departure_date: str, period: str, origin: str, destination: str
) -> DataFrame:
    """Best flight of a day (``dd/MM/yyyy``) and half-day (``AM`` or ``PM``).

    With the month column, no other month is read.
    """
    day = (F.col("departure_date") == departure_date) & (F.col("period") == period)
    if MONTH in xyz.columns:
        day &= F.col(MONTH) == f"{departure_date[6:]}-{departure_date[3:5]}"
    return _pair(xyz.filter(day), origin, destination)


def two_leg_trips(xyz: DataFrame, requests: DataFrame) -> DataFrame:
    """Both legs of the trips asked for: X to Y before noon, Y to Z after noon two days later.

    ``requests`` has ``flight_date DATE, origin, via, destination``. Each leg is
    looked up by the full key of ``xyz``, as two lookups by hand would, so a
    request meets at most one row per leg and a hub airport does not multiply
    rows. Equal requests are answered once; that also bounds the requests that
    share a first leg by the number of airports, however popular the trip.
    Requests without a flight on both legs are left out.

    With the month column, each leg is first cut to the months asked for, while the
    query runs: they are few and broadcast, and Spark leaves out the folders of all others.
    """
    # Spark prunes by a side that it takes for selective, which a comparison tells it.
    # Days before are no days of the table.
    asked = requests.filter("flight_date >= DATE'0001-01-01'").distinct()

    def day(offset: int, pattern: str = "dd/MM/yyyy") -> Column:
        return F.date_format(F.date_add("flight_date", offset), pattern)

    def leg(number: int, period: str, start: str, end: str, offset: int) -> DataFrame:
        rows = xyz.filter(F.col("period") == period)
        if MONTH in xyz.columns:
            months = asked.select(day(offset, "yyyy-MM").alias(MONTH)).distinct()
            rows = rows.join(F.broadcast(months), MONTH, "left_semi")
        return rows.select(
            F.col("departure_date").alias(f"date{number}"),
            F.col("origin").alias(start),
            F.col("destination").alias(end),
            *[F.col(c).alias(f"{c}{number}") for c in ("flight", "departure_time", "delay")],
        )

    wanted = asked.select(day(0).alias("date1"), day(2).alias("date2"), "origin", "via", "destination")
    return wanted.join(leg(1, "AM", "origin", "via", 0), ["date1", "origin", "via"]).join(
        leg(2, "PM", "via", "destination", 2), ["date2", "via", "destination"]
    )
