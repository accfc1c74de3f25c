"""The flight record and the serving tables with their keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Positions in a space-separated `on-time` line (fixed values).
ON_TIME = T.StructType(
    [
        T.StructField("flight_date", T.DateType()),
        T.StructField("weekday", T.StringType()),
        T.StructField("carrier_id", T.StringType()),
        T.StructField("carrier", T.StringType()),
        T.StructField("flight_num", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("dep_time", T.StringType()),
        T.StructField("dep_delayed", T.IntegerType()),
        T.StructField("arr_time", T.StringType()),
        T.StructField("arr_delay", T.IntegerType()),
        T.StructField("arr_delayed", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Table:
    """A serving table: its columns, primary key and what its rows are spread over files by.

    ``part`` names a further column that the folders go by, with its SQL over the key.
    ``ended`` is true of rows that only say that a key is gone; a merge drops them.
    """

    name: str
    columns: str
    key: tuple[str, ...]
    spread_by: tuple[str, ...]
    part: tuple[str, str] | None = None
    ended: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def values(self) -> list[str]:
        return [c for c in self.schema.names if c not in self.key]


# Names and keys of the serving tables (fixed values).
AIRPORT_TOP10 = Table("airport_top10", "airport STRING, n BIGINT, rank INT", ("airport",), ("airport",))
AIRPORT_COUNTS = Table(
    "airport_counts", "airport STRING, n BIGINT, seen_ms BIGINT", ("airport",), ("airport",), ended="n IS NULL"
)
WEEKDAY_RANK = Table(
    "weekday_rank", "weekday STRING, pct_delayed FLOAT, rank INT", ("weekday",), ("weekday",)
)
TOP10_DESTINATIONS = Table(
    "top10air",
    "rank INT, origin STRING, destination STRING, percentage_delayed INT",
    ("origin", "rank"),
    ("origin",),
)
TOP10_CARRIERS = Table(
    "xytop10carriers",
    "rank INT, origin STRING, destination STRING, carrier STRING, percentage_delayed INT",
    ("origin", "destination", "rank"),
    ("origin", "destination"),
)
MEAN_DELAY = Table(
    "xymeandelay",
    "origin STRING, destination STRING, mean_delay FLOAT",
    ("origin", "destination"),
    ("origin", "destination"),
)
BEST_FLIGHT = Table(
    "xyz",
    "departure_date STRING, period STRING, origin STRING, destination STRING,"
    " flight STRING, departure_time STRING, delay INT",
    ("departure_date", "period", "origin", "destination"),
    ("departure_date", "period", "origin", "destination"),
    ("month", "concat(substring(departure_date, 7), '-', substring(departure_date, 4, 2))"),
)

TABLES = {
    t.name: t
    for t in (
        AIRPORT_TOP10,
        AIRPORT_COUNTS,
        WEEKDAY_RANK,
        TOP10_DESTINATIONS,
        TOP10_CARRIERS,
        MEAN_DELAY,
        BEST_FLIGHT,
    )
}
