"""The six questions, each a tally that also runs on a stream and an answer drawn from it.

``tally`` is one aggregate over the records; Structured Streaming keeps it
running. ``answer`` ranks or reshapes the tally, which is small next to the
records, as a table (a stream does it per micro-batch).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac import schema
from tarmac.functions import mean32, pct32, pct32_int
from tarmac.operators.aggregate import airport_counts, best_flight, delay_tally, least
from tarmac.operators.parse import airport_tokens, parse_on_time, readable
from tarmac.operators.rank import first_k, ranked, top_k_per_group
from tarmac.sources.kafka import ON_TIME_TOPIC, ORIGIN_DESTINATION_TOPIC

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Question:
    name: str
    topic: str
    columns: tuple[str, ...]  # of a flight; none for a question on airport tokens
    tally: Step
    answer: Step
    table: schema.Table
    output_mode: str = "complete"

    def records(self, lines: DataFrame, mode: str = "permissive", observe: str | None = None) -> DataFrame:
        """What the tally reads, from text lines; ``observe`` as for ``parse_on_time``."""
        if not self.columns:
            return airport_tokens(lines)
        return parse_on_time(lines, self.columns, mode, observe)

    def combined(self, tallies: DataFrame) -> DataFrame:
        """One tally of several, put one below the other."""
        *keys, last = tallies.columns
        if self.columns and last == "n":
            keys.remove("total")
            return tallies.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        if last == "n":
            return tallies.groupBy(*keys).agg(F.sum("n").alias("n"))
        return least(tallies)

    def on_records(self, records: DataFrame) -> DataFrame:
        """The answer from airport tokens or typed flights (a table, not a stream).

        A row that lacks a field the question reads is no record, as with lines.
        """
        whole = readable(records, self.columns) if self.columns else records.filter("airport <> ''")
        return self.answer(self.tally(whole))

    def on_lines(self, lines: DataFrame, mode: str = "permissive") -> DataFrame:
        """The answer from text lines (a table, not a stream)."""
        return self.answer(self.tally(self.records(lines, mode)))


def _airports(counts: DataFrame) -> DataFrame:
    return first_k(counts.select("airport", "n"), [F.desc("n"), "airport"])


def _weekdays(tally: DataFrame) -> DataFrame:
    percent = tally.select("weekday", pct32(F.col("total"), F.col("n")).alias("pct_delayed"))
    return ranked(percent, ["pct_delayed", "weekday"])


def _delayed_percent(tally: DataFrame, *keys: str) -> DataFrame:
    return tally.select(*keys, pct32_int(F.col("total"), F.col("n")).alias("percentage_delayed"))


def _destinations(tally: DataFrame) -> DataFrame:
    percent = _delayed_percent(tally, "origin", "destination")
    ranked = top_k_per_group(percent, ["origin"], ["percentage_delayed", "destination"])
    return ranked.select(*schema.TOP10_DESTINATIONS.schema.names)


def _carriers(tally: DataFrame) -> DataFrame:
    percent = _delayed_percent(tally, "origin", "destination", "carrier")
    ranked = top_k_per_group(percent, ["origin", "destination"], ["percentage_delayed", "carrier"])
    return ranked.select(*schema.TOP10_CARRIERS.schema.names)


def _mean_delays(tally: DataFrame) -> DataFrame:
    mean = mean32(F.col("total"), F.col("n"))
    return tally.select("origin", "destination", mean.alias("mean_delay"))


def _best_flights(best: DataFrame) -> DataFrame:
    return best.select(
        F.date_format("flight_date", "dd/MM/yyyy").alias("departure_date"),
        "period",
        "origin",
        "destination",
        "flight",
        F.col("dep_time").alias("departure_time"),
        F.col("arr_delay").alias("delay"),
    )


def _tally(keys: tuple[str, ...], measure: str) -> Step:
    return lambda flights: delay_tally(flights, keys, measure)


def _delay_question(
    name: str,
    keys: tuple[str, ...],
    measure: str,
    answer: Step,
    table: schema.Table,
) -> Question:
    return Question(
        name,
        ON_TIME_TOPIC,
        (*keys, measure),
        _tally(keys, measure),
        answer,
        table,
    )


PAIR = ("origin", "destination")

QUESTIONS = {
    q.name: q
    for q in (
        Question(
            "airport_top10",
            ORIGIN_DESTINATION_TOPIC,
            (),
            airport_counts,
            _airports,
            schema.AIRPORT_TOP10,
        ),
        _delay_question("weekday_rank", ("weekday",), "arr_delayed", _weekdays, schema.WEEKDAY_RANK),
        _delay_question(
            "origin_top10_destinations", PAIR, "dep_delayed", _destinations, schema.TOP10_DESTINATIONS
        ),
        _delay_question(
            "pair_top10_carriers", (*PAIR, "carrier"), "arr_delayed", _carriers, schema.TOP10_CARRIERS
        ),
        _delay_question("pair_mean_delay", PAIR, "arr_delay", _mean_delays, schema.MEAN_DELAY),
        Question(
            "best_flight",
            ON_TIME_TOPIC,
            ("flight_date", "origin", "destination", "carrier", "flight_num", "dep_time", "arr_delay"),
            best_flight,
            _best_flights,
            schema.BEST_FLIGHT,
            "update",
        ),
    )
}
