"""One pass over the flights for the four questions that only sum and count.

Weekday ranking, best destinations, best carriers and mean delays all follow
from one tally by weekday, origin, destination and carrier, so a backfill reads
its records once instead of four times. Sums are whole numbers, so the answers
are exactly those of four separate passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.parse import readable
from tarmac.plans.questions import QUESTIONS
from tarmac.schema import Table

SHARED_KEYS = ("weekday", "origin", "destination", "carrier")
MEASURES = ("dep_delayed", "arr_delay", "arr_delayed")
SHARED_TALLY = Table(
    "shared_tally",
    "weekday STRING, origin STRING, destination STRING, carrier STRING,"
    " dep_delayed BIGINT, arr_delay BIGINT, arr_delayed BIGINT, n BIGINT",
    SHARED_KEYS,
    ("origin", "destination"),
)
SHARED_QUESTIONS = (
    "weekday_rank",
    "origin_top10_destinations",
    "pair_top10_carriers",
    "pair_mean_delay",
)


def shared_columns() -> tuple[str, ...]:
    return (*SHARED_KEYS, *MEASURES)


def shared_tally(flights: DataFrame) -> DataFrame:
    """Sums and counts of the flights that have all shared columns, as ``parse_on_time`` leaves them."""
    return readable(flights, shared_columns()).groupBy(*SHARED_KEYS).agg(
        *[F.sum(m).alias(m) for m in MEASURES], F.count(F.lit(1)).alias("n")
    )


def shared_answers(tally: DataFrame) -> dict[str, DataFrame]:
    """Answers by question name. Pass a tally read from a written table, as each answer reads it."""
    answers = {}
    for name in SHARED_QUESTIONS:
        question = QUESTIONS[name]
        *keys, measure = question.columns
        rolled = tally.groupBy(*keys).agg(F.sum(measure).alias("total"), F.sum("n").alias("n"))
        answers[name] = question.answer(rolled)
    return answers
