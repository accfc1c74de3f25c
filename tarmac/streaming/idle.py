"""Airport counts that forget an airport after a time without input.

Each airport has its count, and when it was last seen, as a value of keyed state with a
timer. A batch reads and writes the airports it touches and no others: they go to a
change table. Where the timer of an airport goes off and nothing was seen since, its state is
cleared and a row without a count, a tombstone, ends it in the table; otherwise the timer
is set again. An airport that comes back counts from 0, timer or not. Readers leave out
tombstones, and airports whose time is over before their timer could tell.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from tarmac.operators.parse import airport_tokens
from tarmac.plans.questions import QUESTIONS
from tarmac.schema import AIRPORT_COUNTS
from tarmac.sinks.files import read_changes, write_changes
from tarmac.streaming.jobs import LIVE
from tarmac.streaming.state import state_settings

IDLE_MS = 60 * 60 * 1000

Clock = Callable[[], float]


def batch_time() -> Column:
    """The milliseconds at which a batch starts."""
    return F.unix_millis(F.current_timestamp())


class IdleCounts(StatefulProcessor):
    """The running count of one airport."""

    def __init__(self, idle_ms: int) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # The count, when it was last seen, and that time by the clock of the timers.
        self.state = handle.getValueState("count", "n BIGINT, seen_ms BIGINT, touched_ms BIGINT")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        fresh = [(int(part["n"].sum()), int(part["seen_ms"].max())) for part in rows]
        n, seen = sum(n for n, _ in fresh), max(at for _, at in fresh)
        known, now = self.state.get(), timerValues.getCurrentProcessingTimeInMs()
        if known is None:
            self.handle.registerTimer(now + self.idle_ms)
        elif known[1] > seen - self.idle_ms:
            n += known[0]
        self.state.update((n, seen, now))
        yield pd.DataFrame({"airport": [key[0]], "n": pd.array([n], "Int64"), "seen_ms": [seen]})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known, now = self.state.get(), timerValues.getCurrentProcessingTimeInMs()
        if known is None:
            return
        if known[2] > now - self.idle_ms:
            self.handle.registerTimer(known[2] + self.idle_ms)
            return
        self.state.clear()
        yield pd.DataFrame({"airport": [key[0]], "n": pd.array([None], "Int64"), "seen_ms": [known[1]]})

    def close(self) -> None:
        pass


def _partial_counts(tokens: DataFrame) -> DataFrame:
    """Tokens counted within each Arrow batch, so that a busy airport is shuffled as few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pc.value_counts(batch.column("airport"))
            columns = [found.field("values"), found.field("counts").cast(pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["airport", "n"])

    return tokens.select("airport").mapInArrow(run, "airport STRING, n BIGINT")


def start_idle_counts(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    *,
    idle_ms: int = IDLE_MS,
    trigger: Mapping[str, Any] = LIVE,
    state_partitions: int | None = None,
    now: Column | None = None,
) -> StreamingQuery:
    """Keep the change table ``airport_counts`` under ``root`` up to date.

    A batch that is replayed starts from the state before it and writes the same rows
    again. ``now`` gives the milliseconds at which a line counts as seen, by default
    those of its batch.
    """
    seen = _partial_counts(airport_tokens(lines)).withColumn("seen_ms", batch_time() if now is None else now)
    counts = seen.groupBy("airport").transformWithStateInPandas(
        IdleCounts(idle_ms), AIRPORT_COUNTS.columns, "Update", "ProcessingTime"
    )
    write = lambda batch, batch_id: write_changes(batch, root, AIRPORT_COUNTS, batch_id)
    writer = counts.writeStream.outputMode("update").foreachBatch(write)
    with state_settings(lines.sparkSession, state_partitions):
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_airport_counts(
    spark: SparkSession, root: str, *, idle_ms: int = IDLE_MS, clock: Clock = time.time
) -> DataFrame:
    """Counts of the airports that are not idle."""
    counts = read_changes(spark, root, AIRPORT_COUNTS).filter("n IS NOT NULL")
    return counts.filter(F.col("seen_ms") > int(clock() * 1000) - idle_ms)


def read_top_airports(
    spark: SparkSession, root: str, *, idle_ms: int = IDLE_MS, clock: Clock = time.time
) -> DataFrame:
    """The ten busiest airports that are not idle."""
    return QUESTIONS["airport_top10"].answer(read_airport_counts(spark, root, idle_ms=idle_ms, clock=clock))
