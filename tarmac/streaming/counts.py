"""How many lines a running job has read and could not use, counted in the same read."""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery


class BadLines(RuntimeError):
    """A job was stopped by its share of bad lines."""


@dataclass
class LineCounts(StreamingQueryListener):
    """Lines read and lines good in each batch of one query, by the metrics that it observes.

    Above ``most_bad``, a share of all lines read so far, the query is stopped.
    """

    spark: SparkSession
    most_bad: float | None = None
    name: str = field(default_factory=lambda: f"lines_{uuid.uuid4().hex}")
    batches: dict[int, tuple[int, int]] = field(default_factory=dict)
    over: bool = False
    query: StreamingQuery | None = None

    def __post_init__(self) -> None:
        self.ended, self.ids = threading.Event(), set()
        self.spark.streams.addListener(self)

    @property
    def read(self) -> int:
        return sum(read for read, _ in self.batches.values())

    @property
    def bad(self) -> int:
        return sum(read - good for read, good in self.batches.values())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        found = event.progress.observedMetrics.get(self.name)
        if found is None:
            return
        self.ids.add(event.progress.runId)
        self.batches[event.progress.batchId] = (found["n_read"], found["n_good"])
        if self.most_bad is not None and self.bad > self.most_bad * self.read and not self.over:
            self.over = True
            # Not here: the query may wait for its listeners.
            threading.Thread(target=self._stop, args=(str(event.progress.id),), daemon=True).start()

    def _stop(self, query_id: str) -> None:
        query = self.spark.streams.get(query_id)
        if query is not None:
            query.stop()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if self.query is not None and str(event.runId) == str(self.query.runId):
            self.ended.set()

    def settle(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Wait for what listeners are told of a query that has ended, and listen no more."""
        end_seen = self.ended.wait(seconds)
        if end_seen:
            self.spark.streams.removeListener(self)
        if self.over:
            raise BadLines(f"{self.bad} of {self.read} lines are bad, more than {self.most_bad:.1%}")
