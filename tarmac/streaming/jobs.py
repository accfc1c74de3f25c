"""The six questions as running queries over lines from files or Kafka."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from tarmac.operators.aggregate import TRIP
from tarmac.operators.parse import FIELDS, parse_on_time, rejects
from tarmac.plans.questions import QUESTIONS, Question, Step
from tarmac.plans.shared import SHARED_TALLY, shared_answers, shared_columns, shared_tally
from tarmac.sinks.files import exists, read_changes, read_snapshot, write_base, write_changes, write_snapshot
from tarmac.streaming.counts import LineCounts
from tarmac.streaming.paths import RunPaths
from tarmac.streaming.state import state_settings

LIVE: Mapping[str, Any] = {"processingTime": "10 seconds"}
BACKFILL: Mapping[str, Any] = {"availableNow": True}

Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Job:
    """The query that keeps an answer, and the one that writes the lines it cannot read, if any.

    Structured Streaming has one output per query, so each reads the input for
    itself. ``lines`` counts the lines read and the bad ones in the first query's own
    read. What is not named here is the first query's.
    """

    query: StreamingQuery
    rejected: StreamingQuery | None = None
    lines: LineCounts | None = None

    def __getattr__(self, name: str) -> Any:
        return getattr(self.query, name)

    def _both(self) -> list[StreamingQuery]:
        return [q for q in (self.query, self.rejected) if q is not None]

    def awaitTermination(self) -> None:  # noqa: N802  as a query has it
        """Wait for the end; a job that its bad lines stopped raises ``BadLines``."""
        self.query.awaitTermination()
        if self.lines is not None and self.lines.over and self.rejected is not None:
            self.rejected.stop()
        for query in self._both():
            query.awaitTermination()
        if self.lines is not None:
            self.lines.settle(self.query)

    def stop(self) -> None:
        for query in self._both():
            query.stop()


def rejects_of(root: str) -> str:
    """Where the bad lines of a job lie that writes the table at ``root``."""
    return f"{root}_rejects"


def _file_sink(question: Question, root: str, seed: str | None) -> Sink:
    """Complete answers go to a snapshot table, touched keys to a change table."""
    write = write_snapshot if question.output_mode == "complete" else write_changes
    added = _seeded(question, seed)
    return lambda batch, batch_id: write(question.answer(added(batch)), root, question.table, batch_id)


def _started(
    writer: Any,
    lines: DataFrame,
    columns: Sequence[str],
    root: str,
    checkpoint: str,
    trigger: Mapping[str, Any],
    mode: str,
    counts: LineCounts | None = None,
) -> Job:
    query = writer.start()
    if counts is not None:
        counts.query = query
    if mode != "permissive" or not columns:
        return Job(query, None, counts)
    rejected = start_rejects(lines, rejects_of(root), rejects_of(checkpoint), columns, trigger=trigger)
    return Job(query, rejected, counts)


def _seeded(question: Question, seed: str | None) -> Step:
    """The tallies of a batch with those of a seed added."""
    if seed is None:
        return lambda batch: batch

    def added(batch: DataFrame) -> DataFrame:
        known = batch.sparkSession.read.schema(batch.schema).parquet(seed)
        if question.output_mode != "complete":  # of touched keys
            known = known.join(batch.select(*TRIP), list(TRIP), "left_semi")
        return question.combined(batch.unionByName(known))

    return added


def start_question(
    question: Question,
    lines: DataFrame,
    root: str,
    checkpoint: str,
    *,
    trigger: Mapping[str, Any] = LIVE,
    mode: str = "permissive",
    state_partitions: int | None = None,
    sink: Sink | None = None,
    output_mode: str | None = None,
    most_bad: float | None = None,
    seed: str | None = None,
) -> Job:
    """Keep a question's serving table under ``root`` up to date with a stream of lines.

    Lines that the question cannot read go to the Parquet folder ``rejects_of(root)``
    with their reasons, unless the mode is ``strict``, which fails on one, or ``counted``,
    which only counts them. ``most_bad`` is the share of bad lines above which the job
    stops. A restart on the same checkpoint goes on where it stopped. ``sink`` replaces
    the file table; it gets each batch's tally and batch number, and must do the same
    again if a batch is replayed.

    ``seed`` is a tally that another job has left (``save_tally``): the answer is over
    the lines of both. It stays with the job, so give it again on a restart.
    """
    if seed is not None and sink is not None:
        raise ValueError("a seed goes with the file table")
    spark = lines.sparkSession
    counts = LineCounts(spark, most_bad) if question.columns else None
    reading = "permissive" if mode == "counted" else mode
    tally = question.tally(question.records(lines, reading, counts.name if counts else None))
    if seed is not None and question.output_mode != "complete" and not exists(spark, f"{root}/batch_id=0"):
        first = spark.read.schema(tally.schema).parquet(seed)
        write_base(question.answer(first), root, question.table)
    writer = (
        tally.writeStream.outputMode(output_mode or question.output_mode)
        .foreachBatch(sink or _file_sink(question, root, seed))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    with state_settings(spark, state_partitions):
        return _started(writer, lines, question.columns, root, checkpoint, trigger, mode, counts)


def start_shared(
    lines: DataFrame,
    paths: RunPaths,
    *,
    trigger: Mapping[str, Any] = LIVE,
    mode: str = "permissive",
    state_partitions: int | None = None,
) -> Job:
    """Keep the tables of the four summing questions up to date, reading the lines once.

    Each batch writes the shared tally first and draws the answers from what was
    written, so the batch itself runs once. Bad lines lie next to the shared tally.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, root = batch.sparkSession, paths.table(SHARED_TALLY.name)
        write_snapshot(batch, root, SHARED_TALLY, batch_id)
        tally = read_snapshot(spark, root, SHARED_TALLY)
        for name, answer in shared_answers(tally).items():
            table = QUESTIONS[name].table
            write_snapshot(answer, paths.table(table.name), table, batch_id)

    tally = shared_tally(parse_on_time(lines, shared_columns(), mode))
    writer = (
        tally.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", paths.checkpoint(SHARED_TALLY.name))
        .trigger(**trigger)
    )
    root, checkpoint = paths.table(SHARED_TALLY.name), paths.checkpoint(SHARED_TALLY.name)
    with state_settings(lines.sparkSession, state_partitions):
        return _started(writer, lines, shared_columns(), root, checkpoint, trigger, mode)


def first_ten(question: Question, answer: DataFrame) -> DataFrame:
    """What the console shows of an answer: by rank if only the whole is ranked, else by key."""
    key = question.table.key
    ranked = "rank" in answer.columns and "rank" not in key
    return answer.orderBy(*["rank"] * ranked, *key).limit(10)


def start_console(
    question: Question,
    lines: DataFrame,
    root: str,
    checkpoint: str,
    *,
    trigger: Mapping[str, Any] = LIVE,
    mode: str = "permissive",
    state_partitions: int | None = None,
) -> Job:
    """Print the first ten rows of the answer after each batch.

    The rows are ordered first, so that all state partitions run and are committed.
    No table is written at ``root``; bad lines lie at ``rejects_of(root)``.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        first_ten(question, question.answer(batch)).show(10, truncate=False)

    return start_question(
        question,
        lines,
        root,
        checkpoint,
        trigger=trigger,
        mode=mode,
        state_partitions=state_partitions,
        sink=show,
    )


def start_rejects(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    columns: Sequence[str] = FIELDS,
    *,
    trigger: Mapping[str, Any] = LIVE,
) -> StreamingQuery:
    """Append ``on-time`` lines on which one of the columns is bad, and the reasons, to a Parquet folder.

    Spark's file sink notes the files of each batch, so a replay adds no line twice.
    """
    writer = rejects(lines, columns).writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)


def read_answer(spark: SparkSession, question: Question, root: str, *, parts: bool = False) -> DataFrame:
    """The question's serving table as it stands, with its part column if asked for."""
    if question.output_mode == "complete":
        return read_snapshot(spark, root, question.table)
    return read_changes(spark, root, question.table, parts=parts)
