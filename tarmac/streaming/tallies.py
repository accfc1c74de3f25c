"""A question's running tally: read from a stream's state, ranked anew group by group, or started from another.

A job's state is the whole tally as of its last batch, whether the job writes it
anywhere or not. ``read_tally`` reads it from the checkpoint while the job runs.

``start_maintained`` keeps the ranked tables without writing every answer in every batch:
the stream gives the tallies that a batch changed, these are upserted, and only the
groups they belong to are ranked and upserted in turn.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tarmac.plans.questions import QUESTIONS, Question
from tarmac.schema import Table
from tarmac.sinks.files import merge_changes, read_changes, write_changes
from tarmac.streaming.jobs import LIVE, Job, start_question
from tarmac.streaming.paths import RunPaths
from tarmac.streaming.state import state_settings

#: Questions whose answer falls into groups of keys, and what groups them.
GROUPS = {
    name: QUESTIONS[name].table.spread_by
    for name in ("origin_top10_destinations", "pair_top10_carriers", "pair_mean_delay")
}
#: Batches after which a maintained table is folded.
FOLD_EVERY = 50


def start_tally(
    question: Question,
    lines: DataFrame,
    checkpoint: str,
    *,
    trigger: Mapping[str, Any] = LIVE,
    mode: str = "permissive",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep a question's tally as state and write it nowhere else."""
    writer = question.tally(question.records(lines, mode)).writeStream.outputMode("update").format("noop")
    with state_settings(lines.sparkSession, state_partitions):
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_tally(
    spark: SparkSession, question: Question, checkpoint: str, *, batch_id: int | None = None
) -> DataFrame:
    """The tally that a stream of the question holds, as of a batch (by default its last).

    ``question.answer`` makes the answer of it. Earlier batches can be read as long as
    Spark keeps their state (``spark.sql.streaming.minBatchesToRetain``).
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    keys, values = (state.schema[side].dataType.names for side in ("key", "value"))
    first = state.schema["value"].dataType[0]
    if isinstance(first.dataType, T.StructType):  # a least row
        return state.select("key.*", f"value.{first.name}.*")
    renamed = ["n"] if len(values) == 1 else ["total", "n"]  # as the tallies have them
    return state.select("key.*", "value.*").toDF(*keys, *renamed)


def save_tally(spark: SparkSession, question: Question, checkpoint: str, path: str) -> None:
    """Write the tally of a finished job, for ``start_question(seed=path)`` to go on from.

    The new job has a checkpoint of its own, so it may have another number of state partitions.
    """
    read_tally(spark, question, checkpoint).write.parquet(path)


def tally_table(question: Question) -> Table:
    """The change table of the tallies behind a maintained answer."""
    *keys, _ = question.columns
    columns = ", ".join([f"{k} STRING" for k in keys] + ["total BIGINT", "n BIGINT"])
    return Table(f"{question.table.name}_tally", columns, tuple(keys), GROUPS[question.name])


def start_maintained(question: Question, lines: DataFrame, paths: RunPaths, **options: Any) -> Job:
    """Keep an answer as a change table; a batch writes the groups whose tallies it changed.

    ``options`` are those of ``start_question``. Every ``FOLD_EVERY`` batches the tables are folded.
    """
    tallies, group = tally_table(question), list(GROUPS[question.name])
    below, root = paths.table(tallies.name), paths.table(question.table.name)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_changes(batch, below, tallies, batch_id)
        changed = spark.read.schema(tallies.schema).parquet(f"{below}/batch_id={batch_id}")
        touched = changed.select(*group).distinct()
        current = read_changes(spark, below, tallies).join(touched, group, "left_semi")
        write_changes(question.answer(current), root, question.table, batch_id)
        if batch_id % FOLD_EVERY == FOLD_EVERY - 1:
            merge_changes(spark, below, tallies)
            merge_changes(spark, root, question.table)

    checkpoint = paths.checkpoint(f"maintained_{question.name}")
    return start_question(question, lines, root, checkpoint, sink=write, output_mode="update", **options)


def read_maintained(spark: SparkSession, question: Question, paths: RunPaths) -> DataFrame:
    """The maintained answer as it stands."""
    return read_changes(spark, paths.table(question.table.name), question.table)
