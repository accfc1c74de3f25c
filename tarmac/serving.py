"""Serving tables by name, for lookups in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.plans.questions import QUESTIONS, Question
from tarmac.sinks.files import exists, next_batch, write_changes, write_snapshot
from tarmac.streaming.jobs import read_answer
from tarmac.streaming.paths import RunPaths


def publish(question: Question, records: DataFrame, paths: RunPaths) -> str:
    """Answer a question from a table of records into its serving table; gives the table's root.

    It may be done again: the answer is written above all earlier ones. A table
    that a stream writes is refused, as the stream numbers its batches itself.
    """
    spark, root = records.sparkSession, paths.table(question.table.name)
    if exists(spark, paths.checkpoint(question.name)):
        raise ValueError(f"a stream writes {root}; publish into another run")
    write = write_snapshot if question.output_mode == "complete" else write_changes
    write(question.on_records(records), root, question.table, next_batch(spark, root))
    return root


def register_views(spark: SparkSession, paths: RunPaths) -> None:
    """A temporary view per serving table, as it stands now.

    ``SELECT * FROM xymeandelay WHERE origin = 'LGA' AND destination = 'BOS'``
    then works as is; ``xyz`` has its ``month`` too. Register again to see later batches. A run that does not
    exist raises; a table it has not written yet is empty.
    """
    if not exists(spark, paths.root):
        raise FileNotFoundError(paths.root)
    for question in QUESTIONS.values():
        name = question.table.name
        read_answer(spark, question, paths.table(name), parts=True).createOrReplaceTempView(name)
