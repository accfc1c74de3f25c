"""Command line of the jobs, for ``spark-submit run_job.py``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from tarmac.plans.questions import QUESTIONS
from tarmac.schema import AIRPORT_COUNTS, BEST_FLIGHT
from tarmac.sinks.external import write_cassandra
from tarmac.sinks.files import merge_changes
from tarmac.sources import kafka_lines, text_lines
from tarmac.sources.kafka import ON_TIME_TOPIC
from tarmac.streaming import (
    BACKFILL,
    Job,
    RunPaths,
    fresh_run,
    shared_folder,
    start_console,
    start_idle_counts,
    start_maintained,
    start_question,
    start_shared,
)
from tarmac.streaming.tallies import GROUPS


SHARED, MERGE = "shared", "merge"
# A live job's first batch would else be all there is. A backfill has no bound of its own.
LIVE_OFFSETS, LIVE_BYTES = 10_000_000, 4 * 2**30


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="run_job.py", description="Keep one question answered.")
    p.add_argument(
        "question",
        choices=[*QUESTIONS, SHARED, MERGE],
        help=f"{SHARED}: the four summing questions in one pass; {MERGE}: fold the change tables of --run",
    )
    source = p.add_mutually_exclusive_group()
    source.add_argument("--kafka", metavar="SERVERS", help="brokers holding the question's topic")
    source.add_argument("--files", metavar="PATH", help="folder or pattern of record files")
    p.add_argument("--name-glob", help="with --files: keep files by name")
    p.add_argument("--topic", help="another topic than the question's own")
    p.add_argument("--sink", choices=["console", "files", "cassandra"], default="files")
    p.add_argument("--keyspace", help="with --sink cassandra")
    p.add_argument("--run", help="root of the run's tables and checkpoints; give it again to resume")
    p.add_argument("--seconds", type=int, default=10, help="time between batches")
    p.add_argument("--backfill", action="store_true", help="read what is there, then end")
    p.add_argument(
        "--per-batch",
        type=int,
        help=f"most offsets (Kafka) or files of a batch; live: {LIVE_OFFSETS} offsets, or files of {LIVE_BYTES} bytes",
    )
    p.add_argument("--strict", action="store_true", help="fail on a bad line")
    p.add_argument("--count-bad", action="store_true", help="count bad lines, and write them nowhere")
    p.add_argument("--most-bad", type=float, metavar="SHARE", help="stop above this share of bad lines")
    p.add_argument("--maintained", action="store_true", help="write the ranked groups that a batch changed")
    p.add_argument("--seed", metavar="PATH", help="tally of a finished job to go on from")
    p.add_argument("--idle-minutes", type=float, help="airport_top10: forget idle airports")
    p.add_argument("--state-partitions", type=int)
    return p


def _lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.per_batch is not None:
        options = {"maxOffsetsPerTrigger" if args.kafka else "maxFilesPerTrigger": args.per_batch}
    elif args.backfill:
        options = {}
    else:
        options = {"maxOffsetsPerTrigger": LIVE_OFFSETS} if args.kafka else {"maxBytesPerTrigger": LIVE_BYTES}
    if args.kafka:
        own = ON_TIME_TOPIC if args.question == SHARED else QUESTIONS[args.question].topic
        return kafka_lines(spark, args.kafka, args.topic or own, **options)
    return text_lines(spark, args.files, name_glob=args.name_glob, stream=True, **options)


def start(spark: SparkSession, args: argparse.Namespace) -> tuple[Job | StreamingQuery, RunPaths]:
    """Start the job the arguments ask for."""
    if not (args.kafka or args.files):
        raise SystemExit("one of --kafka and --files is needed")
    paths = RunPaths(args.run) if args.run else fresh_run(shared_folder(spark))
    lines = _lines(spark, args)
    common = {
        "trigger": BACKFILL if args.backfill else {"processingTime": f"{args.seconds} seconds"},
        "state_partitions": args.state_partitions,
    }
    if args.idle_minutes is not None:
        if args.question != "airport_top10" or args.sink != "files" or args.backfill:
            raise SystemExit("--idle-minutes goes with airport_top10 --sink files, without --backfill")
        idle_ms = int(args.idle_minutes * 60_000)
        root, checkpoint = paths.table("airport_counts"), paths.checkpoint("airport_counts")
        query = start_idle_counts(lines, root, checkpoint, idle_ms=idle_ms, **common)
        return query, paths
    common["mode"] = "strict" if args.strict else "counted" if args.count_bad else "permissive"
    more = {name: value for name, value in (("most_bad", args.most_bad), ("seed", args.seed)) if value is not None}
    if more and (args.question == SHARED or args.sink != "files"):
        raise SystemExit("--most-bad and --seed go with one question and --sink files")
    if args.maintained:
        if args.question not in GROUPS or args.sink != "files" or args.seed:
            raise SystemExit("--maintained goes with a question by groups, --sink files and no seed")
        return start_maintained(QUESTIONS[args.question], lines, paths, **common, **more), paths
    if args.question == SHARED:
        if args.sink != "files":
            raise SystemExit("shared goes with --sink files")
        return start_shared(lines, paths, **common), paths
    question = QUESTIONS[args.question]
    root = paths.table(question.table.name)
    checkpoint = paths.checkpoint(question.name)
    if args.sink == "console":
        return start_console(question, lines, root, checkpoint, **common), paths
    sink = None
    if args.sink == "cassandra":
        if not args.keyspace:
            raise SystemExit("--sink cassandra needs --keyspace")

        def sink(batch: DataFrame, batch_id: int) -> None:
            write_cassandra(question.answer(batch), args.keyspace, question.table)

    return start_question(question, lines, root, checkpoint, sink=sink, **common, **more), paths


def merge(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fold the change tables of a run that fold themselves not; readers and streams may go on meanwhile."""
    if not args.run:
        raise SystemExit("merge needs --run")
    paths = RunPaths(args.run)
    for table in (BEST_FLIGHT, AIRPORT_COUNTS):
        merge_changes(spark, paths.table(table.name), table)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    builder = SparkSession.builder.appName(args.question).config("spark.sql.session.timeZone", "UTC")
    spark = builder.getOrCreate()
    if args.question == MERGE:
        return merge(spark, args)
    job, paths = start(spark, args)
    print(f"{args.question}: tables, bad lines and checkpoints under {paths.root}")
    if args.backfill:
        job.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()  # a live job ends if either of its queries does
        job.stop()
