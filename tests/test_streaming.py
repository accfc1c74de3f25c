from __future__ import annotations

import shutil
import time
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tarmac.cli import merge, parser, start
from tarmac.operators.parse import parse_on_time, rejects
from tarmac.plans import QUESTIONS
from tarmac.plans.shared import SHARED_TALLY, shared_columns
from tarmac.schema import AIRPORT_COUNTS
from tarmac.sinks.files import read_changes, read_snapshot
from tarmac.sources import text_lines
from tarmac.sources.derived import damaged_lines, on_time_lines, origin_destination_lines
from tarmac.streaming import (
    BACKFILL,
    RunPaths,
    fresh_run,
    read_answer,
    rejects_of,
    shared_folder,
    start_console,
    start_idle_counts,
    start_question,
    start_rejects,
    start_shared,
)
from tarmac.streaming.jobs import first_ten
from tarmac.streaming.idle import read_top_airports

# The documented sample record.
LINE = "2008-01-03 Thursday WN WN {num} HOU LIT 0600 1 1435 {delay}.00 1.00"


def lines_for(name, flights):
    return on_time_lines(flights) if QUESTIONS[name].columns else origin_destination_lines(flights)


@pytest.fixture(scope="module")
def four_files(flights, tmp_path_factory):
    """Folders with the lines of both topics in four files each, by whether a question reads flights."""
    folders = {}
    for name in ("airport_top10", "weekday_rank"):
        folder = str(tmp_path_factory.mktemp(name))
        lines_for(name, flights).repartition(4).write.mode("overwrite").text(folder)
        folders[bool(QUESTIONS[name].columns)] = folder
    return folders


def stream_of(spark, folder, **options):
    return text_lines(spark, folder, stream=True, maxFilesPerTrigger=1, **options)


def lines_read(query):
    """Input rows of all batches; more than the lines there are if a batch ran twice."""
    return sum(progress["numInputRows"] for progress in query.recentProgress)


@pytest.mark.parametrize("name", list(QUESTIONS))
def test_stream_equals_batch(spark, flights, four_files, tmp_path, name):
    question, root = QUESTIONS[name], str(tmp_path / "table")
    lines = stream_of(spark, four_files[bool(question.columns)])
    query = start_question(question, lines, root, str(tmp_path / "checkpoint"), trigger=BACKFILL)
    query.awaitTermination()
    assert query.lastProgress["batchId"] == 3
    assert lines_read(query) == flights.count()
    assert rows(read_answer(spark, question, root)) == rows(question.on_lines(lines_for(name, flights)))


def test_shared_stream_equals_batch(spark, flights, four_files, tmp_path):
    run = RunPaths(str(tmp_path))
    query = start_shared(stream_of(spark, four_files[True]), run, trigger=BACKFILL)
    query.awaitTermination()
    assert lines_read(query) == flights.count()
    for name in ("weekday_rank", "origin_top10_destinations", "pair_top10_carriers", "pair_mean_delay"):
        table = read_answer(spark, QUESTIONS[name], run.table(QUESTIONS[name].table.name))
        assert rows(table) == rows(QUESTIONS[name].on_records(flights)), name


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def test_best_flight_over_batches(spark, tmp_path):
    question, root = QUESTIONS["best_flight"], str(tmp_path / "table")
    seen = []
    for i, delay in enumerate((10, 3, 7)):
        put(tmp_path / "in", f"{i}.txt", LINE.format(num=i, delay=delay))
        lines = text_lines(spark, str(tmp_path / "in"), stream=True)
        start_question(question, lines, root, str(tmp_path / "cp"), trigger=BACKFILL).awaitTermination()
        seen += [r.delay for r in read_answer(spark, question, root).collect()]
    assert seen == [10, 3, 3]
    # The third batch touched the key without changing it, and wrote it again.
    assert [r.delay for r in spark.read.parquet(f"{root}/batch_id=2").collect()] == [3]


@pytest.mark.parametrize("name", ["pair_mean_delay", "best_flight"])
def test_failed_batch_is_replayed_without_doubling(spark, flights, four_files, tmp_path, name):
    from tarmac.sinks.files import write_changes, write_snapshot

    question, root, checkpoint = QUESTIONS[name], str(tmp_path / "table"), str(tmp_path / "cp")
    write = write_snapshot if question.output_mode == "complete" else write_changes
    failed = []

    def fail_once(batch, batch_id):
        write(question.answer(batch), root, question.table, batch_id)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after writing")

    def run():
        lines = stream_of(spark, four_files[True])
        start_question(question, lines, root, checkpoint, trigger=BACKFILL, sink=fail_once).awaitTermination()

    with pytest.raises(Exception, match="lost after writing"):
        run()
    run()
    assert failed == [2]
    assert rows(read_answer(spark, question, root)) == rows(question.on_records(flights))


@pytest.mark.parametrize("name", ["best_flight", "pair_mean_delay"])
def test_files_of_a_batch_go_by_its_size(spark, four_files, tmp_path, name):
    root, question = tmp_path / "t", QUESTIONS[name]
    lines = text_lines(spark, four_files[True], stream=True)
    start_question(
        question, lines, str(root), str(tmp_path / "cp"), trigger=BACKFILL, state_partitions=6
    ).awaitTermination()
    months = 2 if question.table.part else 1  # a part has files of its own
    assert len(list((root / "batch_id=0").rglob("*.parquet"))) == months


def test_stream_takes_files_by_name(spark, tmp_path):
    put(tmp_path / "in", "on_2007_1.txt", LINE.format(num=1, delay=1))
    put(tmp_path / "in", "on_2008_1.txt", LINE.format(num=2, delay=2))
    lines = text_lines(spark, str(tmp_path / "in"), name_glob="on_2008_*", stream=True)
    question, root = QUESTIONS["best_flight"], str(tmp_path / "t")
    start_question(question, lines, root, str(tmp_path / "cp"), trigger=BACKFILL).awaitTermination()
    assert [r.flight for r in read_answer(spark, question, root).collect()] == ["WN 2"]


@pytest.mark.parametrize("name", list(QUESTIONS))
def test_console(spark, flights, four_files, tmp_path, capfd, name):
    question = QUESTIONS[name]
    lines = stream_of(spark, four_files[bool(question.columns)])
    start_console(
        question, lines, str(tmp_path / "t"), str(tmp_path / "cp"), trigger=BACKFILL, state_partitions=5
    ).awaitTermination()
    shown = capfd.readouterr().out.split("batch 3\n")[1].strip().splitlines()
    answer = question.on_lines(lines_for(name, flights))
    first_ten(question, answer).show(10, truncate=False)
    expected = capfd.readouterr().out.strip().splitlines()
    if question.output_mode == "complete":
        assert shown == expected
    else:  # the keys that the last batch touched
        cells = [tuple(x.strip() for x in line.strip("|").split("|")) for line in shown[3:-1]]
        assert len(cells) == 10 and set(cells) <= {tuple(map(str, r)) for r in answer.collect()}
    assert not (tmp_path / "t").exists()


def test_bad_lines_go_to_rejects_and_not_into_answers(spark, lineitem, tmp_path):
    damaged = damaged_lines(lineitem)
    damaged.repartition(2).write.text(str(tmp_path / "in"))
    lines = stream_of(spark, str(tmp_path / "in"))
    bad = str(tmp_path / "bad")
    start_rejects(lines, bad, str(tmp_path / "cp1"), trigger=BACKFILL).awaitTermination()
    assert rows(spark.read.parquet(bad)) == rows(rejects(damaged))
    question, root = QUESTIONS["pair_mean_delay"], str(tmp_path / "table")
    start_question(question, lines, root, str(tmp_path / "cp2"), trigger=BACKFILL).awaitTermination()
    assert rows(read_answer(spark, question, root)) == rows(question.on_lines(damaged))
    # Next to the table lie the lines that this question cannot read, and no others.
    own = spark.read.parquet(rejects_of(root))
    assert rows(own) == rows(rejects(damaged, question.columns))
    assert own.count() < rejects(damaged).count()


def test_strict_jobs_have_no_rejects(spark, four_files, tmp_path):
    root = tmp_path / "t"
    lines, question = stream_of(spark, four_files[True]), QUESTIONS["weekday_rank"]
    job = start_question(question, lines, str(root), str(tmp_path / "cp"), trigger=BACKFILL, mode="strict")
    job.awaitTermination()
    assert job.rejected is None and not (tmp_path / "t_rejects").exists()


@pytest.mark.parametrize("name", ["pair_mean_delay", "shared"])
def test_command_line_loses_no_line(spark, lineitem, tmp_path, name):
    damaged = damaged_lines(lineitem)
    damaged.repartition(3).write.text(str(tmp_path / "in"))
    arguments = [name, "--files", str(tmp_path / "in"), "--backfill", "--per-batch", "1", "--run", str(tmp_path / "run")]
    job, run = start(spark, parser().parse_args(arguments))
    job.awaitTermination()
    if name == "shared":
        columns, table = shared_columns(), "shared_tally"
        accepted = read_snapshot(spark, run.table(table), SHARED_TALLY).groupBy().sum("n").first()[0]
    else:
        columns, table = QUESTIONS[name].columns, QUESTIONS[name].table.name
        accepted = parse_on_time(damaged, columns).count()
        assert rows(read_answer(spark, QUESTIONS[name], run.table(table))) == rows(QUESTIONS[name].on_lines(damaged))
    bad = spark.read.parquet(rejects_of(run.table(table)))
    assert rows(bad) == rows(rejects(damaged, columns))
    assert accepted + bad.count() == lineitem.count()


def test_strict_stream_fails_on_a_bad_line(spark, tmp_path):
    put(tmp_path / "in", "a.txt", LINE.format(num=1, delay=1), "2008-01-03 Thursday")
    lines = text_lines(spark, str(tmp_path / "in"), stream=True)
    question = QUESTIONS["best_flight"]
    query = start_question(
        question, lines, str(tmp_path / "t"), str(tmp_path / "cp"), trigger=BACKFILL, mode="strict"
    )
    with pytest.raises(Exception, match="bad on-time line"):
        query.awaitTermination()


def wait_for(check, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if check():
            return
        time.sleep(0.5)
    raise AssertionError("did not happen in time")


def idle_job(spark, tmp_path, second=None, idle_ms=60_000, **options):
    lines = text_lines(spark, str(tmp_path / "in"), stream=True)
    now = None if second is None else F.lit(second * 1000)
    options = {"trigger": {"once": True}, "now": now, "idle_ms": idle_ms, **options}
    return start_idle_counts(lines, str(tmp_path / "table"), str(tmp_path / "cp"), **options)


def top_airports(spark, tmp_path, clock):
    return dict(rows(read_top_airports(spark, str(tmp_path / "table"), idle_ms=60_000, clock=clock), "airport", "n"))


def written(spark, tmp_path, batch_id):
    return {r.airport: r.n for r in spark.read.parquet(f"{tmp_path}/table/batch_id={batch_id}").collect()}


def test_idle_airport_is_dropped_and_restarts_from_zero(spark, tmp_path):
    steps = [
        (0, ("ATL BOS", "ATL  ORD "), {"ATL": 2, "BOS": 1, "ORD": 1}),
        (40, ("ATL",), {"ATL": 3, "BOS": 1, "ORD": 1}),
        (80, ("JFK",), {"ATL": 3, "JFK": 1}),
        (110, ("BOS ATL ATL",), {"ATL": 2, "BOS": 1, "JFK": 1}),
    ]
    for i, (second, lines, expected) in enumerate(steps):
        put(tmp_path / "in", f"{i}.txt", *lines)
        idle_job(spark, tmp_path, second).awaitTermination()
        assert top_airports(spark, tmp_path, lambda second=second: float(second)) == expected
        # Each batch writes the airports it touched.
        assert set(written(spark, tmp_path, i)) == set(" ".join(lines).split())
    # Without another batch, readers leave idle airports out.
    assert top_airports(spark, tmp_path, lambda: 150.0) == {"ATL": 2, "BOS": 1}
    assert top_airports(spark, tmp_path, lambda: 999.0) == {}


def test_timers_end_idle_airports_in_the_table(spark, tmp_path):
    put(tmp_path / "in", "0.txt", "ATL BOS ATL")
    query = idle_job(spark, tmp_path, idle_ms=3000, trigger={"processingTime": "1 second"})
    root = str(tmp_path / "table")
    ended = lambda: {r.airport: r.n for r in read_changes(spark, root, AIRPORT_COUNTS).collect()} == {"ATL": None, "BOS": None}
    try:
        wait_for(ended)
        assert read_top_airports(spark, root, idle_ms=3000, clock=lambda: 0.0).count() == 0
        put(tmp_path / "in", "1.txt", "ATL")
        wait_for(lambda: rows(read_top_airports(spark, root, idle_ms=600_000), "airport", "n") == [("ATL", 1)])
    finally:
        query.stop()


def test_idle_counts_add_up_over_batches_and_replays(spark, flights, four_files, tmp_path, monkeypatch):
    from tarmac.streaming import idle

    write, failed = idle.write_changes, []

    def fail_once(df, root, table, batch_id):
        write(df, root, table, batch_id)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after writing")

    monkeypatch.setattr(idle, "write_changes", fail_once)
    root = str(tmp_path / "table")
    (tmp_path / "in").mkdir()
    for i, file in enumerate(sorted(Path(four_files[False]).glob("part-*"))):
        shutil.copy(file, tmp_path / "in" / f"{i}.txt")
        if i == 2:
            with pytest.raises(Exception, match="lost after writing"):
                idle_job(spark, tmp_path).awaitTermination()
        idle_job(spark, tmp_path).awaitTermination()
    assert failed == [2]
    expected = rows(QUESTIONS["airport_top10"].on_lines(origin_destination_lines(flights)))
    assert rows(read_top_airports(spark, root)) == expected


def test_live_batches_are_bounded(spark, flights, four_files, tmp_path, monkeypatch):
    monkeypatch.setattr("tarmac.cli.LIVE_BYTES", 1000)
    arguments = ["pair_mean_delay", "--files", four_files[True], "--seconds", "1", "--run", str(tmp_path)]
    job, run = start(spark, parser().parse_args(arguments))
    question = QUESTIONS["pair_mean_delay"]
    try:
        wait_for(lambda: job.lastProgress and job.lastProgress["batchId"] >= 3)
        job.query.processAllAvailable()
    finally:
        job.stop()
    assert rows(read_answer(spark, question, run.table(question.table.name))) == rows(question.on_records(flights))


def test_command_line_merge(spark, flights, four_files, tmp_path):
    arguments = ["best_flight", "--files", four_files[True], "--backfill", "--per-batch", "1", "--run", str(tmp_path)]
    job, run = start(spark, parser().parse_args(arguments))
    job.awaitTermination()
    question = QUESTIONS["best_flight"]
    merge(spark, parser().parse_args(["merge", "--run", str(tmp_path)]))
    folders = {p.name for p in (tmp_path / "tables" / "xyz").iterdir()}
    assert "merged_to=3" in folders
    assert rows(read_answer(spark, question, run.table("xyz"))) == rows(question.on_records(flights))


def test_command_line_job(spark, flights, four_files, tmp_path):
    def arguments(question, folder):
        return parser().parse_args(
            [question, "--files", folder, "--backfill", "--per-batch", "2", "--run", str(tmp_path)]
        )

    query, run = start(spark, arguments("pair_top10_carriers", four_files[True]))
    query.awaitTermination()
    question = QUESTIONS["pair_top10_carriers"]
    assert rows(read_answer(spark, question, run.table(question.table.name))) == rows(question.on_records(flights))
    query, run = start(spark, arguments("shared", four_files[True]))
    query.awaitTermination()
    question = QUESTIONS["weekday_rank"]
    assert rows(read_answer(spark, question, run.table(question.table.name))) == rows(question.on_records(flights))


@pytest.mark.parametrize(
    "arguments",
    [
        ["best_flight", "--idle-minutes", "1"],
        ["shared", "--sink", "console"],
        ["best_flight", "--sink", "cassandra"],
    ],
)
def test_command_line_refuses_what_does_not_go_together(spark, four_files, arguments):
    with pytest.raises(SystemExit):
        start(spark, parser().parse_args([*arguments, "--files", four_files[True]]))


def test_command_line_kafka_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        start(spark, parser().parse_args(["shared", "--kafka", "broker:9092"]))


def test_runs_share_nothing(spark, tmp_path):
    a, b = fresh_run(str(tmp_path)), fresh_run(str(tmp_path))
    assert a.root != b.root and a.table("xyz") != a.checkpoint("xyz")
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert not named or shared_folder(spark) == named


@pytest.mark.parametrize("name, session, asked, given", [
    ("weekday_rank", 8, None, 8), ("weekday_rank", 2, None, 2), ("weekday_rank", 8, 3, 3), ("best_flight", 5, None, 5),
])
def test_state_partitions(spark, tmp_path, name, session, asked, given):
    put(tmp_path / "in", "a.txt", LINE.format(num=1, delay=1))
    own = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", session)
    query = start_question(
        QUESTIONS[name],
        text_lines(spark, str(tmp_path / "in"), stream=True),
        str(tmp_path / "t"),
        str(tmp_path / "cp"),
        trigger=BACKFILL,
        state_partitions=asked,
    )
    spark.conf.set("spark.sql.shuffle.partitions", own)
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == given


def test_session_settings_are_restored(spark, four_files, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None), spark.conf.get("spark.sql.shuffle.partitions")
    query = start_question(
        QUESTIONS["weekday_rank"],
        text_lines(spark, four_files[True], stream=True),
        str(tmp_path / "t"),
        str(tmp_path / "cp"),
        trigger=BACKFILL,
        state_partitions=2,
    )
    assert (spark.conf.get(name, None), spark.conf.get("spark.sql.shuffle.partitions")) == before
    query.awaitTermination()
    assert "RocksDB" in str(query.lastProgress["stateOperators"][0]["customMetrics"]) or any(
        "rocksdb" in k for k in query.lastProgress["stateOperators"][0]["customMetrics"]
    )
