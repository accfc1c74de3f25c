"""Tallies in a stream's state, maintained ranks, seeds, line counts and the landing table."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tarmac.operators.parse import rejects
from tarmac.plans import QUESTIONS
from tarmac.sinks.files import read_changes
from tarmac.sources import airports_of, land, landed_lines, landed_rejects, start_landing, text_lines
from tarmac.sources.derived import damaged_lines, flights_of, on_time_lines, origin_destination_lines
from tarmac.streaming import (
    BACKFILL,
    BadLines,
    fresh_run,
    read_answer,
    read_maintained,
    read_tally,
    save_tally,
    start_maintained,
    start_question,
    start_tally,
)
from tarmac.streaming.tallies import GROUPS, tally_table


def lines_for(name, flights):
    return on_time_lines(flights) if QUESTIONS[name].columns else origin_destination_lines(flights)


@pytest.fixture(scope="module")
def folder(flights, tmp_path_factory):
    """The lines of both topics in four files each."""
    root = tmp_path_factory.mktemp("lines")
    for name in ("airport_top10", "weekday_rank"):
        lines_for(name, flights).repartition(4).write.text(f"{root}/{bool(QUESTIONS[name].columns)}")
    return lambda name: f"{root}/{bool(QUESTIONS[name].columns)}"


def by_file(spark, folder):
    return text_lines(spark, folder, stream=True, maxFilesPerTrigger=1)


@pytest.mark.parametrize("name", list(QUESTIONS))
def test_state_is_the_tally(spark, flights, folder, tmp_path, name):
    question, checkpoint = QUESTIONS[name], str(tmp_path / "cp")
    start_tally(question, by_file(spark, folder(name)), checkpoint, trigger=BACKFILL).awaitTermination()
    whole = question.tally(question.records(lines_for(name, flights)))
    tally = read_tally(spark, question, checkpoint)
    assert tally.schema.names == whole.schema.names and rows(tally) == rows(whole)
    if "n" in whole.columns:  # the state of an earlier batch
        seen = lambda batch: read_tally(spark, question, checkpoint, batch_id=batch).agg(F.sum("n")).first()[0]
        assert 0 < seen(0) < seen(2) < seen(3) == whole.agg(F.sum("n")).first()[0]


def test_state_of_a_running_job(spark, flights, folder, tmp_path):
    question, checkpoint = QUESTIONS["pair_mean_delay"], str(tmp_path / "cp")
    lines = text_lines(spark, folder("pair_mean_delay"), stream=True)
    job = start_question(question, lines, str(tmp_path / "t"), checkpoint, trigger={"processingTime": "1 second"})
    try:
        job.query.processAllAvailable()
        assert job.query.isActive
        assert rows(question.answer(read_tally(spark, question, checkpoint))) == rows(question.on_records(flights))
    finally:
        job.stop()


@pytest.mark.parametrize("name", list(GROUPS))
def test_batches_write_the_groups_they_change(spark, lineitem, tmp_path, name):
    question, run, group = QUESTIONS[name], fresh_run(str(tmp_path)), list(GROUPS[name])
    incoming, seen = f"{tmp_path}/in", None
    root = run.table(question.table.name)
    for batch, origins in enumerate((("ATL", "BOS"), ("BOS",), ("DEN", "ATL"), ("SEA",))):
        part = flights_of(lineitem.filter(F.col("l_linenumber") == batch + 1)).filter(F.col("origin").isin(*origins))
        on_time_lines(part).write.mode("append").text(incoming)
        start_maintained(question, text_lines(spark, incoming, stream=True), run, trigger=BACKFILL).awaitTermination()
        seen = part if seen is None else seen.union(part)
        written = spark.read.parquet(f"{root}/batch_id={batch}")
        assert rows(written.select(*group).distinct()) == rows(part.select(*group).distinct())
        # All in all, the answer that complete mode would write.
        assert rows(read_maintained(spark, question, run)) == rows(question.on_records(seen))


def test_maintained_tables_fold_themselves(spark, flights, folder, tmp_path, monkeypatch):
    from tarmac.streaming import tallies

    monkeypatch.setattr(tallies, "FOLD_EVERY", 2)
    question, run = QUESTIONS["pair_top10_carriers"], fresh_run(str(tmp_path))
    start_maintained(question, by_file(spark, folder(question.name)), run, trigger=BACKFILL).awaitTermination()
    assert rows(read_maintained(spark, question, run)) == rows(question.on_records(flights))
    below = run.table(tally_table(question).name)
    assert rows(read_changes(spark, below, tally_table(question))) == rows(question.tally(flights))
    assert not list((tmp_path / below.removeprefix(f"{tmp_path}/")).glob("batch_id=0"))


@pytest.mark.parametrize("name", list(QUESTIONS))
def test_backfill_and_stream_equal_one_stream(spark, flights, lineitem, tmp_path, name):
    question, first, second = QUESTIONS[name], fresh_run(str(tmp_path)), fresh_run(str(tmp_path))
    parts = [f"{tmp_path}/{i}" for i in range(3)]
    for path, n in zip(parts, ("l_linenumber <= 2", "l_linenumber IN (3, 4)", "l_linenumber > 4")):
        lines_for(name, flights_of(lineitem.filter(n))).write.text(path)
    tally, root = f"{tmp_path}/tally", second.table(question.table.name)
    start_tally(question, text_lines(spark, parts[0], stream=True), first.checkpoint(name), trigger=BACKFILL, state_partitions=2).awaitTermination()
    save_tally(spark, question, first.checkpoint(name), tally)
    for path in parts[1:]:  # a restart takes the seed once more
        lines_for(name, spark.createDataFrame([], flights.schema)).write.mode("append").text(f"{tmp_path}/in")
        spark.read.text(path).write.mode("append").text(f"{tmp_path}/in")
        lines = text_lines(spark, f"{tmp_path}/in", stream=True)
        start_question(
            question, lines, root, second.checkpoint(name), trigger=BACKFILL, seed=tally, state_partitions=3
        ).awaitTermination()
    assert rows(read_answer(spark, question, root)) == rows(question.on_lines(lines_for(name, flights)))


def damaged_job(spark, lineitem, tmp_path, **options):
    question = QUESTIONS["pair_mean_delay"]
    folder, root = tmp_path / "damaged", str(tmp_path / "t")
    damaged_lines(lineitem).repartition(4).write.mode("ignore").text(str(folder))
    lines = by_file(spark, str(folder))
    return start_question(question, lines, root, str(tmp_path / "cp"), trigger=BACKFILL, **options)


def test_lines_are_counted_in_the_same_read(spark, lineitem, tmp_path):
    job = damaged_job(spark, lineitem, tmp_path, mode="counted")
    job.awaitTermination()
    lines, columns = damaged_lines(lineitem), QUESTIONS["pair_mean_delay"].columns
    assert job.lines.read == lineitem.count() and job.lines.bad == rejects(lines, columns).count() > 0
    assert sorted(job.lines.batches) == [0, 1, 2, 3] and job.rejected is None
    # One scan: each line was an input row once.
    assert sum(progress["numInputRows"] for progress in job.recentProgress) == lineitem.count()
    assert not (tmp_path / "t_rejects").exists()


def test_a_share_of_bad_lines_stops_the_job(spark, lineitem, tmp_path):
    with pytest.raises(BadLines, match="lines are bad, more than 1.0%"):
        damaged_job(spark, lineitem, tmp_path, most_bad=0.01).awaitTermination()
    job = damaged_job(spark, lineitem, tmp_path, most_bad=0.9)  # and goes on from where it was
    job.awaitTermination()
    assert rows(read_answer(spark, QUESTIONS["pair_mean_delay"], str(tmp_path / "t"))) == rows(
        QUESTIONS["pair_mean_delay"].on_lines(damaged_lines(lineitem))
    )


@pytest.fixture(scope="module")
def landing(spark, lineitem, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landing") / "flights")
    land(damaged_lines(lineitem), folder)
    return folder


@pytest.mark.parametrize("name", [n for n in QUESTIONS if QUESTIONS[n].columns])
def test_questions_on_the_landing_table(spark, lineitem, landing, name):
    assert rows(QUESTIONS[name].on_records(landed_lines(spark, landing))) == rows(QUESTIONS[name].on_lines(damaged_lines(lineitem)))


def test_landing_table_holds_every_line_once(spark, lineitem, landing):
    assert landed_lines(spark, landing).count() == lineitem.count()
    assert Counter(rows(landed_rejects(spark, landing))) == Counter(rows(rejects(damaged_lines(lineitem)), "reason", "value"))


def test_airports_of_the_landing_table(spark, flights, tmp_path):
    land(on_time_lines(flights), str(tmp_path))
    question = QUESTIONS["airport_top10"]
    assert rows(question.on_records(airports_of(landed_lines(spark, str(tmp_path))))) == rows(question.on_lines(origin_destination_lines(flights)))


def test_landing_reads_are_pruned(spark, landing):
    answer = QUESTIONS["pair_mean_delay"].on_records(landed_lines(spark, landing, ["2008-02"]))
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = answer._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    (scan,) = [line for line in plan.splitlines() if "FileScan" in line]
    assert "ReadSchema: struct<origin:string,destination:string,arr_delay:int>" in scan
    assert "month" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0] and "IsNotNull(arr_delay)" in scan


def test_landing_by_a_stream(spark, lineitem, landing, tmp_path):
    damaged_lines(lineitem).repartition(3).write.text(str(tmp_path / "in"))
    for _ in range(2):  # the second finds nothing new
        start_landing(by_file(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"), trigger=BACKFILL).awaitTermination()
    assert rows(landed_lines(spark, str(tmp_path / "out"))) == rows(landed_lines(spark, landing))
