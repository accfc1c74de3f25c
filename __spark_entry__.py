"""Registered queries and their DuckDB forms, over the given tables.

Flights are derived from all of ``lineitem`` and trip requests from all of
``orders`` (``tarmac.sources.derived``); ``FLIGHTS_SQL`` is the same in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.parse import airport_tokens, parse_on_time, rejects
from tarmac.plans import (
    QUESTIONS,
    best_flight_on,
    carriers_of_pair,
    destinations_of,
    mean_delay_of_pair,
    shared_answers,
    shared_tally,
    two_leg_trips,
)
from tarmac.plans.shared import SHARED_QUESTIONS
from tarmac.serving import publish, register_views
from tarmac.sinks.files import merge_changes, rename_files
from tarmac.sources import airports_of, land, landed_lines, landed_rejects, start_landing, text_lines
from tarmac.sources.derived import (
    AIRPORTS,
    CARRIERS,
    damaged_lines,
    flights_of,
    on_time_lines,
    origin_destination_lines,
    trip_requests,
)
from tarmac.streaming import (
    BACKFILL,
    fresh_run,
    read_answer,
    read_maintained,
    read_tally,
    rejects_of,
    save_tally,
    shared_folder,
    start_idle_counts,
    start_maintained,
    start_question,
    start_rejects,
    start_shared,
    start_tally,
)
from tarmac.streaming.idle import read_top_airports
from tarmac.streaming.tallies import GROUPS

if (found := find_spec("tarmac.llm")) and found.origin and find_spec("corpus_pipeline"):
    from tarmac.llm.queries import ORACLE_SQL as LLM_SQL
    from tarmac.llm.queries import QUERIES as LLM_QUERIES
else:  # the library works without its training-data operators
    LLM_QUERIES, LLM_SQL = {}, {}

Query = Callable[[SparkSession, str], DataFrame]


def _lineitem(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # A stream refuses the plain path of a table in one file; a pattern reads file or folder.
    pattern = f"{sf_dir}/[l]ineitem.parquet"
    return spark.readStream.schema(table.schema).parquet(pattern) if stream else table


def _flights(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return flights_of(_lineitem(spark, sf_dir, stream))


def _lines(flights: DataFrame, name: str) -> DataFrame:
    """The lines a question reads."""
    return on_time_lines(flights) if QUESTIONS[name].columns else origin_destination_lines(flights)


def _run(spark: SparkSession):
    return fresh_run(shared_folder(spark))


def _batch(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        flights = _flights(spark, sf_dir)
        if QUESTIONS[name].columns:
            return QUESTIONS[name].on_records(flights)
        return QUESTIONS[name].on_lines(origin_destination_lines(flights))

    return query


def _tally(name: str) -> Query:
    """What a question sums and counts, before it is ranked."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        question = QUESTIONS[name]
        return question.tally(question.records(_lines(_flights(spark, sf_dir), name)))

    return query


def _from_lines(name: str) -> Query:
    return lambda spark, sf_dir: QUESTIONS[name].on_lines(_lines(_flights(spark, sf_dir), name))


def _stream(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        question, run = QUESTIONS[name], _run(spark)
        lines = _lines(_flights(spark, sf_dir, stream=True), name)
        root = run.table(question.table.name)
        start_question(
            question, lines, root, run.checkpoint(name), trigger=BACKFILL
        ).awaitTermination()
        return read_answer(spark, question, root)

    return query


def _resumed(name: str, merge: bool = False) -> Query:
    """Two deliveries of files, the stream stopped after the first and resumed for the second.

    ``merge`` folds the change table after each.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        question, run = QUESTIONS[name], _run(spark)
        lineitem = _lineitem(spark, sf_dir)
        root, incoming = run.table(question.table.name), f"{run.root}/incoming"
        for delivery in (F.col("l_linenumber") <= 3, F.col("l_linenumber") > 3):
            lines = _lines(flights_of(lineitem.filter(delivery)), name)
            lines.write.mode("append").text(incoming)
            start_question(
                question,
                text_lines(spark, incoming, stream=True),
                root,
                run.checkpoint(name),
                trigger=BACKFILL,
            ).awaitTermination()
            if merge:
                merge_changes(spark, root, question.table)
        return read_answer(spark, question, root)

    return query


def _stream_shared(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        run = _run(spark)
        lines = on_time_lines(_flights(spark, sf_dir, stream=True))
        start_shared(lines, run, trigger=BACKFILL).awaitTermination()
        return read_answer(spark, QUESTIONS[name], run.table(QUESTIONS[name].table.name))

    return query


def stream_airport_top10_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries two hours apart, airports idle after one: the first is forgotten."""
    run, lineitem = _run(spark), _lineitem(spark, sf_dir)
    root, incoming, hours = run.table("airport_counts"), f"{run.root}/incoming", 0
    for hours, delivery in ((1, F.col("l_linenumber") <= 3), (3, F.col("l_linenumber") > 3)):
        lines = origin_destination_lines(flights_of(lineitem.filter(delivery)))
        lines.write.mode("append").text(incoming)
        start_idle_counts(
            text_lines(spark, incoming, stream=True),
            root,
            run.checkpoint("idle"),
            trigger={"once": True},
            now=F.lit(3_600_000 * hours),
        ).awaitTermination()
    return read_top_airports(spark, root, clock=lambda: 3600.0 * hours)


def parse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_on_time(damaged_lines(_lineitem(spark, sf_dir)))


def reject_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(damaged_lines(_lineitem(spark, sf_dir)))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark)
    lines = damaged_lines(_lineitem(spark, sf_dir, stream=True))
    start_rejects(lines, run.table("rejects"), run.checkpoint("rejects"), trigger=BACKFILL).awaitTermination()
    return spark.read.parquet(run.table("rejects"))


def _damaged_job(spark: SparkSession, sf_dir: str) -> str:
    """The mean delays kept by a stream over damaged lines; gives the table's root."""
    question, run = QUESTIONS["pair_mean_delay"], _run(spark)
    lines, root = damaged_lines(_lineitem(spark, sf_dir, stream=True)), run.table(question.table.name)
    start_question(question, lines, root, run.checkpoint(question.name), trigger=BACKFILL).awaitTermination()
    return root


def stream_damaged_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_answer(spark, QUESTIONS["pair_mean_delay"], _damaged_job(spark, sf_dir))


def stream_damaged_mean_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(rejects_of(_damaged_job(spark, sf_dir)))


def _with_nulls(name: str) -> Query:
    """An answer from typed flights of which some lack the delay and some the time."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        flights, tax = flights_of(_lineitem(spark, sf_dir), "l_tax"), F.round("l_tax", 2)
        flights = flights.withColumn("arr_delay", F.when(tax != 0.05, F.col("arr_delay")))
        return QUESTIONS[name].on_records(flights.withColumn("dep_time", F.when(tax != 0.06, F.col("dep_time"))))

    return query


def republished_best_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published from one delivery, merged, then published again from all flights."""
    question, run, lineitem = QUESTIONS["best_flight"], _run(spark), _lineitem(spark, sf_dir)
    root = publish(question, flights_of(lineitem.filter("l_linenumber <= 3")), run)
    merge_changes(spark, root, question.table)
    publish(question, flights_of(lineitem), run)
    return read_answer(spark, question, root)


def stream_damaged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines a job over damaged lines has read, used and left out, as counted in its own read."""
    question, run = QUESTIONS["pair_mean_delay"], _run(spark)
    lines, root = damaged_lines(_lineitem(spark, sf_dir, stream=True)), run.table(question.table.name)
    job = start_question(question, lines, root, run.checkpoint(question.name), trigger=BACKFILL, mode="counted")
    job.awaitTermination()
    counts = [(job.lines.read, job.lines.read - job.lines.bad, job.lines.bad)]
    return spark.createDataFrame(counts, "n_read BIGINT, n_good BIGINT, n_bad BIGINT")


def _state(name: str) -> Query:
    """An answer drawn from the state of a stream that writes no table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        question, run = QUESTIONS[name], _run(spark)
        lines, checkpoint = _lines(_flights(spark, sf_dir, stream=True), name), run.checkpoint(name)
        start_tally(question, lines, checkpoint, trigger=BACKFILL).awaitTermination()
        return question.answer(read_tally(spark, question, checkpoint))

    return query


def _deliveries(spark: SparkSession, sf_dir: str, folder: str, name: str):
    """The lines of a question in two parts, each written to the folder before it is yielded."""
    for delivery in (F.col("l_linenumber") <= 3, F.col("l_linenumber") > 3):
        _lines(flights_of(_lineitem(spark, sf_dir).filter(delivery)), name).write.mode("append").text(folder)
        yield


def _maintained(name: str) -> Query:
    """An answer of which each of two batches ranks and writes the groups it changed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        question, run = QUESTIONS[name], _run(spark)
        incoming = f"{run.root}/incoming"
        for _ in _deliveries(spark, sf_dir, incoming, name):
            lines = text_lines(spark, incoming, stream=True)
            start_maintained(question, lines, run, trigger=BACKFILL).awaitTermination()
        return read_maintained(spark, question, run)

    return query


def _seeded(name: str) -> Query:
    """A backfill of one part of the lines, and a stream over the other that starts from its tally."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        question, run, live = QUESTIONS[name], _run(spark), _run(spark)
        lineitem, tally = _lineitem(spark, sf_dir), f"{run.root}/tally"
        parts = [f"{run.root}/lines_{i}" for i in range(2)]
        for path, part in zip(parts, (F.col("l_linenumber") <= 3, F.col("l_linenumber") > 3)):
            _lines(flights_of(lineitem.filter(part)), name).write.text(path)
        backfill = text_lines(spark, parts[0], stream=True)
        start_tally(question, backfill, run.checkpoint(name), trigger=BACKFILL).awaitTermination()
        save_tally(spark, question, run.checkpoint(name), tally)
        root, lines = live.table(question.table.name), text_lines(spark, parts[1], stream=True)
        start_question(question, lines, root, live.checkpoint(name), trigger=BACKFILL, seed=tally).awaitTermination()
        return read_answer(spark, question, root)

    return query


def _landed(spark: SparkSession, lines: DataFrame) -> str:
    folder = _run(spark).table("landed")
    land(lines, folder)
    return folder


def _from_landed(name: str, months: tuple[str, ...] | None = None) -> Query:
    """An answer from lines that were parsed once into a typed table by month."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _landed(spark, on_time_lines(_flights(spark, sf_dir)))
        flights = landed_lines(spark, folder, months)
        return QUESTIONS[name].on_records(flights if QUESTIONS[name].columns else airports_of(flights))

    return query


def landed_damaged_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with other faults than the question's own count."""
    folder = _landed(spark, damaged_lines(_lineitem(spark, sf_dir)))
    return QUESTIONS["pair_mean_delay"].on_records(landed_lines(spark, folder))


def landed_damaged_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_rejects(spark, _landed(spark, damaged_lines(_lineitem(spark, sf_dir))))


def stream_landed_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark)
    lines, folder = damaged_lines(_lineitem(spark, sf_dir, stream=True)), run.table("landed")
    start_landing(lines, folder, run.checkpoint("landed"), trigger=BACKFILL).awaitTermination()
    return QUESTIONS["pair_mean_delay"].on_records(landed_lines(spark, folder))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return airport_tokens(origin_destination_lines(_flights(spark, sf_dir)))


def _published(spark: SparkSession, sf_dir: str, name: str, parts: bool = False) -> DataFrame:
    """A question's serving table, written from all flights and read back."""
    question = QUESTIONS[name]
    return read_answer(spark, question, publish(question, _flights(spark, sf_dir), _run(spark)), parts=parts)


def lookup_origins_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _published(spark, sf_dir, "origin_top10_destinations")
    return destinations_of(table, "SRQ", "CMH", "JFK", "SEA", "BOS")


def lookup_pair_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return carriers_of_pair(_published(spark, sf_dir, "pair_top10_carriers"), "LGA", "BOS")


def lookup_pair_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark)
    publish(QUESTIONS["pair_mean_delay"], _flights(spark, sf_dir), run)
    register_views(spark, run)
    return spark.sql("SELECT * FROM xymeandelay WHERE origin = 'LGA' AND destination = 'BOS'")


def lookup_pair_mean_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _published(spark, sf_dir, "pair_mean_delay")
    return mean_delay_of_pair(table, "BOS", "LGA").union(mean_delay_of_pair(table, "MSP", "ATL"))


def lookup_best_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _published(spark, sf_dir, "best_flight", parts=True)
    return best_flight_on(table, "24/01/2008", "AM", "DFW", "STL").drop("month")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = trip_requests(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    return two_leg_trips(_published(spark, sf_dir, "best_flight", parts=True), requests)


def _bz2_files(lines: DataFrame, folder: str, *by: str) -> None:
    lines.write.partitionBy(*by).option("compression", "bzip2").text(folder)


def backfill_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{_run(spark).root}/od"
    _bz2_files(origin_destination_lines(_flights(spark, sf_dir)), folder)
    return QUESTIONS["airport_top10"].on_lines(text_lines(spark, folder, name_glob="*.bz2"))


def backfill_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flights in files by month, then the mean delays of one month's files."""
    folder = f"{_run(spark).root}/on"
    flights = _flights(spark, sf_dir).withColumn("month", F.date_format("flight_date", "yyyy_M"))
    _bz2_files(on_time_lines(flights, "month"), folder, "month")
    lines = text_lines(spark, f"{folder}/month=2008_1", name_glob="*.bz2")
    return QUESTIONS["pair_mean_delay"].on_lines(lines)


def backfill_on_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean delays of all files of a folder of flights."""
    folder = f"{_run(spark).root}/on"
    _bz2_files(on_time_lines(_flights(spark, sf_dir)), folder)
    return QUESTIONS["pair_mean_delay"].on_lines(text_lines(spark, folder, name_glob="*.bz2"))


def backfill_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean delays of the files of one month, chosen by name among all in one folder."""
    run = _run(spark)
    flights = _flights(spark, sf_dir).withColumn("month", F.date_format("flight_date", "yyyy_M"))
    _bz2_files(on_time_lines(flights, "month"), f"{run.root}/months", "month")
    folder = f"{run.root}/on"
    rename_files(spark, f"{run.root}/months", folder, "On_Time_On_Time_Performance")
    lines = text_lines(spark, folder, name_glob="On_Time_On_Time_Performance_2008_2_*.bz2")
    return QUESTIONS["pair_mean_delay"].on_lines(lines)


def _shared(name: str) -> Query:
    """An answer from the tally all four summing questions share, written once and read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{_run(spark).root}/shared_tally"
        shared_tally(_flights(spark, sf_dir)).write.parquet(path)
        return shared_answers(spark.read.parquet(path))[name]

    return query


def entry(spark: SparkSession) -> DataFrame:
    sf_dir = spark.conf.get("spark.tarmac.sf_dir", "/root/testdata/sf0.001")
    return _batch("origin_top10_destinations")(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        **{name: _batch(name) for name in QUESTIONS},
        **{f"tally_{name}": _tally(name) for name in QUESTIONS},
        **{f"lines_{name}": _from_lines(name) for name in QUESTIONS if QUESTIONS[name].columns},
        **{f"stream_{name}": _stream(name) for name in QUESTIONS},
        **{f"resumed_{name}": _resumed(name) for name in QUESTIONS},
        "merged_best_flight": _resumed("best_flight", merge=True),
        **{f"shared_{name}": _shared(name) for name in SHARED_QUESTIONS},
        **{f"stream_shared_{name}": _stream_shared(name) for name in SHARED_QUESTIONS},
        "stream_airport_top10_idle": stream_airport_top10_idle,
        "parse_lines": parse_lines,
        "rejects": reject_lines,
        "stream_rejects": stream_rejects,
        "airport_tokens": tokens,
        "lookup_origins_in": lookup_origins_in,
        "lookup_pair_carriers": lookup_pair_carriers,
        "lookup_pair_mean": lookup_pair_mean,
        "lookup_pair_mean_two": lookup_pair_mean_two,
        "lookup_best_flight": lookup_best_flight,
        "two_leg_trips": trips,
        "backfill_all": backfill_all,
        "backfill_glob": backfill_glob,
        "backfill_on_all": backfill_on_all,
        "backfill_by_name": backfill_by_name,
        "stream_damaged_pair_mean_delay": stream_damaged_mean,
        "stream_damaged_pair_mean_delay_rejects": stream_damaged_mean_rejects,
        "typed_nulls_pair_mean_delay": _with_nulls("pair_mean_delay"),
        "typed_nulls_best_flight": _with_nulls("best_flight"),
        "republished_best_flight": republished_best_flight,
        "stream_damaged_counts": stream_damaged_counts,
        **{f"state_{name}": _state(name) for name in ("airport_top10", "origin_top10_destinations", "best_flight")},
        **{f"maintained_{name}": _maintained(name) for name in GROUPS},
        **{f"seeded_{name}": _seeded(name) for name in ("airport_top10", "pair_mean_delay", "best_flight")},
        **{f"landed_{name}": _from_landed(name) for name in QUESTIONS},
        "landed_february": _from_landed("pair_mean_delay", ("2008-02",)),
        "landed_damaged_pair_mean_delay": landed_damaged_mean,
        "landed_damaged_rejects": landed_damaged_rejects,
        "stream_landed_pair_mean_delay": stream_landed_mean,
        **LLM_QUERIES,
    }


def _names(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


FLIGHTS_SQL = f"""
lists AS (SELECT {_names(AIRPORTS)} AS air, {_names(CARRIERS)} AS car),
dated AS (
  SELECT *, DATE '2008-01-01' + CAST(l_orderkey % 60 AS INT) AS flight_date,
    lpad(CAST(((l_orderkey * 7 + l_linenumber * 5) % 24) * 100 + l_partkey % 60 AS VARCHAR), 4, '0')
      AS dep_time
  FROM lineitem),
flights AS (
  SELECT flight_date, dayname(flight_date) AS weekday,
    car[CAST((l_partkey // 14) % 14 AS INT) + 1] AS carrier_id,
    car[CAST((l_partkey // 14) % 14 AS INT) + 1] AS carrier,
    CAST(l_orderkey % 9999 + 1 AS VARCHAR) AS flight_num,
    air[CAST(l_suppkey % 15 AS INT) + 1] AS origin,
    air[CAST((l_suppkey % 15 + 1 + l_partkey % 14) % 15 AS INT) + 1] AS destination,
    dep_time,
    CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END AS dep_delayed,
    dep_time AS arr_time,
    CAST(greatest(l_quantity - 20, 0) AS INT) AS arr_delay,
    CASE WHEN l_quantity >= 35 THEN 1 ELSE 0 END AS arr_delayed,
    round(l_tax, 2) AS tax, l_linenumber
  FROM dated, lists)
"""

PERCENT = "CAST(CAST(CAST({0} AS FLOAT) / CAST(count(*) AS FLOAT) AS FLOAT) * CAST(100 AS FLOAT) AS FLOAT)"

AIRPORT_TOP10_FROM = f"""
WITH {FLIGHTS_SQL},
counts AS (
  SELECT airport, count(*) AS n
  FROM (SELECT origin AS airport, l_linenumber FROM flights
    UNION ALL SELECT destination, l_linenumber FROM flights)
  WHERE {{where}} GROUP BY airport)
SELECT airport, n, CAST(row_number() OVER (ORDER BY n DESC, airport) AS INTEGER) AS rank
FROM counts QUALIFY rank <= 10
"""

AIRPORT_TOP10_SQL = AIRPORT_TOP10_FROM.format(where="true")

WEEKDAY_SQL = f"""
WITH {FLIGHTS_SQL},
percents AS (
  SELECT weekday, {PERCENT.format("sum(arr_delayed)")} AS pct_delayed FROM flights GROUP BY weekday)
SELECT *, CAST(row_number() OVER (ORDER BY pct_delayed, weekday) AS INTEGER) AS rank FROM percents
"""

DESTINATIONS_SQL = f"""
WITH {FLIGHTS_SQL},
percents AS (
  SELECT origin, destination,
    CAST(trunc({PERCENT.format("sum(dep_delayed)")}) AS INTEGER) AS percentage_delayed
  FROM flights GROUP BY origin, destination)
SELECT *, CAST(row_number() OVER (
    PARTITION BY origin ORDER BY percentage_delayed, destination) AS INTEGER) AS rank
FROM percents QUALIFY rank <= 10
"""

CARRIERS_SQL = f"""
WITH {FLIGHTS_SQL},
percents AS (
  SELECT origin, destination, carrier,
    CAST(trunc({PERCENT.format("sum(arr_delayed)")}) AS INTEGER) AS percentage_delayed
  FROM flights GROUP BY origin, destination, carrier)
SELECT *, CAST(row_number() OVER (
    PARTITION BY origin, destination ORDER BY percentage_delayed, carrier) AS INTEGER) AS rank
FROM percents QUALIFY rank <= 10
"""

MEAN_SQL = f"""
WITH {FLIGHTS_SQL}
SELECT origin, destination,
  CAST(CAST(sum(arr_delay) AS FLOAT) / CAST(count(*) AS FLOAT) AS FLOAT) AS mean_delay
FROM flights WHERE {{where}} GROUP BY origin, destination
"""

BEST_FLIGHT_FROM = f"""
WITH {FLIGHTS_SQL},
named AS (
  SELECT *, CASE WHEN CAST(dep_time AS INTEGER) < 1200 THEN 'AM' ELSE 'PM' END AS period,
    carrier || ' ' || flight_num AS flight
  FROM flights WHERE {{where}}),
best AS (
  SELECT * FROM named QUALIFY row_number() OVER (
    PARTITION BY flight_date, period, origin, destination
    ORDER BY arr_delay, dep_time, flight) = 1),
xyz AS (
  SELECT strftime(flight_date, '%d/%m/%Y') AS departure_date, period, origin, destination, flight,
    dep_time AS departure_time, arr_delay AS delay
  FROM best)
"""

BEST_FLIGHT_SQL = BEST_FLIGHT_FROM.format(where="true")

TRIPS_SQL = f"""
{BEST_FLIGHT_SQL},
wishes AS (
  SELECT DISTINCT DATE '2008-01-01' + CAST(o_orderkey % 60 AS INT) AS d, o_custkey % 15 AS x,
    (o_custkey % 15 + 1 + o_orderkey % 14) % 15 AS y,
    ((o_custkey % 15 + 1 + o_orderkey % 14) % 15 + 1 + (o_orderkey // 14) % 14) % 15 AS z
  FROM orders),
requests AS (
  SELECT strftime(d, '%d/%m/%Y') AS date1, strftime(d + 2, '%d/%m/%Y') AS date2,
    air[CAST(x AS INT) + 1] AS origin, air[CAST(y AS INT) + 1] AS via, air[CAST(z AS INT) + 1] AS destination
  FROM wishes, lists)
SELECT r.*, a.flight AS flight1, a.departure_time AS departure_time1, a.delay AS delay1,
  b.flight AS flight2, b.departure_time AS departure_time2, b.delay AS delay2
FROM requests r
JOIN xyz a ON a.departure_date = r.date1 AND a.period = 'AM'
  AND a.origin = r.origin AND a.destination = r.via
JOIN xyz b ON b.departure_date = r.date2 AND b.period = 'PM'
  AND b.origin = r.via AND b.destination = r.destination
"""

# Lines are put together and damaged as text, then read again field by field.
LINES_SQL = f"""
WITH {FLIGHTS_SQL},
whole AS (
  SELECT tax, concat_ws(' ', strftime(flight_date, '%Y-%m-%d'), weekday, carrier_id, carrier,
    flight_num, origin, destination, dep_time, dep_delayed, arr_time, arr_delay || '.00',
    arr_delayed || '.00') AS line
  FROM flights),
lines AS (
  SELECT CASE tax
    WHEN 0.05 THEN array_to_string(string_split(line, ' ')[:10], ' ') || ' x ' || string_split(line, ' ')[12]
    WHEN 0.06 THEN replace(line, '2008-0', '2008-')
    WHEN 0.07 THEN array_to_string(string_split(line, ' ')[:5], ' ')
    WHEN 0.08 THEN array_to_string(string_split(line, ' ')[:11], ' ') || ' '
    ELSE line END AS value
  FROM whole),
fields AS (SELECT value, string_split(rtrim(value, ' '), ' ') AS f FROM lines),
typed AS (
  SELECT value, len(f) AS n_fields,
    CASE WHEN length(f[1]) = 10 THEN TRY_CAST(f[1] AS DATE) END AS flight_date,
    f[2] AS weekday, f[3] AS carrier_id, f[4] AS carrier, f[5] AS flight_num, f[6] AS origin,
    f[7] AS destination, f[8] AS dep_time,
    CAST(trunc(TRY_CAST(f[9] AS FLOAT)) AS INTEGER) AS dep_delayed, f[10] AS arr_time,
    CAST(trunc(TRY_CAST(f[11] AS FLOAT)) AS INTEGER) AS arr_delay,
    CAST(trunc(TRY_CAST(f[12] AS FLOAT)) AS INTEGER) AS arr_delayed
  FROM fields)
"""


def _question_of(name: str) -> str:
    """The question a query answers in another form, such as ``stream_shared_weekday_rank``."""
    return next(q for q in QUESTIONS if name.endswith(f"_{q}"))


TALLY_SQL = f"""
WITH {FLIGHTS_SQL}
SELECT {{keys}}, CAST(sum({{measure}}) AS BIGINT) AS total, count(*) AS n FROM flights GROUP BY ALL
"""


def _tally_sql(name: str) -> str:
    if name == "airport_top10":
        return f"""WITH {FLIGHTS_SQL}
            SELECT airport, count(*) AS n FROM
            (SELECT origin AS airport FROM flights UNION ALL SELECT destination FROM flights)
            GROUP BY airport"""
    if name == "best_flight":
        columns = "flight_date, period, origin, destination, arr_delay, dep_time, flight"
        return f"{BEST_FLIGHT_SQL} SELECT {columns} FROM best"
    *keys, measure = QUESTIONS[name].columns
    return TALLY_SQL.format(keys=", ".join(keys), measure=measure)


def oracle_sql() -> dict[str, str]:
    best = f"{BEST_FLIGHT_SQL} SELECT * FROM xyz"
    answers = {
        "airport_top10": AIRPORT_TOP10_SQL,
        "weekday_rank": WEEKDAY_SQL,
        "origin_top10_destinations": DESTINATIONS_SQL,
        "pair_top10_carriers": CARRIERS_SQL,
        "pair_mean_delay": MEAN_SQL.format(where="true"),
        "best_flight": best,
    }
    rejected = f"""{LINES_SQL}
        SELECT value, CASE
          WHEN flight_date IS NULL THEN 'unreadable flight_date'
          WHEN n_fields < 6 THEN 'missing origin'
          WHEN arr_delay IS NULL THEN 'unreadable arr_delay'
          ELSE 'missing arr_delayed' END AS reason
        FROM typed WHERE n_fields < 12 OR flight_date IS NULL OR arr_delay IS NULL"""
    damaged = f"""{LINES_SQL}
        SELECT {{}} FROM typed WHERE {{}}(n_fields >= 6 AND arr_delay IS NOT NULL)"""
    prefixes = ("lines_", "stream_", "resumed_", "merged_", "shared_", "republished_")
    prefixes += ("state_", "maintained_", "seeded_", "landed_")
    forms = [n for n in queries() if n.startswith(prefixes) and n.endswith(tuple(QUESTIONS)) and "damaged" not in n]
    forms.remove("stream_landed_pair_mean_delay")
    february = MEAN_SQL.format(where="flight_date >= DATE '2008-02-01' AND flight_date < DATE '2008-03-01'")
    damaged_mean = damaged.format(
        "origin, destination, CAST(CAST(sum(arr_delay) AS FLOAT) / CAST(count(*) AS FLOAT) AS FLOAT) AS mean_delay", ""
    )
    damaged_mean += " GROUP BY origin, destination"
    return {
        **answers,
        **{name: answers[_question_of(name)] for name in forms},
        **{f"tally_{name}": _tally_sql(name) for name in QUESTIONS},
        "parse_lines": f"""{LINES_SQL}
            SELECT * EXCLUDE (value, n_fields) FROM typed
            WHERE n_fields = 12 AND flight_date IS NOT NULL AND arr_delay IS NOT NULL""",
        "stream_airport_top10_idle": AIRPORT_TOP10_FROM.format(where="l_linenumber > 3"),
        "rejects": rejected,
        "stream_rejects": rejected,
        "airport_tokens": f"""
            WITH {FLIGHTS_SQL}
            SELECT origin AS airport FROM flights UNION ALL SELECT destination FROM flights""",
        "lookup_origins_in": f"""
            SELECT * FROM ({DESTINATIONS_SQL}) WHERE origin IN ('SRQ', 'CMH', 'JFK', 'SEA', 'BOS')""",
        "lookup_pair_carriers": f"""
            SELECT * FROM ({CARRIERS_SQL}) WHERE origin = 'LGA' AND destination = 'BOS'""",
        "lookup_pair_mean": MEAN_SQL.format(where="origin = 'LGA' AND destination = 'BOS'"),
        "lookup_pair_mean_two": MEAN_SQL.format(
            where="(origin = 'BOS' AND destination = 'LGA') OR (origin = 'MSP' AND destination = 'ATL')"
        ),
        "lookup_best_flight": f"""{best} WHERE departure_date = '24/01/2008' AND period = 'AM'
            AND origin = 'DFW' AND destination = 'STL'""",
        "two_leg_trips": TRIPS_SQL,
        "backfill_all": AIRPORT_TOP10_SQL,
        "backfill_glob": MEAN_SQL.format(where="flight_date < DATE '2008-02-01'"),
        "backfill_on_all": answers["pair_mean_delay"],
        "backfill_by_name": february,
        "landed_february": february,
        "landed_damaged_pair_mean_delay": damaged_mean,
        "stream_landed_pair_mean_delay": damaged_mean,
        "landed_damaged_rejects": rejected,
        "stream_damaged_counts": f"""{LINES_SQL}
            SELECT count(*) AS n_read, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad
            FROM (SELECT n_fields >= 6 AND arr_delay IS NOT NULL AS good FROM typed)""",
        "stream_damaged_pair_mean_delay": damaged_mean,
        "stream_damaged_pair_mean_delay_rejects": damaged.format(
            "value, CASE WHEN n_fields < 6 THEN 'missing origin' ELSE 'unreadable arr_delay' END AS reason", "NOT "
        ),
        "typed_nulls_pair_mean_delay": MEAN_SQL.format(where="tax <> 0.05"),
        "typed_nulls_best_flight": BEST_FLIGHT_FROM.format(where="tax NOT IN (0.05, 0.06)") + " SELECT * FROM xyz",
        **LLM_SQL,
    }
