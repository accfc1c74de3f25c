from __future__ import annotations

import bz2

import pytest
from conftest import SF_DIR, rows

from tarmac.schema import MEAN_DELAY, ON_TIME, TABLES
from tarmac.sinks.external import cassandra_options, write_cassandra, write_kafka
from tarmac.sources import kafka_lines, text_lines
from tarmac.sources.derived import flights_of, on_time_lines
from tarmac.sources.kafka import ON_TIME_TOPIC, kafka_options


def write_bz2(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.bz2").write_bytes(bz2.compress(text.encode()))


def test_compressed_files_and_name_glob(spark, tmp_path):
    names = {f"On_Time_On_Time_Performance_{y}_1": f"{y} a\n{y} b\n" for y in (2007, 2008)}
    write_bz2(tmp_path, **names)
    assert text_lines(spark, str(tmp_path)).count() == 4
    only = text_lines(spark, str(tmp_path), name_glob="On_Time_On_Time_Performance_2008_*.bz2")
    assert rows(only) == [("2008 a",), ("2008 b",)]
    assert text_lines(spark, f"{tmp_path}/*_2007_*").count() == 2
    assert text_lines(spark, str(tmp_path), name_glob="*2008*", stream=True).isStreaming


def test_kafka_options():
    options = kafka_options("b1:9092", ON_TIME_TOPIC, maxOffsetsPerTrigger=5)
    assert options["subscribe"] == "on-time" and options["startingOffsets"] == "earliest"
    assert options["kafka.bootstrap.servers"] == "b1:9092" and options["maxOffsetsPerTrigger"] == 5
    assert kafka_options("b", "t", startingOffsets="latest")["startingOffsets"] == "latest"


def test_connectors_say_what_is_missing(spark, lines_of):
    """Their packages are not installed here, so Spark must name the missing source."""
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_lines(spark, "b1:9092", ON_TIME_TOPIC)
    with pytest.raises(Exception, match="(?i)kafka"):
        write_kafka(lines_of("a"), "b1:9092", ON_TIME_TOPIC)
    empty = spark.createDataFrame([], MEAN_DELAY.schema)
    with pytest.raises(Exception, match="(?i)cassandra"):
        write_cassandra(empty, "flights", MEAN_DELAY)


def test_cassandra_options():
    assert cassandra_options("flights", MEAN_DELAY) == {"keyspace": "flights", "table": "xymeandelay"}


def test_table_keys_are_columns():
    for table in TABLES.values():
        assert set(table.key) <= set(table.schema.names)
        assert set(table.spread_by) <= set(table.key)


def test_every_lineitem_row_is_a_flight(spark, lineitem):
    flights = flights_of(lineitem)
    assert [(f.name, f.dataType) for f in flights.schema] == [(f.name, f.dataType) for f in ON_TIME]
    assert flights.count() == lineitem.count()
    assert flights.filter("origin = destination").count() == 0
    nulls = " OR ".join(f"{c} IS NULL" for c in flights.columns)
    assert flights.filter(nulls).count() == 0


def test_lines_have_twelve_fields(spark, flights):
    fields = on_time_lines(flights).selectExpr("size(split(value, ' ')) AS n").distinct()
    assert rows(fields) == [(12,)]


def test_scan_reads_only_needed_columns(spark):
    from tarmac.plans import QUESTIONS

    flights = flights_of(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"))
    plan = QUESTIONS["weekday_rank"].on_records(flights)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
