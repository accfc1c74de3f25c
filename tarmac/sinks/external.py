"""Writers for stores outside Spark. Their packages must be on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.schema import Table

CASSANDRA = "org.apache.spark.sql.cassandra"


def cassandra_options(keyspace: str, table: Table, **options: str) -> dict[str, str]:
    return {"keyspace": keyspace, "table": table.name, **options}


def write_cassandra(df: DataFrame, keyspace: str, table: Table, **options: str) -> None:
    """Upsert by the table's key (appending is an upsert in Cassandra)."""
    writer = df.select(*table.schema.names).write.format(CASSANDRA).mode("append")
    writer.options(**cassandra_options(keyspace, table, **options)).save()


def write_kafka(lines: DataFrame, servers: str, topic: str) -> None:
    """Publish text lines to a topic, to backfill it from files."""
    writer = lines.select("value").write.format("kafka")
    writer.options(**{"kafka.bootstrap.servers": servers, "topic": topic}).save()
