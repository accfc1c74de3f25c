"""Kafka topics of text records. Needs the spark-sql-kafka package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ON_TIME_TOPIC = "on-time"
ORIGIN_DESTINATION_TOPIC = "origin-destination"


def kafka_options(servers: str, topic: str, **options: str | int) -> dict[str, str | int]:
    """Reader options: the whole topic from its earliest offset unless ``options`` say otherwise."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **options,
    }


def kafka_lines(
    spark: SparkSession, servers: str, topic: str, *, stream: bool = True, **options: str | int
) -> DataFrame:
    """``value STRING`` of a topic's records; ``maxOffsetsPerTrigger`` bounds a micro-batch."""
    reader = spark.readStream if stream else spark.read
    records = reader.format("kafka").options(**kafka_options(servers, topic, **options)).load()
    return records.selectExpr("CAST(value AS STRING) AS value")
