"""Flight lines parsed once, as a typed table by month with the bad lines beside the good.

A backfill that answers several questions, or one question again, reads this table
instead of splitting the text anew: only the columns a question needs, and only the
months asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tarmac.operators.parse import landed
from tarmac.schema import ON_TIME

MONTH = "month"
LANDED = T.StructType([*ON_TIME, *(T.StructField(c, T.StringType()) for c in ("value", "reason", MONTH))])


def land(lines: DataFrame, folder: str) -> None:
    """Append ``on-time`` lines to the typed table in one pass, without a shuffle.

    Files of one month each stay whole; where months are mixed, a task writes a file a month.
    """
    landed(lines).write.mode("append").partitionBy(MONTH).parquet(folder)


def start_landing(lines: DataFrame, folder: str, checkpoint: str, *, trigger: Mapping[str, Any]) -> StreamingQuery:
    """The same for a stream; a replayed batch adds no line twice."""
    writer = landed(lines).writeStream.format("parquet").outputMode("append").partitionBy(MONTH)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(folder)


def landed_lines(spark: SparkSession, folder: str, months: Sequence[str] | None = None) -> DataFrame:
    """The typed table, of the given months (``yyyy-MM``) or whole. Lines without a readable date have none."""
    rows = spark.read.schema(LANDED).parquet(folder)
    return rows if months is None else rows.filter(F.col(MONTH).isin(*months))


def landed_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The bad lines and the first field at fault, as ``rejects`` gives them."""
    return landed_lines(spark, folder).filter("reason IS NOT NULL").select("value", "reason")


def airports_of(flights: DataFrame) -> DataFrame:
    """The airport tokens of typed flights, for the question on airports."""
    ends = flights.filter("origin IS NOT NULL AND destination IS NOT NULL")
    return ends.select(F.explode(F.array("origin", "destination")).alias("airport"))
