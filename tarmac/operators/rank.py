"""Global and per-group ranking with unique positions 1..n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_k(df: DataFrame, order: Sequence[str | Column], k: int = 10) -> DataFrame:
    """The first ``k`` rows of the order with their ``rank``.

    The cut comes first, as a top-k that needs no full sort; the window then
    sees at most ``k`` rows.
    """
    rank = F.row_number().over(W.orderBy(*order)).alias("rank")
    return df.orderBy(*order).limit(k).select("*", rank)


def ranked(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """All rows with their ``rank``. One task numbers them, so the rows must be few."""
    return df.select("*", F.row_number().over(W.orderBy(*order)).alias("rank"))


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], k: int = 10
) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank``.

    Spark cuts each group to ``k`` rows before the shuffle and again after it.
    """
    window = W.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
