"""Percent and mean in 32-bit floats.

Every step is cast back to FLOAT: Spark types ``float / float`` and
``float * literal`` as DOUBLE, and a 64-bit percent truncates to another whole
number in some cases (53 of 100 is 52 in 32 bits).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean32(total: Column, n: Column) -> Column:
    """``total / n`` as FLOAT."""
    return (total.cast("float") / n.cast("float")).cast("float")


def pct32(part: Column, n: Column) -> Column:
    """``part`` as a percent of ``n``, as FLOAT."""
    return (mean32(part, n) * F.lit(100).cast("float")).cast("float")


def pct32_int(part: Column, n: Column) -> Column:
    """``pct32`` with its fraction cut off, as INT."""
    return pct32(part, n).cast("int")
