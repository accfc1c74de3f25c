"""Conversions from the text fields of a record.

The conversions give null for text they cannot read, whether ANSI mode is on or
off, so the caller decides between rejecting and raising.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def whole_number(text: Column) -> Column:
    """Decimal text to INT, fraction cut off: ``16.99`` is 16, ``-16.9`` is -16.

    Read as a 32-bit float. NaN counts as 0 and values beyond INT end at its
    bounds, as a JVM float-to-int conversion does.
    """
    value = text.try_cast("float").cast("double")
    bounded = F.least(F.greatest(value, F.lit(float(INT_MIN))), F.lit(float(INT_MAX)))
    return F.when(F.isnan(value), 0).when(value.isNotNull(), bounded.cast("int"))


def padded_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text to DATE; months and days need both digits.

    A cast reads more forms than this one; the test leaves it only this one.
    """
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))


def half_day(hhmm: Column) -> Column:
    """AM before 1200, otherwise PM (so ``0000`` is AM and ``2400`` is PM)."""
    return F.when(hhmm.cast("int") < 1200, "AM").otherwise("PM")
