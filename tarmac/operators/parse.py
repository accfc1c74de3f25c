"""Text lines to typed flights, rejects and airport tokens."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import padded_date, whole_number
from tarmac.schema import ON_TIME

FIELDS = tuple(ON_TIME.names)


def _fields(lines: DataFrame) -> DataFrame:
    """One row per line with its fields as an array, split once.

    Spaces at the end are dropped first, so a line has no empty fields at its
    end. The one-element explode keeps the split out of the filters above it: as
    a plain projection, Catalyst would push those filters below it and split the
    line again for every column tested (2 to 5 times slower over whole lines).
    """
    return lines.select("value", F.explode(F.array(F.split(F.rtrim("value"), " "))).alias("fields"))


def _raw(column: str) -> Column:
    return F.get("fields", F.lit(FIELDS.index(column)))


def _readable(column: str) -> Column:
    raw, kind = _raw(column), ON_TIME[column].dataType.typeName()
    if column == "dep_time":
        return raw.try_cast("int").isNotNull()
    if kind == "date":
        return padded_date(raw).isNotNull()
    return (raw.try_cast("float") if kind == "integer" else raw).isNotNull()


def _typed(column: str) -> Column:
    raw, kind = _raw(column), ON_TIME[column].dataType.typeName()
    if kind == "date":
        return padded_date(raw)
    return whole_number(raw) if kind == "integer" else raw


def _all_readable(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [_readable(c) for c in columns])


def _reason(columns: Sequence[str]) -> Column:
    """The first field at fault."""
    faults = [F.when(_raw(c).isNull(), f"missing {c}").when(~_readable(c), f"unreadable {c}") for c in columns]
    return F.coalesce(*faults)


def parse_on_time(
    lines: DataFrame,
    columns: Sequence[str] = FIELDS,
    mode: str = "permissive",
    observe: str | None = None,
) -> DataFrame:
    """The given columns of ``on-time`` lines (``value STRING``), typed as ``ON_TIME``.

    Only the columns asked for are read and tested, so a line is bad for a
    question only if a field that question needs is missing or unreadable.
    ``permissive`` leaves bad lines out (``rejects`` has them), ``strict`` raises.
    Works on a stream as on a table. ``observe`` names metrics of the same pass: the
    lines read (``n_read``) and those among them that are good (``n_good``).
    """
    if mode not in ("permissive", "strict"):
        raise ValueError(f"mode must be permissive or strict, not {mode!r}")
    good = _all_readable(columns)
    if mode == "strict":
        bad = F.raise_error(F.concat(F.lit("bad on-time line: "), F.coalesce("value", F.lit("null"))))
        good = F.when(good, True).otherwise(bad.cast("boolean"))
    fields = _fields(lines)
    if observe is not None:
        # Tested once, below the counting.
        fields, good = fields.withColumn("good", good), F.col("good")
        fields = fields.observe(observe, F.count(F.lit(1)).alias("n_read"), F.count_if(good).alias("n_good"))
    return fields.filter(good).select(*[_typed(c).alias(c) for c in columns])


def landed(lines: DataFrame) -> DataFrame:
    """Every line once: its fields typed, null where unreadable, and of a bad line the text and the reason.

    A line that one question cannot use may do for another, so ``readable`` picks by question.
    """
    month = F.date_format(_typed("flight_date"), "yyyy-MM").alias("month")
    bad = F.when(~_all_readable(FIELDS), F.col("value")).alias("value")
    typed = [_typed(c).alias(c) for c in FIELDS]
    return _fields(lines).select(*typed, bad, F.when(~_all_readable(FIELDS), _reason(FIELDS)).alias("reason"), month)


def readable(flights: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Typed flights that have all the columns, by the rule that ``parse_on_time`` has for lines."""
    tests = [
        F.col(c).try_cast("int").isNotNull() if c == "dep_time" else F.col(c).isNotNull()
        for c in columns
    ]
    return flights.filter(reduce(Column.__and__, tests))


def rejects(lines: DataFrame, columns: Sequence[str] = FIELDS) -> DataFrame:
    """Lines that ``parse_on_time`` leaves out, with the first field at fault."""
    return _fields(lines).filter(~_all_readable(columns)).select("value", _reason(columns).alias("reason"))


def airport_tokens(lines: DataFrame) -> DataFrame:
    """One row per space-separated token of ``origin-destination`` lines, empty ones dropped."""
    return lines.select(F.explode(F.split("value", " ")).alias("airport")).filter("airport <> ''")
