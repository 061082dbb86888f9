"""Column expressions that turn delivered text into typed values and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def whole_number(text: Column) -> Column:
    """Text to bigint: surrounding blanks and single underscores between digits are fine."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    digits = F.regexp_replace(trimmed, "_", "")
    return F.when(trimmed.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), digits.try_cast("bigint"))


def iso_midnight(text: Column) -> Column:
    """``yyyy-M-d`` text to midnight of that day, null for anything else.

    The value stays free of time zones, so no session setting can move it.
    """
    day = F.when(text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_date(text, "yyyy-M-d"))
    return day.cast("timestamp_ntz")


def as_moment(value: Column, dtype: T.DataType) -> Column:
    """A date-like value of the given type as timestamp_ntz; null for other types."""
    if isinstance(dtype, T.StringType):
        return iso_midnight(value)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def moment_text(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, with six decimals only when there is a fraction."""
    text = moment.cast("string")
    return F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)
