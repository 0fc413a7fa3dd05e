"""Dates and instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.numeric import blank_to_null


def to_day(c: Column) -> Column:
    """Date of a date, timestamp or text column; text that is no date gives NULL."""
    return c.try_cast("date")


def day_text(c: Column) -> Column:
    """``yyyy-MM-dd`` text of a date, timestamp or text column."""
    return F.date_format(to_day(c), "yyyy-MM-dd")


def to_instant(c: Column) -> Column:
    """Instant of ISO text. Text without an offset is read as UTC, whatever the
    session zone is; text that is no timestamp gives NULL."""
    text = blank_to_null(c.cast("string"))
    dated = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.concat(text, F.lit("T00:00:00"))).otherwise(text)
    zoned = F.when(dated.rlike(r"([Zz]|[+-]\d{2}:?\d{2})$"), dated).otherwise(F.concat(dated, F.lit("Z")))
    return zoned.try_cast("timestamp")


def instant_of(c: Column, type_name: str) -> Column:
    """Instant of a text, instant or zone-less timestamp column."""
    if type_name == "timestamp":
        return c
    if type_name == "timestamp_ntz":
        return to_instant(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return to_instant(c)
