"""Times as microseconds and periods; all arithmetic is on integers, so no zone is involved."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def micros(col: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp with or without zone, read as UTC (the session zone has to be UTC)."""
    return F.unix_micros(F.col(col).cast("timestamp") if isinstance(col, str) else col.cast("timestamp"))


def floor_to(us: Column, seconds: int) -> Column:
    """Start of the period of ``seconds`` that holds ``us``, in microseconds; right before 1970 too."""
    step = seconds * MICROS
    return us - F.pmod(us, F.lit(step))


def second_text(us: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of microseconds, as UTC."""
    return F.date_format(F.timestamp_micros(us), "yyyy-MM-dd HH:mm:ss")


def milli_text(us: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS`` of microseconds, as UTC, cut after the millisecond."""
    return F.date_format(F.timestamp_micros(us), "yyyy-MM-dd HH:mm:ss.SSS")
