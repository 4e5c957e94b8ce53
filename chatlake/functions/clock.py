"""Source dates: integer nanoseconds since 2001-01-01 00:00:00 UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def integer_div(value: Column, divisor: int) -> Column:
    """Integer quotient, truncated toward zero."""
    return F.call_function("div", value, F.lit(divisor))


def source_timestamp(date: Column) -> Column:
    """UTC wall clock to the second; sub-second digits are cut, not rounded."""
    seconds = integer_div(date, 1_000_000_000)
    epoch = F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def clock_text(timestamp: Column) -> Column:
    """`YYYY-MM-DD HH:MM:SS`, whatever the session time zone."""
    return F.substring(timestamp.cast("string"), 1, 19)


def month_text(timestamp: Column) -> Column:
    return F.substring(timestamp.cast("string"), 1, 7)


def hour_text(timestamp: Column) -> Column:
    return F.lpad(F.hour(timestamp).cast("string"), 2, "0")
