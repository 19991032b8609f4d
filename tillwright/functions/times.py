"""Time-zone-free time arithmetic on timestamps without zone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwright.schemas import TIME_TEXT

SECOND_US = 1_000_000


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 on the clock the value shows, whatever the session zone is."""
    day = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    second = F.extract(F.lit("SECOND"), ts)  # decimal(8,6)
    return ((day * 24 + F.hour(ts)) * 60 + F.minute(ts)) * (60 * SECOND_US) + (second * SECOND_US).cast("bigint")


def from_micros(value: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(microseconds=value)


def floor_to(value: Column, step: int) -> Column:
    """Largest multiple of ``step``, a power of two, that is not above ``value``."""
    return value.bitwiseAND(F.lit(-step).cast("bigint"))


def parse_time(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit(TIME_TEXT))


def format_time(ts: Column) -> Column:
    """Text down to whole seconds; the cast of a zone-less time does not consult the session zone."""
    return F.substring(ts.cast("string"), 1, len(TIME_TEXT))
