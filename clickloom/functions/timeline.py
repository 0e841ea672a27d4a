"""Time expressions. The session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60 * MICROS_PER_SECOND


def day_index(ts: Column | str) -> Column:
    """Whole days since 1970-01-01."""
    return F.unix_date(F.to_date(ts))


def epoch_micros(ts: Column | str) -> Column:
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(column.cast("timestamp"))


def elapsed_minutes(start_us: Column, end_us: Column, whole_seconds: bool = True) -> Column:
    """Minutes between two epoch-microsecond columns, start not after end."""
    micros = end_us - start_us
    if whole_seconds:
        return F.floor(micros / F.lit(float(MICROS_PER_SECOND))) / F.lit(60.0)
    return micros / F.lit(60.0 * MICROS_PER_SECOND)


def elapsed_hours(start: Column, end: Column) -> Column:
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(3600.0 * MICROS_PER_SECOND)
