"""Days from epoch seconds, always in UTC whatever the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86400


def epoch_date(seconds: Column) -> Column:
    """UTC calendar date of an epoch second."""
    day = F.floor(seconds / SECONDS_PER_DAY).cast("int")
    return F.date_from_unix_date(day)


def active_days(first: Column, last: Column) -> Column:
    """Calendar days from the first to the last epoch second, both included."""
    return F.date_diff(epoch_date(last), epoch_date(first)) + 1


def epoch_seconds(timestamp: Column) -> Column:
    """Whole epoch seconds of a timestamp without time zone."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", origin, timestamp)
