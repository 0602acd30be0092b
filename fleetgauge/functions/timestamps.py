"""Instants: RFC 3339 text, epoch seconds and whole-second truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: date, T, time, optional fraction and a mandatory zone.
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})$"

# Seconds of 0001-01-01 and 9999-12-31T23:59:59, the range RFC 3339 can write.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799


def parse_rfc3339(text: Column) -> Column:
    """The instant, or null where the text is not a complete RFC 3339 time that exists."""
    return F.when(text.rlike(RFC3339), F.try_to_timestamp(F.translate(text, ",", ".")))


def format_rfc3339(ts: Column) -> Column:
    """Whole seconds in UTC, whatever the session zone is."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def from_epoch_seconds(number: Column) -> Column:
    """Seconds cut toward zero; null outside the years 1-9999."""
    whole = F.when(number.between(_FIRST_SECOND, _LAST_SECOND), number).cast("bigint")
    return F.timestamp_seconds(whole)


def to_epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def cut_to_second(ts: Column) -> Column:
    return F.date_trunc("second", ts)
