"""Epoch milliseconds to event time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds beyond which Spark's microsecond timestamps overflow a bigint.
_MAX_SECONDS = (2**63 - 1) // 1_000_000


def epoch_seconds(millis: Column) -> Column:
    """Whole seconds, truncated toward zero; NULL where no timestamp can hold them.

    The bound keeps one absurd value from failing the whole job with an overflow.
    """
    seconds = F.call_function("div", millis, F.lit(1000))
    return F.when(F.abs(seconds) <= _MAX_SECONDS, seconds)


def event_time(millis: Column, precision: str = "s") -> Column:
    """Event time as a timestamp, in whole seconds (``s``) or milliseconds (``ms``)."""
    seconds = epoch_seconds(millis)
    if precision == "s":
        return F.timestamp_seconds(seconds)
    if precision == "ms":
        return F.timestamp_millis(F.when(seconds.isNotNull(), millis))
    raise ValueError(f"precision must be 's' or 'ms', got {precision!r}")


def event_text(millis: Column) -> Column:
    """Event time as ``yyyy-MM-dd HH:mm:ss`` text in the session time zone."""
    return F.from_unixtime(epoch_seconds(millis))
