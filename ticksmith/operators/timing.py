"""Event-time columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.functions import event_text, event_time


def add_event_time(trades: DataFrame, precision: str = "s") -> DataFrame:
    """Add ``time_stamp`` (text) and ``time`` (timestamp) from epoch-ms ``timestamp``.

    ``time`` comes straight from the number, so an hour repeated by a clock change keeps
    its two instants apart, which the text in ``time_stamp`` cannot.
    """
    millis = F.col("timestamp")
    return trades.withColumns(
        {"time_stamp": event_text(millis), "time": event_time(millis, precision)}
    )
