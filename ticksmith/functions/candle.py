"""Open/high/low/close/volume aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ohlcv(order: str = "event_time") -> list[Column]:
    """The five candle aggregates over ``price``, ``volume`` and ``timestamp``.

    ``event_time`` takes open and close by the bigint ``timestamp``: fixed-width buffers,
    so the plan stays a hash aggregate with map-side partials, and the result does not
    depend on partitioning once (symbol, timestamp) is unique. ``arrival`` takes whatever
    row the aggregate sees first and last.
    """
    if order == "event_time":
        opening, closing = F.min_by("price", "timestamp"), F.max_by("price", "timestamp")
    elif order == "arrival":
        opening, closing = F.first("price"), F.last("price")
    else:
        raise ValueError(f"order must be 'event_time' or 'arrival', got {order!r}")
    return [
        opening.alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        closing.alias("close"),
        F.sum("volume").alias("volume"),
    ]
