"""Candles in parts: sums of some of a candle's trades, which can be merged in any order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.schemas import GOLD


def candle_parts(trades: DataFrame, width: str = "1 minute") -> DataFrame:
    """One row per symbol and tumbling window of ``time``: the candle of these trades alone, with
    the timestamps of its open and close (``open_at``, ``close_at``).

    Trades without a time are left out, as `candles` does.
    """
    window = F.window("time", width).alias("window")
    return (
        trades.groupBy("symbol", window)
        .agg(
            F.min("timestamp").alias("open_at"),
            F.min_by("price", "timestamp").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max("timestamp").alias("close_at"),
            F.max_by("price", "timestamp").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select("symbol", F.col("window.start").alias("candle_time"), *_SUMS)
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """One part per candle out of any number of them."""
    return parts.groupBy("symbol", "candle_time").agg(
        F.min("open_at").alias("open_at"),
        F.min_by("open", "open_at").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("close_at").alias("close_at"),
        F.max_by("close", "close_at").alias("close"),
        F.sum("volume").alias("volume"),
    )


def candles_of_parts(parts: DataFrame) -> DataFrame:
    """The candles that parts add up to."""
    return merge_parts(parts).select(*GOLD.names)


_SUMS = ["open_at", "open", "high", "low", "close_at", "close", "volume"]
