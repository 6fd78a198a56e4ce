"""Tumbling-window candles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.functions import ohlcv
from ticksmith.schemas import GOLD


def candles(
    trades: DataFrame,
    width: str = "1 minute",
    watermark: str | None = "2 minutes",
    order: str = "event_time",
) -> DataFrame:
    """OHLCV per symbol and tumbling window of ``time``, named by the window start.

    A stream in append mode emits a candle once, when the watermark reaches its end, and
    drops rows of windows already closed; a batch gives every window. Pass
    ``watermark=None`` where the stream already carries one.
    """
    if watermark is not None and trades.isStreaming:
        trades = trades.withWatermark("time", watermark)
    return (
        trades.groupBy("symbol", F.window("time", width).alias("window"))
        .agg(*ohlcv(order))
        .withColumn("candle_time", F.col("window.start"))
        .select(*GOLD.names)
    )
