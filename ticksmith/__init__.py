"""Spark-native trade-to-candle engine: JSON trade messages to clean trades to OHLCV candles."""

from ticksmith.config import PipelineConfig
from ticksmith.operators import (
    add_event_time,
    candles,
    clean_trades,
    filter_symbols,
    parse_trades,
    rejected_messages,
    route_messages,
    to_messages,
)
from ticksmith.plans import STAGES, batch_candles, chained_candles, run

__all__ = [
    "STAGES",
    "PipelineConfig",
    "add_event_time",
    "batch_candles",
    "candles",
    "chained_candles",
    "clean_trades",
    "filter_symbols",
    "parse_trades",
    "rejected_messages",
    "route_messages",
    "run",
    "to_messages",
]
