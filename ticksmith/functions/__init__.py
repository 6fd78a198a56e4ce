"""Column expressions shared by the operators."""

from ticksmith.functions.candle import ohlcv
from ticksmith.functions.envelope import envelope_trades, message_type, reject_reason
from ticksmith.functions.time import epoch_seconds, event_text, event_time

__all__ = [
    "envelope_trades",
    "epoch_seconds",
    "event_text",
    "event_time",
    "message_type",
    "ohlcv",
    "reject_reason",
]
