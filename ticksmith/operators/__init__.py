"""DataFrame-to-DataFrame steps; each takes batch and streaming input."""

from ticksmith.operators.candles import candles
from ticksmith.operators.cleaning import clean_trades, filter_symbols
from ticksmith.operators.messages import (
    parse_trades,
    rejected_messages,
    route_messages,
    to_messages,
)
from ticksmith.operators.symbol_clock import symbol_clock_candles
from ticksmith.operators.timing import add_event_time

__all__ = [
    "add_event_time",
    "candles",
    "clean_trades",
    "filter_symbols",
    "parse_trades",
    "rejected_messages",
    "route_messages",
    "symbol_clock_candles",
    "to_messages",
]
