"""Counts of what a stream holds, taken as its rows pass; see `delivery_report`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.functions import envelope_trades, reject_reason

# The reasons that `reject_reason` gives.
_REASONS = ("null", "malformed", "no_data", "empty")


def count_messages(messages: DataFrame, name: str = "messages") -> DataFrame:
    """The same messages; counts those ``read``, those with trades (``accepted``) and the others by
    reason (``rejected_null`` and so on). Each message is parsed once more for it."""
    value = F.col("value")
    accepted = F.coalesce(F.size(envelope_trades(value)), F.lit(0)) > 0
    reason = F.when(~accepted, reject_reason(value))
    return messages.observe(
        name,
        F.count(F.lit(1)).alias("read"),
        F.count_if(accepted).alias("accepted"),
        *[F.count_if(reason == r).alias(f"rejected_{r}") for r in _REASONS],
    )


def count_trades(trades: DataFrame, name: str = "trades") -> DataFrame:
    """The same trades; counts those ``read``, those without a symbol (``no_symbol``) and, of the
    others, those whose price is not positive or missing (``bad_price``)."""
    named = F.col("symbol").isNotNull()
    bad = ~F.coalesce(F.col("price") > 0, F.lit(False))
    return trades.observe(
        name,
        F.count(F.lit(1)).alias("read"),
        F.count_if(~named).alias("no_symbol"),
        F.count_if(named & bad).alias("bad_price"),
    )


def count_rows(rows: DataFrame, name: str, measure: str) -> DataFrame:
    """The same rows, counted as ``measure``."""
    return rows.observe(name, F.count(F.lit(1)).alias(measure))
