"""Routing, parsing, rejecting and writing of JSON trade messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.functions import envelope_trades, message_type, reject_reason
from ticksmith.schemas import BRONZE


def route_messages(messages: DataFrame, kind: str = "trade") -> DataFrame:
    """Keep the messages whose JSON ``type`` is ``kind``, bytes untouched."""
    return messages.where(message_type(F.col("value")) == kind)


def parse_trades(
    messages: DataFrame, carry: Sequence[str] = (), position: str | None = None
) -> DataFrame:
    """One row per trade in each message's ``data`` array, in the bronze column order.

    ``carry`` names message columns to keep in front and ``position`` a column for the
    trade's place in its message; together they record arrival for `clean_trades`. Their
    names must differ from the trade columns: rename Kafka's ``timestamp`` to carry it.
    Messages without trades give no row, see `rejected_messages`.
    """
    clash = {*carry, position} & set(BRONZE.names)
    if clash:
        raise ValueError(f"{sorted(clash)} would clash with the trade columns, rename first")
    trades = envelope_trades(F.col("value"))
    if position is None:
        exploded = messages.select(*carry, F.explode(trades).alias("trade"))
        kept = list(carry)
    else:
        exploded = messages.select(*carry, F.posexplode(trades).alias(position, "trade"))
        kept = [*carry, position]
    return exploded.select(
        *kept,
        F.col("trade.c").alias("conditions"),
        F.col("trade.p").alias("price"),
        F.col("trade.s").alias("symbol"),
        F.col("trade.t").alias("timestamp"),
        F.col("trade.v").alias("volume"),
    )


def rejected_messages(messages: DataFrame) -> DataFrame:
    """The messages `parse_trades` gives no row for, with the ``reason``."""
    value = F.col("value")
    without_trades = F.coalesce(F.size(envelope_trades(value)), F.lit(0)) <= 0
    return messages.where(without_trades).withColumn("reason", reject_reason(value))


def to_messages(trades: DataFrame) -> DataFrame:
    """One message per trade: NULL key and the JSON envelope as bytes."""
    trade = F.struct(
        F.col("conditions").alias("c"),
        F.col("price").alias("p"),
        F.col("symbol").alias("s"),
        F.col("timestamp").alias("t"),
        F.col("volume").alias("v"),
    )
    envelope = F.struct(F.lit("trade").alias("type"), F.array(trade).alias("data"))
    return trades.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(envelope).cast("binary").alias("value"),
    )
