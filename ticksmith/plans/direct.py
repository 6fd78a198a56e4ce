"""Messages to candles without stored layers in between."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.operators import add_event_time, candles, clean_trades, parse_trades


def batch_candles(
    messages: DataFrame,
    message_id: str | Sequence[str],
    width: str = "1 minute",
    mode: str = "dedup_first",
    precision: str = "s",
) -> DataFrame:
    """All candles of a batch of messages; ``message_id`` orders their arrival.

    One integer column, any bigint but NULL, keeps the plan free of sorts. Where one column
    repeats, as offsets do across partitions, name several that together do not.

    Cleaning needs no time column, so it runs before one is added and its shuffle carries
    symbol, timestamp, price, volume and arrival only.
    """
    ids = [message_id] if isinstance(message_id, str) else list(message_id)
    trades = parse_trades(messages, carry=ids, position="_position")
    if len(ids) == 1:
        arrival = _arrival(F.col(ids[0]), F.col("_position"))
    else:
        arrival = F.struct(*ids, "_position")
    trades = trades.withColumn("_arrival", arrival).drop(*ids, "_position")
    clean = clean_trades(trades, mode, arrival="_arrival")
    return candles(add_event_time(clean, precision), width)


def chained_candles(
    messages: DataFrame,
    within: str | None = "10 minutes",
    width: str = "1 minute",
    watermark: str = "2 minutes",
    mode: str = "dedup_first",
    precision: str = "s",
    collapse_copies: bool = True,
) -> DataFrame:
    """One streaming query from messages to candles: dedup state feeding window state.

    A query has one watermark, so with bounded dedup ``within`` also decides when a candle
    closes; ``within=None`` keeps the dedup unbounded and closes candles by ``watermark``.
    """
    trades = add_event_time(parse_trades(messages), precision)
    needed = trades.select("symbol", "timestamp", "time", "price", "volume")
    clean = clean_trades(needed, mode, within=within, collapse_copies=collapse_copies)
    return candles(clean, width, watermark if within is None else None)


def _arrival(message_id: Column, position: Column) -> Column:
    """Any bigint id and int position as one number, which the dedup can hash-aggregate by."""
    wide = message_id.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    packed = wide * F.lit(2**31).cast("decimal(11,0)") + position.cast("decimal(11,0)")
    return F.when(message_id.isNotNull(), packed.cast("decimal(38,0)")).otherwise(
        F.raise_error(F.lit("a message id is NULL"))
    )
