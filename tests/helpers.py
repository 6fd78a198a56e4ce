"""Small builders and plain-Python twins the tests compare with."""

import contextlib
import io
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from ticksmith import add_event_time
from ticksmith.schemas import SILVER

TRADE_ROWS = "arrival bigint, symbol string, timestamp bigint, price double, volume double"
# 2024-01-01 00:00:00 UTC
START = 1_704_067_200_000
MINUTE = 60_000


def trade_rows(spark, rows):
    """(arrival, symbol, timestamp, price, volume) rows, spread over several partitions."""
    return spark.createDataFrame(rows, TRADE_ROWS).repartition(3)


def silver_rows(spark, rows):
    """(symbol, timestamp, price, volume) rows in the silver layout."""
    plain = spark.createDataFrame(
        rows, "symbol string, timestamp bigint, price double, volume double"
    )
    return (
        add_event_time(plain)
        .withColumn("conditions", F.lit(None).cast("array<int>"))
        .select(*SILVER.names)
    )


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def clean_by_hand(rows, mode="dedup_first"):
    """First (symbol, timestamp) by arrival over (arrival, symbol, timestamp, price, ...)."""
    good = [r for r in rows if r[3] is not None and r[3] > 0 and r[1] is not None]
    first = {}
    for row in sorted(good if mode == "filter_first" else rows, key=lambda r: r[0]):
        first.setdefault((row[1], row[2]), row)
    kept = first.values()
    return sorted(r for r in kept if r[1] is not None and r[3] is not None and r[3] > 0)


def candles_by_hand(rows, width_ms=MINUTE):
    """{(symbol, start ms): (open, high, low, close, volume)} of rows unique per key."""
    groups = {}
    for _, symbol, timestamp, price, volume in rows:
        if timestamp is not None:
            groups.setdefault((symbol, timestamp // width_ms * width_ms), []).append(
                (timestamp, price, volume)
            )
    result = {}
    for key, trades in groups.items():
        trades.sort()
        prices = [price for _, price, _ in trades]
        volumes = sum(volume for _, _, volume in trades)
        result[key] = (prices[0], max(prices), min(prices), prices[-1], volumes)
    return result


def candles_as_dict(df):
    return {
        (r["symbol"], r["start"]): (r["open"], r["high"], r["low"], r["close"], r["volume"])
        for r in df.withColumn("start", F.unix_millis("candle_time")).collect()
    }


def utc(millis):
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(milliseconds=millis)
