"""Trades and messages derived row by row from the given tables (rules in FIXTURES.md).

No feed shuffles: every trade and message comes from one table row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COPY_OFFSET = 1_000_000_000

_TRUNCATED = '{"type":"trade","data":[{"c":[1],"p":10'
_PING = '{"type":"ping"}'
_EMPTY = '{"type":"trade","data":[]}'


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A glob, since a stream takes no path that names a single file.
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")


def trades(event_rows: DataFrame, copies: bool = True) -> DataFrame:
    """Feed E: events as trades with bad prices, missing symbols and late copies."""
    event_id = F.col("event_id")
    numbers = F.array(F.lit(0).cast("bigint"))
    if copies:
        both = F.array(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))
        numbers = F.when((event_id % 97 == 0) | (event_id % 89 == 0), both).otherwise(numbers)
    return event_rows.withColumn("copy", F.explode(numbers)).select(
        (event_id + F.col("copy") * COPY_OFFSET).alias("arrival"),
        F.array((F.col("user_id") % 50).cast("int")).alias("conditions"),
        (_signed_value(F.col("copy")) + F.col("copy")).alias("price"),
        _symbol().alias("symbol"),
        _millis(F.col("ts")).alias("timestamp"),
        F.get_json_object("props", "$.k").try_cast("double").alias("volume"),
    )


def late_copies(event_rows: DataFrame) -> DataFrame:
    """The copied trades one millisecond later, for streams that do not deduplicate."""
    copied = trades(event_rows).where(F.col("arrival") >= COPY_OFFSET)
    return copied.withColumn("timestamp", F.col("timestamp") + 1)


def messages(trade_rows: DataFrame) -> DataFrame:
    """Feed M: one message of one to three fills per trade, and extra unusable messages.

    ``message_id`` rises with arrival. Extras follow the trades that are not copies.
    """
    arrival = F.col("arrival")
    event_id = arrival % COPY_OFFSET
    original = arrival < COPY_OFFSET
    fills = F.transform(
        F.sequence(F.lit(0), (event_id % 3).cast("int")),
        lambda n: F.struct(
            F.col("conditions").alias("c"),
            (F.col("price") + n).alias("p"),
            F.col("symbol").alias("s"),
            (F.col("timestamp") + n).alias("t"),
            F.col("volume").alias("v"),
        ),
    )
    trade = F.to_json(F.struct(F.lit("trade").alias("type"), fills.alias("data")))
    texts = F.array(
        _text(0, F.lit(True), trade),
        _text(1, original & (event_id % 83 == 0), F.lit(_PING)),
        _text(2, original & (event_id % 79 == 0), F.lit(_TRUNCATED)),
        _text(3, original & (event_id % 73 == 0), F.lit(_EMPTY)),
        _text(4, original & (event_id % 71 == 0), F.lit(None).cast("string")),
    )
    return trade_rows.select(
        arrival, F.inline(F.filter(texts, lambda text: text["present"]))
    ).select(
        (arrival * 10 + F.col("kind")).alias("message_id"),
        F.lit(None).cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
    )


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed L: line items as trades, where (symbol, timestamp) repeats by nature."""
    lineitem = _utc(spark).read.parquet(f"{sf_dir}/lineitem.parquet")
    return lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("arrival"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_partkey").cast("string").alias("symbol"),
        _millis(F.col("l_shipdate")).alias("timestamp"),
        F.col("l_quantity").alias("volume"),
    )


def midpoint_millis(event_rows: DataFrame) -> int:
    """Epoch ms halfway between the first and the last event."""
    millis = _millis(F.col("ts"))
    first, last = event_rows.agg(F.min(millis), F.max(millis)).first()
    return (first + last) // 2


def _utc(spark: SparkSession) -> SparkSession:
    # The tables' timestamps have no zone; the oracles read them as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _symbol() -> Column:
    return F.when(F.col("event_id") % 101 != 0, F.col("event_type"))


def _signed_value(copy: Column) -> Column:
    """Some originals are bad and their copies good, and the reverse."""
    bad = ((copy == 0) & (F.col("event_id") % 89 == 0)) | (
        (copy == 1) & (F.col("event_id") % 291 == 0)
    )
    return F.when(bad, -F.col("value")).otherwise(F.col("value"))


def _text(kind: int, present: Column, text: Column) -> Column:
    return F.struct(
        F.lit(kind).cast("bigint").alias("kind"), present.alias("present"), text.alias("text")
    )
