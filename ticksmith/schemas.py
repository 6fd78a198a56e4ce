"""Declared schemas of every layer, in column order."""

from pyspark.sql import types as T

# The short field names of the message format.
TRADE = T.StructType(
    [
        T.StructField("c", T.ArrayType(T.IntegerType())),
        T.StructField("p", T.DoubleType()),
        T.StructField("s", T.StringType()),
        T.StructField("t", T.LongType()),
        T.StructField("v", T.DoubleType()),
    ]
)

ENVELOPE = T.StructType([T.StructField("data", T.ArrayType(TRADE))])

MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("conditions", T.ArrayType(T.IntegerType())),
        T.StructField("price", T.DoubleType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("volume", T.DoubleType()),
    ]
)

TRANSFORMED = T.StructType(
    BRONZE.fields
    + [
        T.StructField("time_stamp", T.StringType()),
        T.StructField("time", T.TimestampType()),
    ]
)

SILVER = TRANSFORMED

GOLD = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("candle_time", T.TimestampType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
    ]
)
