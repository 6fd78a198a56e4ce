"""Stored candle parts: the ledger that names them, and the candles they add up to.

A folder holds ``part-N`` folders, one per micro-batch, ``merged-N-...`` folders with what all
micro-batches up to N add up to, and a ledger in ``_ledger`` that names the finished ones. Only
what the ledger names is read, so a write that was cut off is never seen.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ticksmith.operators.candle_parts import candles_of_parts
from ticksmith.schemas import GOLD

# Readers of data files skip names that begin so.
_LEDGER = "_ledger"
PARTS = T.StructType(
    [
        *GOLD.fields[:2],
        T.StructField("open_at", T.LongType()),
        *GOLD.fields[2:5],
        T.StructField("close_at", T.LongType()),
        *GOLD.fields[5:],
    ]
)


def read_candles(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """The candles of all parts so far; an empty frame where there are none."""
    return candles_of_parts(stored_parts(spark, target, fmt))


def stored_parts(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    folders = [f"{target}/{name}" for name in present_folders(spark, target)]
    if not folders:
        return spark.createDataFrame([], PARTS)
    return spark.read.schema(PARTS).format(fmt).load(folders)


def present_folders(spark: SparkSession, target: str) -> list[str]:
    """The folders that make up the candles: the last merged one and the parts after it."""
    entries = ledger(spark, target)
    merged = [entry for entry in entries if entry.get("merged")]
    # Of two compactions up to the same part, either will do.
    last = max(merged, key=lambda entry: (entry["upto"], entry["folder"]), default=None)
    after = {
        entry["folder"]: entry["upto"]
        for entry in entries
        if not entry.get("merged") and (last is None or entry["upto"] > last["upto"])
    }
    return [*([last["folder"]] if last else []), *sorted(after, key=after.get)]


def replaced_folders(spark: SparkSession, target: str) -> list[str]:
    """The folders that compaction has replaced."""
    present = present_folders(spark, target)
    return sorted({entry["folder"] for entry in ledger(spark, target)} - set(present))


def ledger(spark: SparkSession, target: str) -> list[dict]:
    """A line per micro-batch or compaction, some hundred bytes each."""
    try:
        lines = spark.read.schema("value string").text(f"{target}/{_LEDGER}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [json.loads(line["value"]) for line in lines]


def enter(spark: SparkSession, target: str, entry: dict) -> None:
    line = spark.createDataFrame([(json.dumps(entry),)], "value string").coalesce(1)
    line.write.mode("append").text(f"{target}/{_LEDGER}")
