"""Writers of candle parts: every micro-batch adds its own, and compaction folds many into one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ticksmith.operators.candle_parts import candle_parts, merge_parts
from ticksmith.sources.parts import PARTS, enter, ledger, present_folders
from ticksmith.streaming.settings import every_progress
from ticksmith.streaming.sinks import drained, exists


def add_parts_available_now(
    trades: DataFrame,
    target: str,
    checkpoint: str,
    width: str = "1 minute",
    fmt: str = "parquet",
    timeout_seconds: int | None = None,
) -> StreamingQuery:
    """Add the candle parts of all trades now available, wait, and return the query.

    No trade is late: there is neither watermark nor state, and a trade of a window that was
    read before changes its candle. A micro-batch that runs again replaces its own part.
    """
    spark = trades.sparkSession
    if not exists(spark, f"{checkpoint}/metadata") and ledger(spark, target):
        raise ValueError(f"{target} was written with another checkpoint than {checkpoint}")

    def add(batch: DataFrame, number: int) -> None:
        parts = candle_parts(batch, width)
        parts.write.mode("overwrite").format(fmt).save(f"{target}/part-{number}")
        enter(batch.sparkSession, target, {"upto": number, "folder": f"part-{number}"})

    writer = (
        trades.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(add)
    )
    with every_progress(spark):
        return drained(writer.start(), timeout_seconds)


def compact_parts(spark: SparkSession, target: str, fmt: str = "parquet") -> str | None:
    """Fold all present parts into one folder and return its name; None if there is at most one.

    Readers switch to it by one line of the ledger. The folders it replaces stay, since a reader
    may be in them; `replaced_folders` names them for removal. A stage may add parts meanwhile.
    """
    folders = present_folders(spark, target)
    if len(folders) < 2:
        return None
    upto = max(entry["upto"] for entry in ledger(spark, target) if entry["folder"] in folders)
    name = f"merged-{upto}-{uuid.uuid4().hex}"
    parts = spark.read.schema(PARTS).format(fmt).load([f"{target}/{f}" for f in folders])
    merge_parts(parts).write.format(fmt).save(f"{target}/{name}")
    enter(spark, target, {"upto": upto, "folder": name, "merged": True})
    return name
