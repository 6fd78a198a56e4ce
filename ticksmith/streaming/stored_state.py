"""What a stopped query's checkpoint holds in state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def keys_in_state(
    spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None
) -> DataFrame:
    """The keys a deduplicating stage knows, a row each, with ``until``: the watermark that drops
    the key, NULL for an unbounded dedup.

    Read from the checkpoint as of its last micro-batch, or of ``batch``, a task per state
    partition; the query need not run, and is not changed. ``operator`` counts the stateful
    operators of a query from its source.
    """
    reader = spark.read.format("statestore").option("operatorId", str(operator))
    if batch is not None:
        reader = reader.option("batchId", str(batch))
    state = reader.load(checkpoint)
    held = {field.name for field in state.schema["value"].dataType}
    micros = F.col("value.expiresAtMicros") if "expiresAtMicros" in held else F.lit(None).cast("bigint")
    return state.select("key.*", F.timestamp_micros(micros).alias("until"))
