"""Append-only sinks that run until the input is drained."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ticksmith.sources.layers import columns_to_note, note_columns
from ticksmith.streaming.settings import every_progress, state_settings


def append_available_now(
    df: DataFrame,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    *,
    as_table: bool = False,
    merge_schema: bool = False,
    partition_by: Sequence[str] = (),
    state_partitions: int | None = None,
    state_provider: str | None = "rocksdb",
    count_state_rows: bool = False,
    timeout_seconds: int | None = None,
) -> StreamingQuery:
    """Append everything now available to a folder or table, wait, and return the query.

    The checkpoint records what was read: the next call with it takes up new input only.
    """
    spark = df.sparkSession
    _refuse_lost_checkpoint(spark, _folder(spark, target, as_table), checkpoint)
    if not as_table:
        note = columns_to_note(spark, target, df.schema) if fmt != "delta" else None
        # A folder exists after its first run even if nothing came, as a table would.
        spark.createDataFrame([], df.schema).write.mode("ignore").format(fmt).partitionBy(
            *partition_by
        ).save(target)
        if note is not None:  # before the rows, so that no reader meets columns it does not know
            note_columns(spark, target, note)
    elif merge_schema and fmt != "delta":
        _add_columns(spark, target, df)

    writer = (
        df.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if merge_schema:
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with every_progress(spark):
        with state_settings(spark, state_partitions, state_provider, count_state_rows):
            query = writer.toTable(target) if as_table else writer.start(target)
        return drained(query, timeout_seconds)


def write_messages(
    messages: DataFrame,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    checkpoint: str | None = None,
    timeout_seconds: int | None = None,
) -> StreamingQuery | None:
    """Send ``key``/``value`` messages to a topic, or append them to a message folder.

    A batch is written at once; a stream needs a ``checkpoint`` and runs until drained.
    """
    sent = messages.select("key", "value")
    if not sent.isStreaming:
        sent.write.format(fmt).options(**(options or {})).mode("append").save()
        return None
    if checkpoint is None:
        raise ValueError("a stream of messages needs a checkpoint")
    writer = (
        sent.writeStream.format(fmt)
        .options(**(options or {}))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    with every_progress(sent.sparkSession):
        return drained(writer.start(), timeout_seconds)


def _add_columns(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Columns that the table lacks, at its end; files written before hold NULL in them."""
    if not spark.catalog.tableExists(table):
        return
    known = {name.lower() for name in spark.table(table).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def _folder(spark: SparkSession, target: str, as_table: bool) -> str | None:
    """Where the target's files are; None for a table that does not exist yet."""
    if not as_table:
        return target
    if not spark.catalog.tableExists(target):
        return None
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {target}")
    location = details.where("col_name = 'Location'").first()
    return location["data_type"] if location else None


def _refuse_lost_checkpoint(spark: SparkSession, folder: str | None, checkpoint: str) -> None:
    """A file sink skips batch numbers its folder already has, so a new checkpoint over an
    old folder would lose rows without a word."""
    if folder is None or exists(spark, f"{checkpoint}/metadata"):
        return
    if exists(spark, f"{folder}/_spark_metadata"):
        raise ValueError(
            f"{folder} was written with another checkpoint than {checkpoint}; "
            "give that one, or a new target"
        )


def exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.format("binaryFile").load(path).columns)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def drained(query: StreamingQuery, timeout_seconds: int | None) -> StreamingQuery:
    """Wait for the end; a failed query raises here, one out of time is stopped."""
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"query {query.id} not drained after {timeout_seconds} s")
    return query
