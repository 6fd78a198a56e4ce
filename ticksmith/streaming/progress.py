"""Delivery report of a streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

_REPORT = (
    "batch_id bigint, input_rows bigint, state_rows bigint, state_rows_written bigint, "
    "state_rows_removed bigint, late_rows_dropped bigint, watermark string"
)


def progress_report(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per micro-batch: rows read, held in state, written to it, evicted from it,
    dropped as late.

    ``state_rows`` is 0 for a RocksDB state unless the query started with counting on.

    Complete for the queries of this library, which run under ``every_progress``; others keep
    their last ``spark.sql.streaming.numRecentProgressUpdates`` batches. Late rows are
    counted as Spark does: after map-side aggregation, so late groups rather than rows.
    """
    rows = []
    for progress in query.recentProgress:
        state = progress["stateOperators"]
        rows.append(
            (
                progress["batchId"],
                progress["numInputRows"],
                sum(s["numRowsTotal"] for s in state),
                sum(s["numRowsUpdated"] for s in state),
                sum(s["numRowsRemoved"] for s in state),
                sum(s["numRowsDroppedByWatermark"] for s in state),
                progress["eventTime"].get("watermark"),
            )
        )
    return spark.createDataFrame(rows, _REPORT)


def delivery_report(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per micro-batch and thing counted: ``batch_id``, ``observed`` (the point where
    rows were counted), ``measure`` and ``rows``.

    The counts are those that `ticksmith.operators.content` adds to a stream; a stage adds them
    with ``count_content=True``. They are taken by the tasks as rows pass, without another scan. Rows
    of a task that ran twice count once.
    """
    rows = []
    for progress in query.recentProgress:
        for observed, counts in (progress["observedMetrics"] or {}).items():
            for measure, count in counts.asDict().items():
                rows.append((progress["batchId"], observed, measure, count))
    return spark.createDataFrame(rows, "batch_id bigint, observed string, measure string, rows bigint")
