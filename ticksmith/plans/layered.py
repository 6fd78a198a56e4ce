"""The four stages, each a DataFrame step between two stored layers, and landing before them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticksmith.config import PipelineConfig
from ticksmith.functions import event_time
from ticksmith.operators import (
    add_event_time,
    candles,
    clean_trades,
    filter_symbols,
    parse_trades,
    route_messages,
    symbol_clock_candles,
)
from ticksmith.operators.content import count_messages, count_rows, count_trades
from ticksmith.schemas import BRONZE
from ticksmith.sources import DATE_COLUMN, read_layer, read_messages
from ticksmith.streaming import add_parts_available_now, append_available_now, write_messages


@dataclass(frozen=True)
class Stage:
    """``step`` turns rows of ``source`` (None: the message source) into rows of ``target``."""

    source: str | None
    target: str
    step: Callable[[DataFrame, PipelineConfig], DataFrame]
    merge_schema: bool = True
    watermarked: Callable[[PipelineConfig], bool] = lambda cfg: False


def _ingest(messages: DataFrame, cfg: PipelineConfig) -> DataFrame:
    # What orders arrivals is carried from the messages; a trade's place in its message is made.
    carried = [name for name in cfg.arrival if name != POSITION]
    trades = parse_trades(messages, carried, POSITION if POSITION in cfg.arrival else None)
    trades = trades.select(*BRONZE.names, *cfg.arrival)
    return filter_symbols(trades, cfg.symbols) if cfg.symbols else trades


def _transform(trades: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return add_event_time(trades, cfg.precision)


def _clean(trades: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return clean_trades(
        trades, cfg.clean_mode, cfg.arrival or None, cfg.dedup_within, cfg.collapse_copies
    )


def _ohlcv(trades: DataFrame, cfg: PipelineConfig) -> DataFrame:
    if cfg.clock == "symbol":
        if cfg.order != "event_time":
            raise ValueError("candles closed by their symbol take open and close by event time")
        return symbol_clock_candles(trades, cfg.candle_width, cfg.watermark)
    return candles(trades, cfg.candle_width, cfg.watermark, cfg.order)


# In running order; each stage reads what the one before it wrote.
STAGES = {
    "ingest": Stage(None, "bronze", _ingest),
    "transform": Stage("bronze", "transformed", _transform),
    "clean": Stage(
        "transformed", "silver", _clean, watermarked=lambda cfg: cfg.dedup_within is not None
    ),
    "ohlcv": Stage(
        "silver", "gold", _ohlcv, merge_schema=False, watermarked=lambda cfg: cfg.late == "drop"
    ),
}


# A trade's place in its message, where ``arrival`` asks for it.
POSITION = "position"

# Routes raw messages into the topic that `ingest` reads.
LAND = "land"


def chain(cfg: PipelineConfig) -> list[str]:
    """All stages in running order; landing is one of them if there is something to land."""
    return [LAND, *STAGES] if cfg.raw_options else list(STAGES)


def _land(spark: SparkSession, cfg: PipelineConfig) -> StreamingQuery:
    raw = read_messages(spark, cfg.raw_format, cfg.raw_options)
    key = F.col("key") if "key" in raw.columns else F.lit(None).cast("binary")
    messages = raw.select(key.alias("key"), F.col("value").cast("binary").alias("value"))
    routed = route_messages(messages)
    if cfg.count_content:
        routed = count_rows(route_messages(count_rows(messages, "read", "messages")), "written", "messages")
    options = cfg.topic_options or cfg.source_options
    return write_messages(
        routed, cfg.source_format, options, cfg.checkpoint(LAND), cfg.timeout_seconds
    )


def run_stage(spark: SparkSession, cfg: PipelineConfig, name: str) -> StreamingQuery:
    """Drain one stage and return its finished query."""
    if name == LAND:
        return _land(spark, cfg)
    stage = STAGES[name]
    if stage.source is None:
        rows = read_messages(spark, cfg.source_format, cfg.source_options)
    else:
        rows = read_layer(spark, cfg, stage.source, whole=stage.watermarked(cfg))
    if cfg.count_content:
        rows = count_messages(rows) if stage.source is None else count_trades(rows)
    if stage.target == "gold" and cfg.late == "revise":
        return add_parts_available_now(
            rows, cfg.target("gold"), cfg.checkpoint(name), cfg.candle_width, cfg.fmt, cfg.timeout_seconds
        )
    result = stage.step(rows, cfg)
    if cfg.partition_by_date:
        day = F.to_date(_moment(stage.target))
        result = result.withColumn(DATE_COLUMN, day)
    if cfg.count_content:
        result = count_rows(result, "written", "rows")
    return append_available_now(
        result,
        cfg.target(stage.target),
        cfg.checkpoint(name),
        cfg.fmt,
        as_table=cfg.catalog is not None,
        merge_schema=stage.merge_schema,
        partition_by=(DATE_COLUMN,) if cfg.partition_by_date else (),
        state_partitions=cfg.state_partitions,
        state_provider=cfg.state_provider,
        count_state_rows=cfg.count_state_rows,
        timeout_seconds=cfg.timeout_seconds,
    )


def _moment(layer: str) -> Column:
    return F.col("candle_time") if layer == "gold" else event_time(F.col("timestamp"))


def run(
    spark: SparkSession, cfg: PipelineConfig, stages: Sequence[str] | None = None
) -> dict[str, StreamingQuery]:
    """Drain the chosen stages (default all) in chain order; the first failure ends the run.

    Running again on the same configuration takes up new input only.
    """
    every = [LAND, *STAGES]
    chosen = set(chain(cfg) if stages is None else stages)
    unknown = chosen - set(every)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}, choose from {every}")
    return {name: run_stage(spark, cfg, name) for name in every if name in chosen}
