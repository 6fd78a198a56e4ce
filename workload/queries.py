"""One query per operator, over the whole of the tables it reads."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith import (
    PipelineConfig,
    add_event_time,
    batch_candles,
    candles,
    chained_candles,
    clean_trades,
    filter_symbols,
    parse_trades,
    rejected_messages,
    route_messages,
    run,
    to_messages,
)
from ticksmith.plans import run_stage
from ticksmith.schemas import BRONZE, SILVER
from ticksmith.sources import read_layer, read_messages
from ticksmith.streaming import (
    append_available_now,
    compact_parts,
    delivery_report,
    keys_in_state,
    progress_report,
    write_messages,
)
from workload import feeds
from workload.scratch import run_folder

Query = Callable[[SparkSession, str], DataFrame]

SUBSCRIBED = ("click", "purchase")


# --- messages ---------------------------------------------------------------------------


def route_trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_messages(_messages(spark, sf_dir))
    # An empty trade message has no price, a full one is known by its first.
    price = F.get_json_object(F.col("value").cast("string"), "$.data[0].p").cast("double")
    return routed.select("message_id", price.alias("first_price"))


def parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_trades(_messages(spark, sf_dir), carry=["message_id"], position="position")
    return _conditions_as_text(parsed)


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_messages(_messages(spark, sf_dir)).select(
        "message_id", F.col("value").cast("string").alias("value"), "reason"
    )


def message_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = f"{run_folder(spark)}/topic"
    feed = feeds.trades(feeds.events(spark, sf_dir))
    write_messages(to_messages(feed), "parquet", {"path": topic})
    stored = read_messages(spark, "parquet", {"path": topic}, streaming=False)
    return _conditions_as_text(parse_trades(stored))


# --- time, filters, dedup ---------------------------------------------------------------


def event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_event_time(_trades(spark, sf_dir)).select(
        "arrival", "timestamp", "time_stamp", "time"
    )


def event_time_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_event_time(_trades(spark, sf_dir), "ms").select("arrival", "timestamp", "time")


def subscribed_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conditions_as_text(filter_symbols(_trades(spark, sf_dir), SUBSCRIBED))


def clean_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conditions_as_text(clean_trades(_trades(spark, sf_dir), arrival="arrival"))


def clean_filter_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _trades(spark, sf_dir)
    return _conditions_as_text(clean_trades(feed, "filter_first", arrival="arrival"))


def clean_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trades(feeds.lineitem_trades(spark, sf_dir), arrival="arrival")


# --- candles ----------------------------------------------------------------------------


def candles_of(width: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        clean = clean_trades(_trades(spark, sf_dir), arrival="arrival")
        return candles(add_event_time(clean), width)

    return query


def candles_lineitem_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = clean_trades(feeds.lineitem_trades(spark, sf_dir), arrival="arrival")
    return candles(add_event_time(clean), "30 days")


def candles_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival order names no single open and close, so they are checked for place."""
    clean = clean_trades(_trades(spark, sf_dir), arrival="arrival")
    by_arrival = candles(add_event_time(clean), "1 hour", order="arrival")
    return by_arrival.select(
        "symbol",
        "candle_time",
        "high",
        "low",
        "volume",
        F.col("open").between(F.col("low"), F.col("high")).alias("open_inside"),
        F.col("close").between(F.col("low"), F.col("high")).alias("close_inside"),
    )


def candles_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes that no double holds exactly, to six places, and trades without a time."""
    feed = _trades(spark, sf_dir)
    untimed = feed.withColumns({
        "timestamp": F.when(F.col("arrival") % 103 != 0, F.col("timestamp")),
        "volume": F.col("volume") / 7,
    })
    clean = clean_trades(untimed, arrival="arrival")
    hourly = candles(add_event_time(clean), "1 hour")
    return hourly.withColumn("volume", F.round("volume", 6))


def candles_from_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_candles(_messages(spark, sf_dir), "message_id", "1 hour")


# --- streams ----------------------------------------------------------------------------


def stream_candles_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _config(spark)
    feed = feeds.trades(feeds.events_stream(spark, sf_dir), copies=False)
    _append(candles(add_event_time(feed)), cfg, "gold", "ohlcv")
    return read_layer(spark, cfg, "gold", streaming=False)


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run 1: the first half of the time span. Run 2: the second half and every copy."""
    cfg = _config(spark, candle_width="1 hour")
    events = feeds.events(spark, sf_dir)
    early = F.col("timestamp") < feeds.midpoint_millis(events)
    originals = feeds.trades(events, copies=False)
    copies = feeds.late_copies(events)
    for wave in (originals.where(early), originals.where(~early).unionByName(copies)):
        _store(add_event_time(wave), cfg, "silver")
        run_stage(spark, cfg, "ohlcv")
    return read_layer(spark, cfg, "gold", streaming=False)


def stream_symbol_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs by time, and in the first a trade of one symbol dated ten years ahead, which
    closes that symbol's windows and no other's."""
    cfg = _config(spark, candle_width="1 hour", clock="symbol")
    events = feeds.events(spark, sf_dir)
    originals = feeds.trades(events, copies=False)
    early = F.col("timestamp") < feeds.midpoint_millis(events)
    ahead = originals.where("symbol = 'click'").orderBy("arrival").limit(1)
    ahead = ahead.withColumn("timestamp", F.col("timestamp") + 3650 * 86_400_000)
    for wave in (originals.where(early).unionByName(ahead), originals.where(~early)):
        _store(add_event_time(wave), cfg, "silver")
        run_stage(spark, cfg, "ohlcv")
    return read_layer(spark, cfg, "gold", streaming=False)


def stream_late_revised(compact: bool = False) -> Query:
    """The second half of the time span, then the first, then every copy: each run's trades are
    late for windows already written, and all of them count."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = _config(spark, candle_width="1 hour", late="revise")
        events = feeds.events(spark, sf_dir)
        early = F.col("timestamp") < feeds.midpoint_millis(events)
        originals = feeds.trades(events, copies=False)
        waves = (originals.where(~early), originals.where(early), feeds.late_copies(events))
        for number, wave in enumerate(waves):
            _store(add_event_time(wave), cfg, "silver")
            run_stage(spark, cfg, "ohlcv")
            if compact and number == 1:
                compact_parts(spark, cfg.target("gold"))
        return read_layer(spark, cfg, "gold", streaming=False)

    return query


def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trades arriving in two halves, then a run that finds nothing new."""
    cfg = _config(spark, candle_width="1 hour")
    events = feeds.events(spark, sf_dir)
    clean = add_event_time(clean_trades(feeds.trades(events), arrival="arrival"))
    early = F.col("timestamp") < feeds.midpoint_millis(events)
    for wave in (clean.where(early), clean.where(~early), None):
        if wave is not None:
            _store(wave, cfg, "silver")
        run_stage(spark, cfg, "ohlcv")
    return read_layer(spark, cfg, "gold", streaming=False)


def stream_clean(**settings: object) -> Query:
    """Originals in the first run, their copies in the second."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = _config(spark, **settings)
        feed = add_event_time(feeds.trades(feeds.events(spark, sf_dir)))
        copied = F.col("arrival") >= feeds.COPY_OFFSET
        for wave in (feed.where(~copied), feed.where(copied)):
            _store(wave, cfg, "transformed")
            run_stage(spark, cfg, "clean")
        return _conditions_as_text(read_layer(spark, cfg, "silver", streaming=False))

    return query


def stream_clean_first_arrival(**settings: object) -> Query:
    """Originals and most of their copies in one micro-batch, later arrivals first; the other
    copies in the second run."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = _config(spark, arrival=("arrival",), **settings)
        feed = add_event_time(feeds.trades(feeds.events(spark, sf_dir)))
        second = (F.col("arrival") >= feeds.COPY_OFFSET) & (F.col("arrival") % 3 == 0)
        for wave in (feed.where(~second), feed.where(second)):
            backwards = wave.repartition(3, "timestamp").sortWithinPartitions(F.desc("arrival"))
            backwards.write.mode("append").parquet(cfg.target("transformed"))
            run_stage(spark, cfg, "clean")
        return _conditions_as_text(read_layer(spark, cfg, "silver", streaming=False))

    return query


def chained(within: str | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = _config(spark)
        feed = feeds.trades(feeds.events_stream(spark, sf_dir), copies=False)
        result = chained_candles(feeds.messages(feed), within, "1 hour")
        _append(result, cfg, "gold", "ohlcv")
        return read_layer(spark, cfg, "gold", streaming=False)

    return query


def layered(layer: str, stages: list[str], files: int | None = None, **settings: object) -> Query:
    """The stored layer after two runs of the stages up to it: originals, then copies.

    ``files`` writes each wave of messages as so many files.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = run_folder(spark)
        topic = {"path": f"{folder}/topic"}
        cfg = PipelineConfig(
            folder, source_format="parquet", source_options=topic,
            state_partitions=_state_partitions(spark), **settings,
        )
        feed = feeds.trades(feeds.events(spark, sf_dir))
        copied = F.col("arrival") >= feeds.COPY_OFFSET
        for wave in (feed.where(~copied), feed.where(copied)):
            sent = feeds.messages(wave)
            write_messages(sent.repartition(files) if files else sent, "parquet", topic)
            run(spark, cfg, stages)
        return _conditions_as_text(read_layer(spark, cfg, layer, streaming=False))

    return query


def layered_gold_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of two runs of the whole chain: raw messages, routed into the topic, up to candles."""
    folder = run_folder(spark)
    raw, topic = {"path": f"{folder}/raw"}, {"path": f"{folder}/topic"}
    cfg = PipelineConfig(
        folder, source_format="parquet", source_options=topic, raw_format="parquet",
        raw_options=raw, state_partitions=_state_partitions(spark),
    )
    feed = _trades(spark, sf_dir)
    copied = F.col("arrival") >= feeds.COPY_OFFSET
    for wave in (feed.where(~copied), feed.where(copied)):
        write_messages(feeds.messages(wave), "parquet", raw)
        run(spark, cfg)
    return read_layer(spark, cfg, "gold", streaming=False)


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze gets a column in its second run, and the stages behind it carry it on; the rows
    of the first run hold NULL in it."""
    cfg = _config(spark)
    topic = {"path": f"{cfg.root}/topic"}
    feed = _trades(spark, sf_dir)
    copied = F.col("arrival") >= feeds.COPY_OFFSET

    write_messages(feeds.messages(feed.where(~copied)), "parquet", topic)
    plain = parse_trades(read_messages(spark, "parquet", topic))
    _append(plain, cfg, "bronze", "ingest", merge_schema=True)
    run(spark, cfg, ["transform", "clean"])

    write_messages(feeds.messages(feed.where(copied)), "parquet", topic)
    widened = plain.withColumn("venue", F.concat(F.lit("venue-"), F.col("symbol")))
    _append(widened, cfg, "bronze", "ingest", merge_schema=True)

    run(spark, cfg, ["transform", "clean"])
    return _conditions_as_text(read_layer(spark, cfg, "silver", streaming=False))


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and keys held by the dedup, summed over the micro-batches."""
    cfg = _config(spark)
    feed = feeds.trades(feeds.events_stream(spark, sf_dir))
    clean = clean_trades(add_event_time(feed).select(*SILVER.names), collapse_copies=False)
    query = _append(clean, cfg, "silver", "clean", count_state_rows=True)
    return progress_report(spark, query).agg(
        F.sum("input_rows").alias("input_rows"),
        F.max("state_rows").alias("state_rows"),
        F.sum("state_rows_written").alias("state_rows_written"),
        F.sum("late_rows_dropped").alias("late_rows_dropped"),
    )


def progress_many_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read over far more micro-batches than Spark keeps by itself."""
    cfg = _config(spark, max_files_per_trigger=1)
    _trades(spark, sf_dir).select(*BRONZE.names).repartition(120).write.parquet(cfg.target("bronze"))
    query = run_stage(spark, cfg, "transform")
    found = progress_report(spark, query).where("input_rows > 0")
    return found.agg(
        F.sum("input_rows").alias("input_rows"), (F.count("*") > 100).alias("many_batches")
    )


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs of three stages read, refused and wrote, counted by the streams themselves."""
    folder = run_folder(spark)
    topic = {"path": f"{folder}/topic"}
    cfg = PipelineConfig(
        folder, source_format="parquet", source_options=topic, count_content=True,
        state_partitions=_state_partitions(spark),
    )
    feed = _trades(spark, sf_dir)
    copied = F.col("arrival") >= feeds.COPY_OFFSET
    reports = []
    for wave in (feed.where(~copied), feed.where(copied)):
        write_messages(feeds.messages(wave), "parquet", topic)
        for stage, query in run(spark, cfg, ["ingest", "transform", "clean"]).items():
            reports.append(delivery_report(spark, query).withColumn("stage", F.lit(stage)))
    counted = reduce(DataFrame.unionByName, reports)
    return counted.groupBy("stage", "observed", "measure").agg(F.sum("rows").alias("rows"))


def state_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that a dedup bounded to two days still holds after two runs."""
    cfg = _config(spark, dedup_within="2 days", clean_mode="filter_first")
    feed = add_event_time(feeds.trades(feeds.events(spark, sf_dir)))
    copied = F.col("arrival") >= feeds.COPY_OFFSET
    for wave in (feed.where(~copied), feed.where(copied)):
        _store(wave, cfg, "transformed")
        run_stage(spark, cfg, "clean")
    return keys_in_state(spark, cfg.checkpoint("clean"))


def candles_many_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles of messages whose ids carry a split's number above their 33rd bit, as
    those of more than a thousand splits do; copies keep arriving after originals."""
    wide = (F.col("message_id") % 1500) * F.lit(2**33) + F.col("message_id")
    late = F.when(F.col("message_id") >= 10 * feeds.COPY_OFFSET, F.lit(2**62)).otherwise(-(2**61))
    rows = _messages(spark, sf_dir).withColumn("message_id", late + wide)
    return batch_candles(rows, "message_id", "1 hour")


QUERIES: dict[str, Query] = {
    "route_trade_messages": route_trade_messages,
    "parse_trades": parse,
    "rejected_messages": rejected,
    "message_round_trip": message_round_trip,
    "event_time": event_time,
    "event_time_ms": event_time_ms,
    "filter_symbols": subscribed_symbols,
    "clean_dedup_first": clean_dedup_first,
    "clean_filter_first": clean_filter_first,
    "clean_lineitem": clean_lineitem,
    "candles_1m": candles_of("1 minute"),
    "candles_1h": candles_of("1 hour"),
    "candles_1d": candles_of("1 day"),
    "candles_lineitem_30d": candles_lineitem_30d,
    "candles_arrival": candles_arrival,
    "candles_from_messages": candles_from_messages,
    "stream_candles_closed": stream_candles_closed,
    "stream_late_drop": stream_late_drop,
    "stream_symbol_clock": stream_symbol_clock,
    "stream_late_revised": stream_late_revised(),
    "stream_late_revised_compacted": stream_late_revised(compact=True),
    "stream_incremental": stream_incremental,
    "stream_clean": stream_clean(),
    "stream_clean_bounded": stream_clean(dedup_within="2 days", clean_mode="filter_first"),
    "stream_clean_uncollapsed": stream_clean(collapse_copies=False),
    "stream_clean_filter_first": stream_clean(clean_mode="filter_first"),
    "stream_clean_first_arrival": stream_clean_first_arrival(),
    "stream_clean_first_arrival_bounded": stream_clean_first_arrival(dedup_within="40 days"),
    "chained_candles": chained("10 minutes"),
    "chained_candles_unbounded": chained(None),
    "layered_bronze": layered("bronze", ["ingest"]),
    "layered_transformed": layered("transformed", ["ingest", "transform"]),
    "layered_silver": layered("silver", ["ingest", "transform", "clean"]),
    "layered_gold": layered("gold", ["ingest", "transform", "clean", "ohlcv"]),
    "layered_gold_small_triggers": layered(
        "gold", ["ingest", "transform", "clean", "ohlcv"], files=4, max_files_per_trigger=1
    ),
    "layered_gold_landed": layered_gold_landed,
    "candles_many_splits": candles_many_splits,
    "candles_fractional": candles_fractional,
    "schema_evolution": schema_evolution,
    "progress": progress,
    "progress_many_batches": progress_many_batches,
    "progress_delivery": delivery,
    "stream_state_keys": state_keys,
}


# --- shared -----------------------------------------------------------------------------


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.trades(feeds.events(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.messages(_trades(spark, sf_dir))


def _config(spark: SparkSession, **settings: object) -> PipelineConfig:
    settings = {"state_partitions": _state_partitions(spark), **settings}
    return PipelineConfig(run_folder(spark), **settings)


def _state_partitions(spark: SparkSession) -> int:
    """One per core of the machine that tests and benches run on."""
    return spark.sparkContext.defaultParallelism


def _store(rows: DataFrame, cfg: PipelineConfig, layer: str) -> None:
    """Add files to a layer folder from outside, for a stage to pick up."""
    rows.select(*SILVER.names).write.mode("append").parquet(cfg.target(layer))


def _append(rows: DataFrame, cfg: PipelineConfig, layer: str, stage: str, **options: object):
    options = {"state_partitions": cfg.state_partitions, **options}
    return append_available_now(rows, cfg.target(layer), cfg.checkpoint(stage), cfg.fmt, **options)


def _conditions_as_text(rows: DataFrame) -> DataFrame:
    """Arrays compare differently across engines; one code per trade reads the same."""
    if "conditions" not in rows.columns:
        return rows
    codes = F.col("conditions").cast("array<string>")
    return rows.withColumn("conditions", F.concat_ws(",", codes))
