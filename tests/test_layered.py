import runpy
import sys

import pytest
from helpers import MINUTE, START, candles_as_dict
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from ticksmith import (
    STAGES,
    PipelineConfig,
    add_event_time,
    candles,
    chained_candles,
    filter_symbols,
    parse_trades,
    rejected_messages,
    route_messages,
    run,
    to_messages,
)
from ticksmith.plans import run_stage
from ticksmith.schemas import BRONZE, GOLD, SILVER, TRANSFORMED
from ticksmith.sources import kafka_options, read_layer, read_messages
from ticksmith.streaming import append_available_now, write_messages

SCHEMAS = {"bronze": BRONZE, "transformed": TRANSFORMED, "silver": SILVER, "gold": GOLD}


def message(*trades):
    body = ",".join(
        '{"c":[1],"p":%s,"s":"%s","t":%d,"v":%s}' % (price, symbol, START + offset, volume)
        for symbol, offset, price, volume in trades
    )
    return '{"type":"trade","data":[%s]}' % body


FIRST = [
    message(("A", 0, 1.0, 1.0), ("A", 59_000, 3.0, 2.0)),
    message(("B", 1000, 5.0, 1.0), ("A", 0, 8.0, 8.0)),
    message(("A", 30_000, -4.0, 1.0)),
    '{"type":"ping"}',
    "garbage",
    message(("A", 3 * MINUTE, 9.0, 1.0)),
]
SECOND = [
    message(("A", 3 * MINUTE, 1.0, 50.0)),
    message(("A", 4 * MINUTE, 2.0, 1.0)),
    message(("B", 8 * MINUTE, 2.0, 1.0)),
]
GOLD_FIRST = {
    ("A", START): (1.0, 3.0, 1.0, 3.0, 3.0),
    ("B", START): (5.0, 5.0, 5.0, 5.0, 1.0),
}
GOLD_SECOND = {
    **GOLD_FIRST,
    ("A", START + 3 * MINUTE): (9.0, 9.0, 9.0, 9.0, 1.0),
    ("A", START + 4 * MINUTE): (2.0, 2.0, 2.0, 2.0, 1.0),
}


def land(spark, folder, values):
    rows = [(None, bytearray(v, "utf-8")) for v in values]
    df = spark.createDataFrame(rows, "key binary, value binary").coalesce(1)
    write_messages(df, "parquet", {"path": str(folder / "topic")})


def config(folder, **settings):
    topic = {"path": str(folder / "topic")}
    return PipelineConfig(
        str(folder / "base"), source_format="parquet", source_options=topic, **settings
    )


def stored(spark, cfg, layer):
    return read_layer(spark, cfg, layer, streaming=False)


def check_runs(spark, folder, cfg):
    land(spark, folder, FIRST[:2])
    # Separate files in one run; the copy of A's first trade must arrive in a later run.
    land(spark, folder, FIRST[2:])
    assert list(run(spark, cfg)) == list(STAGES)
    counts = {layer: stored(spark, cfg, layer).count() for layer in SCHEMAS}
    assert counts == {"bronze": 6, "transformed": 6, "silver": 4, "gold": 2}
    land(spark, folder, SECOND)
    run(spark, cfg)
    assert candles_as_dict(stored(spark, cfg, "gold")) == GOLD_SECOND
    run(spark, cfg)
    assert stored(spark, cfg, "gold").count() == len(GOLD_SECOND)


def test_four_stages_over_folders_run_after_run(spark, tmp_path):
    cfg = config(tmp_path)
    check_runs(spark, tmp_path, cfg)
    for layer, schema in SCHEMAS.items():
        found = stored(spark, cfg, layer).schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema]


def test_four_stages_over_catalog_tables(spark, tmp_path):
    cfg = config(tmp_path, catalog="spark_catalog", env="test", space="qa")
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS test_qa_{layer}")
    check_runs(spark, tmp_path, cfg)
    for layer, schema in SCHEMAS.items():
        found = spark.table(cfg.target(layer)).schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema]


def test_four_stages_partitioned_by_date(spark, tmp_path):
    cfg = config(tmp_path, partition_by_date=True)
    check_runs(spark, tmp_path, cfg)
    for layer, schema in SCHEMAS.items():
        found = stored(spark, cfg, layer)
        assert found.columns == [*schema.names, "trade_date"]
        days = {str(r[0]) for r in found.select("trade_date").distinct().collect()}
        assert days == {"2024-01-01"}
    one_day = stored(spark, cfg, "silver").where(F.col("trade_date") == "2024-01-02")
    assert one_day.count() == 0 and one_day.inputFiles() != []


def test_stages_one_at_a_time_and_in_chain_order(spark, tmp_path):
    cfg = config(tmp_path)
    land(spark, tmp_path, FIRST)
    assert list(run(spark, cfg, ["transform", "ingest"])) == ["ingest", "transform"]
    assert stored(spark, cfg, "transformed").count() == 6
    with pytest.raises(AnalysisException):
        stored(spark, cfg, "silver").count()
    with pytest.raises(ValueError, match="unknown stages"):
        run(spark, cfg, ["ingest", "other"])


def test_a_failing_stage_ends_the_run(spark, tmp_path):
    land(spark, tmp_path, FIRST)
    cfg = config(tmp_path, clean_mode="other")
    with pytest.raises(ValueError, match="mode"):
        run(spark, cfg)
    assert stored(spark, cfg, "transformed").count() == 6
    with pytest.raises(AnalysisException):
        stored(spark, cfg, "gold").count()


def test_subscribed_symbols_only(spark, tmp_path):
    land(spark, tmp_path, FIRST)
    cfg = config(tmp_path, symbols=("B",))
    run(spark, cfg, ["ingest"])
    assert {r["symbol"] for r in stored(spark, cfg, "bronze").collect()} == {"B"}


@pytest.mark.parametrize("within", [None, "2 minutes"])
def test_one_chained_query(spark, tmp_path, within):
    land(spark, tmp_path, FIRST)
    messages = read_messages(spark, "parquet", {"path": str(tmp_path / "topic")})
    target, checkpoint = str(tmp_path / "gold"), str(tmp_path / "checkpoint")
    append_available_now(chained_candles(messages, within), target, checkpoint)
    found = candles_as_dict(spark.read.parquet(target))
    # Which copy of A's first trade wins inside one micro-batch is open; B has no copy.
    assert set(found) == set(GOLD_FIRST)
    assert found[("B", START)] == GOLD_FIRST[("B", START)]


def test_added_column_is_null_in_older_files(spark, tmp_path):
    cfg = config(tmp_path)
    land(spark, tmp_path, FIRST[:1])
    run(spark, cfg, ["ingest"])
    land(spark, tmp_path, SECOND)
    wider = parse_trades(read_messages(spark, "parquet", cfg.source_options))
    wider = wider.withColumn("venue", F.when(F.col("symbol").isNotNull(), "X"))
    append_available_now(
        wider, cfg.target("bronze"), cfg.checkpoint("ingest"), merge_schema=True
    )
    merged = spark.read.option("mergeSchema", "true").parquet(cfg.target("bronze"))
    assert merged.columns == [*BRONZE.names, "venue"]
    assert merged.groupBy("venue").count().orderBy("venue").collect() == [(None, 2), ("X", 3)]
    # A reader with the former schema goes on as before.
    assert stored(spark, cfg, "bronze").count() == 5


def test_streamed_messages_are_routed_to_a_topic(spark, tmp_path):
    land(spark, tmp_path, FIRST)
    raw = read_messages(spark, "parquet", {"path": str(tmp_path / "topic")})
    options, checkpoint = {"path": str(tmp_path / "routed")}, str(tmp_path / "checkpoint")
    for _ in range(2):
        write_messages(route_messages(raw), "parquet", options, checkpoint)
    routed = read_messages(spark, "parquet", options, streaming=False)
    assert sorted(bytes(r["value"]).decode() for r in routed.collect()) == sorted(
        v for v in FIRST if v.startswith('{"type":"trade"')
    )
    with pytest.raises(ValueError, match="checkpoint"):
        write_messages(raw, "parquet", options)


def test_input_lost_before_it_was_read_is_passed_over(spark, tmp_path):
    for value in FIRST[:2]:
        land(spark, tmp_path, [value])
    options = {"path": str(tmp_path / "topic"), "maxFilesPerTrigger": "1"}
    trades = parse_trades(read_messages(spark, "parquet", options))
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    failing = trades.withColumn(
        "volume", F.when(F.col("symbol") == "B", F.raise_error(F.lit("no good")).cast("double"))
    )
    with pytest.raises(StreamingQueryException):
        append_available_now(failing, target, checkpoint)
    # The failed run has noted that it would read the second file; now that file is gone.
    newest = max((tmp_path / "topic").glob("part-*"), key=lambda file: file.stat().st_mtime_ns)
    newest.unlink()
    append_available_now(trades, target, checkpoint)
    assert spark.read.parquet(target).count() == 2


def timed(messages):
    return add_event_time(parse_trades(messages))


OPERATORS = {
    "route": route_messages,
    "parse": lambda m: parse_trades(m, carry=["key"], position="position"),
    "reject": rejected_messages,
    "to_messages": lambda m: to_messages(parse_trades(m)),
    "time": timed,
    "time_ms": lambda m: add_event_time(parse_trades(m), "ms"),
    "symbols": lambda m: filter_symbols(timed(m), ["A"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_stateless_step_gives_the_same_as_a_stream_and_as_a_batch(spark, tmp_path, name):
    land(spark, tmp_path, FIRST)
    topic = {"path": str(tmp_path / "topic")}
    target = str(tmp_path / "out")
    step = OPERATORS[name]
    append_available_now(
        step(read_messages(spark, "parquet", topic)), target, str(tmp_path / "checkpoint")
    )
    batch = step(read_messages(spark, "parquet", topic, streaming=False))
    streamed = spark.read.schema(batch.schema).parquet(target)
    assert batch.count() > 0
    assert sorted(map(repr, streamed.collect())) == sorted(map(repr, batch.collect()))


@pytest.mark.parametrize("order", ["event_time", "arrival"])
def test_candles_give_the_same_as_a_stream_and_as_a_batch(spark, tmp_path, order):
    # One trade per candle, so that arrival order has nothing to choose.
    land(spark, tmp_path, [message(("A", i * MINUTE, 1.0 + i, 1.0)) for i in range(6)])
    topic = {"path": str(tmp_path / "topic")}
    target = str(tmp_path / "out")
    stream = candles(timed(read_messages(spark, "parquet", topic)), order=order)
    append_available_now(stream, target, str(tmp_path / "checkpoint"))
    batch = candles(timed(read_messages(spark, "parquet", topic, streaming=False)), order=order)
    every = candles_as_dict(batch)
    assert len(every) == 6
    closed = {key: candle for key, candle in every.items() if key[1] < START + 3 * MINUTE}
    assert candles_as_dict(spark.read.parquet(target)) == closed


def test_messages_from_text_files(spark, tmp_path):
    (tmp_path / "raw.txt").write_text("\n".join(FIRST))
    messages = read_messages(spark, "text", {"path": str(tmp_path)}, streaming=False)
    assert parse_trades(messages).count() == 6


def test_kafka_options():
    plain = kafka_options("host:9092", "trades")
    assert plain == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "trades",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    login = kafka_options("host:9092", "trades", "me", 'pass"word')
    assert login["kafka.security.protocol"] == "SASL_SSL"
    assert login["kafka.sasl.mechanism"] == "PLAIN"
    assert login["kafka.sasl.jaas.config"].endswith(
        'PlainLoginModule required username="me" password="pass\\"word";'
    )


def test_kafka_without_its_package(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        read_messages(spark, "kafka", kafka_options("host:9092", "trades"))
    message = spark.createDataFrame([(None, bytearray(b"{}"))], "key binary, value binary")
    with pytest.raises(AnalysisException, match="kafka"):
        write_messages(message, "kafka", {"topic": "trades"})


def test_config_names_places_by_environment():
    cfg = PipelineConfig("/data/", env="prod", space="release")
    assert cfg.target("gold") == "/data/prod/release/gold/trades_stock_data"
    assert cfg.checkpoint("ohlcv") == "/data/prod/release/checkpoints/ohlcv"
    named = PipelineConfig("/data", catalog="main")
    assert named.target("transformed") == "main.dev_feature_bronze.transformed_stock_data"
    places = [cfg.target(layer) for layer in SCHEMAS] + [cfg.checkpoint(s) for s in STAGES]
    assert len(set(places)) == len(places)


@pytest.mark.parametrize("wrong", [{"env": "local"}, {"space": "other"}])
def test_config_refuses_unknown_names(wrong):
    with pytest.raises(ValueError, match="must be one of"):
        PipelineConfig("/data", **wrong)


def test_job_entry(spark, tmp_path, monkeypatch):
    land(spark, tmp_path, FIRST)
    argv = ["job.py", "--stages", "ingest", "transform", "--env", "dev", "--space", "feature"]
    argv += ["--base-path", str(tmp_path / "base"), "--source-format", "parquet"]
    argv += ["--source-option", f"path={tmp_path / 'topic'}"]
    monkeypatch.setattr(sys, "argv", argv)
    runpy.run_module("job", run_name="__main__")
    assert stored(spark, config(tmp_path), "transformed").count() == 6


def test_stages_read_no_footers_of_layers_that_stages_wrote(spark, tmp_path, monkeypatch):
    from ticksmith.sources import layers

    plain = PipelineConfig(
        str(tmp_path), source_format="parquet", source_options={"path": f"{tmp_path}/topic"}, state_partitions=2
    )
    value = b'{"type":"trade","data":[{"s":"A","t":1704067200000,"p":5.0,"v":1,"c":[1]}]}'

    def send():
        rows = spark.createDataFrame([(None, value)], "key binary, value binary")
        rows.write.mode("append").parquet(f"{tmp_path}/topic")

    monkeypatch.setattr(layers, "_footers", lambda *args: pytest.fail("footers were merged"))
    send()
    run(spark, plain)
    assert [f.name for f in layers.noted_columns(spark, plain.target("silver"))] == SILVER.names
    # A column that bronze gets later is noted once, and the stages behind carry it on.
    send()
    wide = parse_trades(read_messages(spark, "parquet", plain.source_options)).withColumn("venue", F.lit("x"))
    append_available_now(wide, plain.target("bronze"), plain.checkpoint("ingest"), merge_schema=True)
    run(spark, plain, ["transform", "clean"])
    run(spark, plain, ["transform", "clean"])
    for layer in ("bronze", "transformed", "silver"):
        names = [f.name for f in layers.noted_columns(spark, plain.target(layer))]
        assert names[-1] == "venue" and len(names) == len(set(names))
        assert "venue" in read_layer(spark, plain, layer, streaming=False).columns
    assert spark.read.text(f"{plain.target('silver')}/_columns").count() == 2


def test_a_layer_filled_from_outside_is_read_by_its_footers(spark, tmp_path):
    from ticksmith.sources import layers

    cfg = PipelineConfig(str(tmp_path), state_partitions=2)
    rows = spark.createDataFrame([([1], 5.0, "A", 1704067200000, 1.0)], BRONZE).withColumn("venue", F.lit("x"))
    rows.write.parquet(cfg.target("bronze"))
    run_stage(spark, cfg, "transform")
    assert layers.noted_columns(spark, cfg.target("bronze")) is None
    assert read_layer(spark, cfg, "transformed", streaming=False).first()["venue"] == "x"
