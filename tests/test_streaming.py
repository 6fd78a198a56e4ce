import random
import time

import pytest
from helpers import MINUTE, START, candles_as_dict, plan, silver_rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ticksmith import PipelineConfig, add_event_time, candles, clean_trades
from ticksmith.plans import run_stage
from ticksmith.schemas import SILVER
from ticksmith.sources import read_layer
from ticksmith.streaming import append_available_now, progress_report, state_settings


class Feed:
    """A layer folder fed from outside and the stage that drains it, run after run."""

    def __init__(self, spark, folder, source, stage, target, **settings):
        self.spark, self.source, self.stage, self.target = spark, source, stage, target
        self.cfg = PipelineConfig(str(folder), count_state_rows=True, **settings)

    def run(self, rows=()):
        if rows:
            stored = silver_rows(self.spark, rows).repartition(3)
            stored.write.mode("append").parquet(self.cfg.target(self.source))
        return run_stage(self.spark, self.cfg, self.stage)

    def result(self):
        return read_layer(self.spark, self.cfg, self.target, streaming=False)

    def report(self, query):
        return progress_report(self.spark, query)


@pytest.fixture
def gold(spark, tmp_path):
    return lambda **settings: Feed(spark, tmp_path, "silver", "ohlcv", "gold", **settings)


@pytest.fixture
def silver(spark, tmp_path):
    return lambda **settings: Feed(spark, tmp_path, "transformed", "clean", "silver", **settings)


def at(minute, second=0):
    return START + minute * MINUTE + second * 1000


def starts(df):
    return sorted((start - START) // MINUTE for _, start in candles_as_dict(df))


def test_late_rows_run_by_run(gold):
    feed = gold()
    feed.run([("A", at(m, s), 1.0 + m, 1.0) for m in range(4) for s in (0, 50)])
    assert starts(feed.result()) == [0]

    feed.run()
    assert starts(feed.result()) == [0]

    # Minute 0 is closed and its row too late; minute 2 is older than the watermark's
    # newest row but still open; minute 5 moves the watermark to the end of minute 2.
    query = feed.run(
        [("A", at(0, 59), 99.0, 9.0), ("A", at(2, 30), 77.0, 5.0), ("A", at(5), 6.0, 1.0)]
    )
    assert starts(feed.result()) == [0, 1, 2]
    assert feed.report(query).agg(F.sum("late_rows_dropped")).first()[0] == 1

    feed.run([("A", at(10), 11.0, 1.0)])
    assert candles_as_dict(feed.result()) == {
        ("A", at(0)): (1.0, 1.0, 1.0, 1.0, 2.0),
        ("A", at(1)): (2.0, 2.0, 2.0, 2.0, 2.0),
        ("A", at(2)): (3.0, 77.0, 3.0, 3.0, 7.0),
        ("A", at(3)): (4.0, 4.0, 4.0, 4.0, 2.0),
        ("A", at(5)): (6.0, 6.0, 6.0, 6.0, 1.0),
    }


def test_one_watermark_for_all_symbols(gold):
    feed = gold()
    feed.run([("BUSY", at(10), 1.0, 1.0)])
    feed.run([("QUIET", at(1), 1.0, 1.0), ("BUSY", at(20), 1.0, 1.0)])
    assert set(candles_as_dict(feed.result())) == {("BUSY", at(10))}


@pytest.mark.parametrize(
    "settings", [{}, {"max_files_per_trigger": 1}, {"state_provider": "memory"}]
)
def test_stream_equals_closed_windows_of_the_batch(spark, gold, settings):
    rng = random.Random(1)
    moments = sorted(rng.sample(range(40 * MINUTE), 600))
    rows = [
        (
            "HOT" if rng.random() < 1 / 3 else rng.choice("ABC"),
            START + moment,
            rng.choice([1.0, 2.0, 3.5]),
            float(rng.randrange(5)),
        )
        for moment in moments
    ]
    # Thirds in time order, one file each: no row is late however the runs are cut.
    feed = gold(**settings)
    for third in range(3):
        part = silver_rows(spark, rows[third * 200 : (third + 1) * 200]).coalesce(1)
        part.write.mode("append").parquet(feed.cfg.target("silver"))
        feed.run()

    every = silver_rows(spark, rows)
    limit = every.agg(F.max("time") - F.expr("interval 2 minutes")).first()[0]
    end = F.col("candle_time") + F.expr("interval 1 minute")
    closed = candles(every).where(end <= F.lit(limit))
    assert candles_as_dict(feed.result()) == candles_as_dict(closed)
    assert feed.result().count() == closed.count() > 0


@pytest.mark.parametrize("seed", range(3))
def test_disordered_runs_against_a_plain_watermark(gold, seed):
    """A row counts while its window's end is beyond the watermark the runs before it left;
    a window is written when the watermark reaches its end."""
    rng = random.Random(seed)
    feed = gold()
    watermark, newest, open_windows, written, late = 0, 0, {}, {}, 0
    for run in range(5):
        stamps = rng.sample(range(max(0, run * 4 - 6) * MINUTE, (run * 4 + 4) * MINUTE), 60)
        rows = [
            (rng.choice("AB"), START + stamp, rng.choice([1.0, 2.0, 5.0]), 1.0) for stamp in stamps
        ]
        feed.run(rows)

        for symbol, timestamp, price, volume in rows:
            start = timestamp // MINUTE * MINUTE
            if start + MINUTE > watermark:
                open_windows.setdefault((symbol, start), []).append((timestamp, price, volume))
            else:
                late += 1
        newest = max([newest, *(timestamp // 1000 * 1000 for _, timestamp, _, _ in rows)])
        watermark = newest - 2 * MINUTE
        for key in [key for key in open_windows if key[1] + MINUTE <= watermark]:
            trades = sorted(open_windows.pop(key))
            prices = [price for _, price, _ in trades]
            volume = sum(volume for _, _, volume in trades)
            written[key] = (prices[0], max(prices), min(prices), prices[-1], volume)
        assert candles_as_dict(feed.result()) == written
    assert late > 0 and feed.result().count() == len(written)


def waves(seed):
    """Three waves of trades on few keys, a third of them on one; the price names the wave."""
    rng = random.Random(seed)
    return [
        [
            ("HOT", at(0), float(wave), 1.0)
            if rng.random() < 1 / 3
            else (rng.choice("ABC"), at(rng.randrange(30)), float(wave), 1.0)
            for _ in range(150)
        ]
        for wave in (1, 2, 3)
    ]


@pytest.mark.parametrize("mode", ["dedup_first", "filter_first"])
def test_collapsing_never_loses_a_key(silver, tmp_path, spark, mode):
    rng = random.Random(4)
    prices = [-1.0, 0.0, None, 2.0, 2.0, 2.0]
    rows = [
        (rng.choice("AB"), at(rng.randrange(90)), rng.choice(prices), 1.0) for _ in range(300)
    ]
    keys = {(symbol, timestamp) for symbol, timestamp, price, _ in rows if price and price > 0}
    always_good = keys - {(s, t) for s, t, price, _ in rows if not (price and price > 0)}
    feed = silver(clean_mode=mode)
    feed.run(rows)
    found = [(r["symbol"], r["timestamp"]) for r in feed.result().collect()]
    assert len(found) == len(set(found))
    if mode == "filter_first":
        assert set(found) == keys
    else:
        assert always_good <= set(found) <= keys


@pytest.mark.parametrize(
    "settings",
    [{}, {"collapse_copies": False}, {"dedup_within": "2 hours"}],
)
def test_earliest_run_wins(silver, settings):
    feed = silver(**settings)
    expected = {}
    for wave in waves(3):
        feed.run(wave)
        for symbol, timestamp, price, _ in wave:
            expected.setdefault((symbol, timestamp), price)
    found = [(r["symbol"], r["timestamp"], r["price"]) for r in feed.result().collect()]
    assert sorted(found) == sorted((*key, price) for key, price in expected.items())


def test_a_bad_row_blocks_its_key_in_later_runs_unless_filtered_first(silver, tmp_path, spark):
    bad, good = [("A", at(0), -1.0, 1.0)], [("A", at(0), 5.0, 1.0)]
    feed = silver()
    feed.run(bad)
    feed.run(good)
    assert feed.result().count() == 0
    other = Feed(spark, tmp_path / "o", "transformed", "clean", "silver", clean_mode="filter_first")
    other.run(bad)
    other.run(good)
    assert other.result().count() == 1


def test_rows_without_symbol_take_no_state(silver):
    feed = silver()
    query = feed.run([(None, at(i), 1.0, 1.0) for i in range(20)] + [("A", at(0), 1.0, 1.0)])
    assert feed.report(query).agg(F.max("state_rows")).first()[0] == 1


def test_bounded_dedup_forgets_and_unbounded_does_not(silver, tmp_path, spark):
    def state_after(feed):
        for hour in range(3):
            query = feed.run([("A", at(60 * hour + i), 1.0, 1.0) for i in range(10)])
        return feed.report(query).orderBy(F.desc("batch_id")).first()["state_rows"]

    assert state_after(silver()) == 30
    bounded = Feed(
        spark,
        tmp_path / "bounded",
        "transformed",
        "clean",
        "silver",
        dedup_within="15 minutes",
    )
    assert state_after(bounded) < 30
    assert bounded.result().count() == 30


def test_nothing_new_adds_nothing(silver):
    feed = silver()
    feed.run([("A", at(0), 1.0, 1.0)])
    before = feed.result().count()
    feed.run()
    assert feed.result().count() == before == 1


def test_a_run_without_any_input_leaves_an_empty_layer(spark, gold, tmp_path):
    feed = gold()
    silver_rows(spark, []).write.parquet(feed.cfg.target("silver"))
    feed.run()
    assert feed.result().count() == 0


def stream_of(spark, folder, rows):
    silver_rows(spark, rows).write.mode("append").parquet(folder)
    return spark.readStream.schema(SILVER).parquet(folder)


def test_a_new_checkpoint_over_an_old_folder_is_refused(spark, tmp_path):
    rows = stream_of(spark, str(tmp_path / "in"), [("A", at(0), 1.0, 1.0)])
    target = str(tmp_path / "out")
    append_available_now(rows, target, str(tmp_path / "first"))
    append_available_now(rows, target, str(tmp_path / "first"))
    with pytest.raises(ValueError, match="another checkpoint"):
        append_available_now(rows, target, str(tmp_path / "second"))
    assert spark.read.parquet(target).count() == 1


def test_a_new_checkpoint_over_an_old_table_is_refused(spark, tmp_path):
    rows = stream_of(spark, str(tmp_path / "in"), [("A", at(0), 1.0, 1.0)])
    for _ in range(2):
        append_available_now(rows, "lost_and_found", str(tmp_path / "first"), as_table=True)
    with pytest.raises(ValueError, match="another checkpoint"):
        append_available_now(rows, "lost_and_found", str(tmp_path / "second"), as_table=True)
    assert spark.table("lost_and_found").count() == 1
    spark.sql("DROP TABLE lost_and_found")


@pytest.mark.parametrize("as_table", [False, True])
def test_a_run_that_fails_half_way_is_taken_up_without_loss_or_repeat(spark, tmp_path, as_table):
    folder = str(tmp_path / "in")
    for minute in range(4):
        rows = [("A", at(minute, s), 1.0, 1.0) for s in range(5)] * 2
        silver_rows(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    stream = (
        spark.readStream.schema(SILVER).option("maxFilesPerTrigger", "1").parquet(folder)
    )
    target = "half_way" if as_table else str(tmp_path / "out")
    checkpoint = str(tmp_path / "checkpoint")

    in_third_file = F.col("timestamp") == at(2, 3)
    no_good = F.raise_error(F.lit("no good")).cast("double")
    failing = stream.withColumn("volume", F.when(in_third_file, no_good).otherwise(F.col("volume")))
    with pytest.raises(StreamingQueryException, match="no good"):
        append_available_now(clean_trades(failing), target, checkpoint, as_table=as_table)

    def stored():
        found = spark.table(target) if as_table else spark.read.parquet(target)
        return sorted(r["timestamp"] for r in found.select("timestamp").collect())

    assert stored() == [at(minute, s) for minute in range(2) for s in range(5)]
    append_available_now(clean_trades(stream), target, checkpoint, as_table=as_table)
    assert stored() == [at(minute, s) for minute in range(4) for s in range(5)]
    if as_table:
        spark.sql("DROP TABLE half_way")


def test_a_failing_query_raises(spark, tmp_path):
    rows = stream_of(spark, str(tmp_path / "in"), [("A", at(0), 1.0, 1.0)])
    failing = rows.withColumn("symbol", F.raise_error(F.lit("no good")).cast("string"))
    with pytest.raises(StreamingQueryException, match="no good"):
        append_available_now(failing, str(tmp_path / "out"), str(tmp_path / "checkpoint"))


def test_a_query_out_of_time_is_stopped(spark, tmp_path):
    rows = stream_of(spark, str(tmp_path / "in"), [("A", at(0), 1.0, 1.0)])
    wait = F.udf(lambda value: time.sleep(8) or value)
    slow = rows.withColumn("symbol", wait("symbol"))
    with pytest.raises(TimeoutError):
        append_available_now(
            slow, str(tmp_path / "out"), str(tmp_path / "checkpoint"), timeout_seconds=1
        )
    assert spark.streams.active == []


def test_state_settings_come_back(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"]
    before = [spark.conf.get(name, None) for name in names]
    with pytest.raises(RuntimeError), state_settings(spark, partitions=3):
        assert spark.conf.get(names[0]) == "3"
        assert spark.conf.get(names[1]).endswith("RocksDBStateStoreProvider")
        raise RuntimeError
    assert [spark.conf.get(name, None) for name in names] == before


def test_candle_stream_aggregates_before_its_shuffle(spark, tmp_path):
    rows = stream_of(spark, str(tmp_path / "in"), [("A", at(0), 1.0, 1.0)])
    text = plan(candles(rows))
    tree = text[: text.index("(1) ")]
    # Printed top down: final, merge, state, merge, exchange, partial.
    assert tree.rindex("HashAggregate") > tree.index("Exchange")
    assert "SortAggregate" not in tree and "Python" not in tree


def test_dedup_stream_filters_symbols_and_collapses_copies_below_its_shuffle(spark, tmp_path):
    rows = stream_of(spark, str(tmp_path / "in"), [("A", at(0), 1.0, 1.0)])
    text = plan(clean_trades(rows))
    tree = text[: text.index("(1) ")]
    steps = ["StreamingDeduplicate", "Exchange", "ArrowEvalPython", "Filter"]
    assert [tree.rindex(step) for step in steps] == sorted(tree.rindex(step) for step in steps)
    assert "isnotnull(symbol" in text[text.index("(1) ") :]
    bare = plan(clean_trades(rows, collapse_copies=False))
    assert "Python" not in bare and bare.count("Exchange") == text.count("Exchange")


def test_a_hot_key_sends_few_rows_through_the_shuffle(spark, tmp_path):
    folder = str(tmp_path / "in")
    keys = spark.range(60_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise("A").alias("symbol"),
        (F.lit(START) + F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("timestamp"),
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("volume"),
        F.array(F.lit(1)).alias("conditions"),
    )
    add_event_time(keys).select(*SILVER.names).write.parquet(folder)
    rows = spark.readStream.schema(SILVER).parquet(folder)
    target = str(tmp_path / "out")
    query = append_available_now(clean_trades(rows), target, str(tmp_path / "c"))
    dropped = sum(
        operator["customMetrics"].get("numDroppedDuplicateRows", 0)
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
    assert spark.read.parquet(target).count() == 40_001
    # 20,000 copies come in; what the state still has to drop is about one per Arrow batch.
    assert 0 < dropped < 50


def test_a_missing_timestamp_is_a_key_like_any_other(silver):
    feed = silver()
    feed.run([("A", None, 1.0, 1.0), ("A", None, 1.0, 1.0), ("B", None, 1.0, 1.0)])
    feed.run([("A", None, 2.0, 1.0)])
    assert sorted(r["symbol"] for r in feed.result().collect()) == ["A", "B"]


def test_ms_precision_closes_windows_by_the_millisecond(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = stream_of(spark, folder, [("A", START, 1.0, 1.0), ("A", START + 180_999, 1.0, 1.0)])
    timed = add_event_time(rows.drop("time", "time_stamp"), "ms")
    query = append_available_now(candles(timed), str(tmp_path / "out"), str(tmp_path / "c"))
    last = progress_report(spark, query).orderBy(F.desc("batch_id")).first()
    assert last["watermark"].endswith("00:01:00.999Z")
    assert starts(spark.read.parquet(str(tmp_path / "out"))) == [0]
