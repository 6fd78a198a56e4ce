import math
import random

import pytest
from helpers import (
    MINUTE,
    START,
    candles_as_dict,
    candles_by_hand,
    clean_by_hand,
    plan,
    trade_rows,
)
from pyspark.sql import functions as F

from ticksmith import add_event_time, batch_candles, candles, clean_trades, to_messages
from ticksmith.schemas import GOLD

NAN = float("nan")


def of(spark, rows, **options):
    return candles(add_event_time(trade_rows(spark, rows)), **options)


def test_layout(spark):
    df = of(spark, [(1, "A", START, 1.0, 1.0)])
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in GOLD]


def test_open_and_close_follow_event_time_not_arrival(spark):
    rows = [
        (1, "A", START + 30_000, 3.0, 1.0),
        (2, "A", START + 59_999, 9.0, 2.0),
        (3, "A", START + 1, 5.0, 4.0),
        (4, "A", START + MINUTE, 7.0, 8.0),
    ]
    assert candles_as_dict(of(spark, rows)) == {
        ("A", START): (5.0, 9.0, 3.0, 9.0, 7.0),
        ("A", START + MINUTE): (7.0, 7.0, 7.0, 7.0, 8.0),
    }


def test_nan_null_and_missing_time(spark):
    rows = [
        (1, "A", START, 1.0, None),
        (2, "A", START + 1, NAN, None),
        (3, "A", None, 5.0, 1.0),
        (4, "B", START, 2.0, None),
        (5, "B", START + 1, 2.0, 3.0),
    ]
    found = candles_as_dict(of(spark, rows))
    opening, high, low, _, volume = found.pop(("A", START))
    assert (opening, low, volume) == (1.0, 1.0, None) and math.isnan(high)
    assert found == {("B", START): (2.0, 2.0, 2.0, 2.0, 3.0)}


def test_windows_before_1970(spark):
    found = candles_as_dict(of(spark, [(1, "A", -1500, 1.0, 1.0), (2, "A", -61_000, 2.0, 1.0)]))
    assert set(found) == {("A", -MINUTE), ("A", -2 * MINUTE)}


def random_trades(seed, count=2000):
    rng = random.Random(seed)
    return [
        (
            i,
            "HOT" if rng.random() < 1 / 3 else rng.choice(["A", "B", "C", None]),
            START + rng.randrange(20 * MINUTE),
            rng.choice([-1.0, 0.0, 1.0, 2.5, 9.0, 4.25]),
            float(rng.randrange(10)),
        )
        for i in range(count)
    ]


@pytest.mark.parametrize("width, width_ms", [("1 minute", MINUTE), ("7 minutes", 7 * MINUTE)])
def test_against_brute_force(spark, width, width_ms):
    rows = random_trades(5)
    clean = clean_trades(trade_rows(spark, rows), arrival="arrival")
    found = candles_as_dict(candles(add_event_time(clean), width))
    assert found == candles_by_hand(clean_by_hand(rows), width_ms)


def test_invariants_and_partitioning(spark):
    rows = random_trades(6)
    clean = add_event_time(clean_trades(trade_rows(spark, rows), arrival="arrival"))
    result = candles(clean)
    low, high = F.col("low"), F.col("high")
    inside = F.col("open").between(low, high) & F.col("close").between(low, high)
    assert result.where(~inside).count() == 0
    assert result.count() == result.select("symbol", "candle_time").distinct().count()
    total = clean.agg(F.sum("volume")).first()[0]
    assert result.agg(F.sum("volume")).first()[0] == total
    assert candles_as_dict(candles(clean.repartition(7))) == candles_as_dict(
        candles(clean.coalesce(1))
    )


def test_arrival_order_takes_a_price_of_the_window(spark):
    rows = [(i, "A", START + i, float(i % 10 + 1), 1.0) for i in range(100)]
    opening, high, low, close, volume = candles_as_dict(of(spark, rows, order="arrival"))[
        ("A", START)
    ]
    assert (high, low, volume) == (10.0, 1.0, 100.0)
    assert low <= opening <= high and low <= close <= high


def test_batch_plan_from_messages(spark):
    rows = random_trades(7)
    trades = trade_rows(spark, rows).withColumn("conditions", F.array(F.lit(1)))
    messages = trades.select("arrival", "conditions", "price", "symbol", "timestamp", "volume")
    envelopes = messages.select(
        "arrival",
        F.to_json(
            F.struct(
                F.array(
                    F.struct(
                        F.col("price").alias("p"),
                        F.col("symbol").alias("s"),
                        F.col("timestamp").alias("t"),
                        F.col("volume").alias("v"),
                    )
                ).alias("data")
            )
        )
        .cast("binary")
        .alias("value"),
    )
    found = candles_as_dict(batch_candles(envelopes, "arrival"))
    assert found == candles_by_hand(clean_by_hand(rows))


def test_position_in_the_message_decides_between_trades_of_one_message(spark):
    value = (
        '{"data":[{"p":1,"s":"A","t":%d,"v":1},{"p":2,"s":"A","t":%d,"v":2}]}' % (START, START)
    )
    df = spark.createDataFrame([(5, bytearray(value, "utf-8"))], "id bigint, value binary")
    assert candles_as_dict(batch_candles(df, "id")) == {("A", START): (1.0, 1.0, 1.0, 1.0, 1.0)}


def _one_trade(price):
    return bytearray(f'{{"data":[{{"p":{price},"s":"A","t":1,"v":1}}]}}', "utf-8")


def test_ids_over_the_whole_range_order_arrival(spark):
    ids = [2**63 - 1, 2**62, 10**15, 0, -1, -(2**63)]
    for first in range(len(ids)):
        rows = [(i, _one_trade(n + 1)) for n, i in enumerate(ids[first:])]
        df = spark.createDataFrame(rows, "id bigint, value binary")
        assert batch_candles(df.limit(first + 6), "id").first()["open"] == len(rows)


def test_a_null_message_id_fails_loudly(spark):
    df = spark.createDataFrame([(None, _one_trade(1))], "id bigint, value binary")
    with pytest.raises(Exception, match="NULL"):
        batch_candles(df, "id").collect()


def test_several_columns_order_arrival_where_one_repeats(spark):
    rows = [(7, part, _one_trade(part + 1)) for part in (3, 1, 2, 4)]
    df = spark.createDataFrame(rows, "offset bigint, partition int, value binary").repartition(4)
    assert batch_candles(df, ["offset", "partition"]).first()["open"] == 2.0


def test_batch_plan_is_two_hash_aggregations_over_pruned_columns(spark, tmp_path):
    stored = str(tmp_path / "messages")
    trades = trade_rows(spark, random_trades(8, 100)).withColumn("conditions", F.array(F.lit(1)))
    to_messages(trades).withColumn("id", F.monotonically_increasing_id()).write.parquet(stored)
    text = plan(batch_candles(spark.read.parquet(stored), "id"))
    assert "ReadSchema: struct<value:binary,id:bigint>" in text
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    tree = text[: text.index("(1) ")]
    assert tree.count("Exchange") == 2 and tree.count("HashAggregate") == 4
    assert "Sort " not in tree and "SinglePartition" not in text and "Python" not in text
    assert "min_by(conditions" not in text and "min_by(time_stamp" not in text


def test_unknown_order(spark):
    with pytest.raises(ValueError, match="order"):
        of(spark, [], order="other")
