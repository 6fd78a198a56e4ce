import math

import pytest
from pyspark.sql import functions as F

from ticksmith import parse_trades, rejected_messages, route_messages, to_messages
from ticksmith.schemas import BRONZE

GOOD = '{"type":"trade","data":[{"c":[1],"p":101.5,"s":"AAA","t":1704067205123,"v":3.0}]}'


def messages(spark, *values):
    rows = [(i, None if v is None else bytearray(v, "utf-8")) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "message_id bigint, value binary")


def parsed(spark, value):
    return [tuple(r) for r in parse_trades(messages(spark, value)).collect()]


def trade(**fields):
    import json

    base = {"c": [1], "p": 2.0, "s": "A", "t": 5, "v": 1.0}
    return json.dumps({"data": [{**base, **fields}]})


def test_parse_gives_the_bronze_layout(spark):
    df = parse_trades(messages(spark, GOOD))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in BRONZE]
    assert [tuple(r) for r in df.collect()] == [([1], 101.5, "AAA", 1704067205123, 3.0)]


def test_every_trade_of_a_message_with_its_position(spark):
    value = '{"data":[{"p":1,"s":"A"},{"p":2,"s":"B"},{"p":3,"s":"C"}],"type":"x","more":1}'
    df = parse_trades(messages(spark, GOOD, value), carry=["message_id"], position="at")
    rows = df.select("message_id", "at", "price", "symbol").orderBy("message_id", "at").collect()
    assert [tuple(r) for r in rows] == [
        (0, 0, 101.5, "AAA"),
        (1, 0, 1.0, "A"),
        (1, 1, 2.0, "B"),
        (1, 2, 3.0, "C"),
    ]


def test_carried_names_must_not_hide_trade_columns(spark):
    df = messages(spark, GOOD).withColumn("timestamp", F.lit(1))
    with pytest.raises(ValueError, match="timestamp"):
        parse_trades(df, carry=["timestamp"])
    kept = parse_trades(df.withColumnRenamed("timestamp", "sent"), carry=["sent"])
    assert kept.select("sent", "timestamp").collect() == [(1, 1704067205123)]


@pytest.mark.parametrize(
    "value, row",
    [
        ('{"data":[{"p":2.0,"s":"A","t":5,"v":1.0}]}', (None, 2.0, "A", 5, 1.0)),
        (trade(c=None), (None, 2.0, "A", 5, 1.0)),
        (trade(c=["x"]), (None, 2.0, "A", 5, 1.0)),
        (trade(p="abc"), ([1], None, "A", 5, 1.0)),
        (trade(t="5"), ([1], 2.0, "A", None, 1.0)),
        (trade(t=5.5), ([1], 2.0, "A", None, 1.0)),
        (trade(s=7), ([1], 2.0, "7", 5, 1.0)),
        ('{"data":[null]}', (None, None, None, None, None)),
        ('{"data":[{"P":2.0,"s":"A"}]}', (None, None, "A", None, None)),
    ],
)
def test_a_bad_field_is_null_and_its_row_stays(spark, value, row):
    assert parsed(spark, value) == [row]


@pytest.mark.parametrize("price", ["NaN", '"NaN"'])
def test_nan_price_stays(spark, price):
    rows = parsed(spark, '{"data":[{"c":[1],"p":%s,"s":"A","t":5,"v":1.0}]}' % price)
    assert len(rows) == 1 and math.isnan(rows[0][1])


UNUSABLE = {
    '{"type":"ping"}': "no_data",
    '{"data":null}': "no_data",
    '{"data":{"p":1}}': "no_data",
    '[{"data":[{"p":1}]}]': "no_data",
    '{"data":[]}': "empty",
    '{"data":[{"p":1': "malformed",
    "garbage": "malformed",
    "": "malformed",
    None: "null",
}


@pytest.mark.parametrize("value", UNUSABLE)
def test_unusable_messages_give_no_row(spark, value):
    assert parsed(spark, value) == []


def test_unusable_messages_are_set_aside_with_their_reason(spark):
    df = rejected_messages(messages(spark, GOOD, *UNUSABLE, trade(p="abc")))
    assert df.columns == ["message_id", "value", "reason"]
    found = {None if r["value"] is None else r["value"].decode(): r["reason"] for r in df.collect()}
    assert found == UNUSABLE


def test_a_message_is_either_parsed_or_rejected(spark):
    df = messages(spark, GOOD, *UNUSABLE, trade(t="5"), '{"data":[null]}')
    kept = {r[0] for r in parse_trades(df, carry=["message_id"]).select("message_id").collect()}
    lost = {r[0] for r in rejected_messages(df).select("message_id").collect()}
    assert kept | lost == set(range(df.count())) and not kept & lost


@pytest.mark.parametrize(
    "value, trades",
    [
        (b'\xff\xfe{"type":"trade","data":[{"p":1}]}', 0),
        (b'{"type":"trade","data":[{"p":1,"s":"\xff"}]}', 1),
        ('{"data":[{"p":1}]}'.encode("utf-16"), 0),
        (b'{"data":[{"p":1}],"x":' + b"[" * 5000 + b"]" * 5000 + b"}", 0),
        (b'{"data":[{"p":1,"t":' + b"9" * 5000 + b"}]}", 0),
        (b'{"data":[{"p":1e999,"c":[99999999999],"t":99999999999999999999}]}', 1),
        (b'{"data":[' + b'{"p":1},' * 20_000 + b'{"p":1}]}', 20_001),
        (b'{"data":["x",{"p":1}]}', 0),
    ],
)
def test_no_message_fails_the_job_or_is_both_parsed_and_rejected(spark, value, trades):
    df = spark.createDataFrame([(bytearray(value),)], "value binary")
    assert parse_trades(df).count() == trades
    assert rejected_messages(df).count() == (0 if trades else 1)
    assert route_messages(df).count() in (0, 1)


def test_routing_by_type(spark):
    kept = [
        GOOD,
        '{"data":[],"type":"trade"}',
        '{"type":"trade","data":[{"p":NaN}]}',
        '{"type":"ping","type":"trade"}',
    ]
    dropped = [
        '{"type":"ping"}',
        '{"data":[{"p":1}]}',
        '{"type":"trade","data":[{"p":1',
        '[{"type":"trade"}]',
        '{"type":"trade","type":"ping"}',
        '{"TYPE":"trade"}',
        "{'type':'trade'}",
        "trade",
        None,
    ]
    df = route_messages(messages(spark, *kept, *dropped))
    assert sorted(bytes(r["value"]).decode() for r in df.collect()) == sorted(kept)
    pings = route_messages(messages(spark, *kept, *dropped), "ping")
    assert pings.count() == 2


def test_messages_round_trip(spark):
    rows = [
        ([1, 2], 101.5, "AAA", 1704067205123, 3.0),
        (None, None, None, None, None),
        ([], float("nan"), 'q"uote\\', -5, 0.1),
    ]
    sent = to_messages(spark.createDataFrame(rows, BRONZE))
    assert sent.columns == ["key", "value"]
    assert sent.where(F.col("key").isNotNull()).count() == 0
    assert route_messages(sent).count() == len(rows)
    # repr, since NaN equals nothing
    assert sorted(repr(tuple(r)) for r in parse_trades(sent).collect()) == sorted(map(repr, rows))
