"""First arrivals of a stream, inside a micro-batch and across restarts."""

import math

import pytest
from helpers import MINUTE, START, clean_by_hand
from pyspark.sql import functions as F

from ticksmith import PipelineConfig, add_event_time
from ticksmith.plans import run_stage
from ticksmith.sources import read_layer

ROWS = "arrival bigint, symbol string, timestamp bigint, price double, volume double"


def store(spark, cfg, rows, files=1):
    frame = add_event_time(spark.createDataFrame(rows, ROWS))
    frame = frame.withColumn("conditions", F.array(F.lit(1), F.lit(None).cast("int")))
    names = ["conditions", "price", "symbol", "timestamp", "volume", "time_stamp", "time", "arrival"]
    frame.select(*names).repartition(files).write.mode("append").parquet(cfg.target("transformed"))


def silver(spark, cfg):
    return read_layer(spark, cfg, "silver", streaming=False)


def kept(spark, cfg):
    return sorted((r.arrival, r.symbol, r.timestamp, r.price) for r in silver(spark, cfg).collect())


@pytest.mark.parametrize("collapse", [True, False])
@pytest.mark.parametrize("mode", ["dedup_first", "filter_first"])
def test_the_least_arrival_of_a_micro_batch_survives(spark, tmp_path, mode, collapse):
    cfg = PipelineConfig(
        str(tmp_path), arrival=("arrival",), clean_mode=mode, collapse_copies=collapse, state_partitions=2
    )
    rows = []
    for i in range(300):
        price = -1.0 if i % 7 == 0 else float(i)
        rows.append((1000 - i, "AB"[i % 2], START + (i % 40) * 1000, price, 1.0))
    store(spark, cfg, rows, files=3)
    run_stage(spark, cfg, "clean")
    assert kept(spark, cfg) == sorted(r[:4] for r in clean_by_hand(rows, mode))


def test_an_earlier_micro_batch_wins_after_a_restart(spark, tmp_path):
    cfg = PipelineConfig(str(tmp_path), arrival=("arrival",), state_partitions=2)
    store(spark, cfg, [(9, "A", START, 9.0, 1.0), (8, "A", START, 8.0, 1.0), (7, "B", START, -7.0, 1.0)])
    run_stage(spark, cfg, "clean")
    store(spark, cfg, [(1, "A", START, 1.0, 1.0), (2, "B", START, 2.0, 1.0), (3, "A", START + 1, 3.0, 1.0)])
    run_stage(spark, cfg, "clean")
    # The bad first row of B hides its later one, as in a batch.
    assert kept(spark, cfg) == [(3, "A", START + 1, 3.0), (8, "A", START, 8.0)]


def test_odd_values_stay_as_they_are(spark, tmp_path):
    cfg = PipelineConfig(str(tmp_path), arrival=("arrival",), state_partitions=2)
    nan = math.nan
    store(spark, cfg, [
        (2, "A", None, 5.0, 1.0), (1, "A", None, 6.0, None), (3, "A", -1, nan, nan), (None, "A", START, 7.0, 1.0),
        (0, "A", START, 8.0, 1.0), (4, "", START, 1.0, 1.0), (5, None, START, 1.0, 1.0), (6, "A", 2**62, 1.0, 1.0),
        (7, "A", START + 5, None, 1.0),
    ])
    run_stage(spark, cfg, "clean")
    found = {r.arrival: r for r in silver(spark, cfg).collect()}
    assert set(found) == {1, 3, None, 4, 6}
    assert found[1].volume is None and math.isnan(found[3].price) and math.isnan(found[3].volume)
    assert found[None].price == 7.0 and found[4].symbol == "" and found[6].timestamp == 2**62
    assert found[1].conditions == [1, None]


def test_bounded_state_drops_late_rows_and_is_cleared(spark, tmp_path):
    cfg = PipelineConfig(
        str(tmp_path), arrival=("arrival",), dedup_within="2 minutes", state_partitions=1, count_state_rows=True
    )
    store(spark, cfg, [(2, "A", START, 2.0, 1.0), (1, "A", START, 1.0, 1.0), (3, "A", START + 20 * MINUTE, 3.0, 1.0)])
    first = run_stage(spark, cfg, "clean")
    store(spark, cfg, [(4, "A", START, 4.0, 1.0), (5, "A", START + 19 * MINUTE, 5.0, 1.0)])
    run_stage(spark, cfg, "clean")
    assert kept(spark, cfg) == [
        (1, "A", START, 1.0), (3, "A", START + 20 * MINUTE, 3.0), (5, "A", START + 19 * MINUTE, 5.0)
    ]
    assert first.recentProgress[-1]["stateOperators"]


def test_arrival_is_carried_from_the_messages(spark, tmp_path):
    cfg = PipelineConfig(str(tmp_path), arrival=("position",), source_format="parquet",
                         source_options={"path": f"{tmp_path}/topic"}, state_partitions=2)
    trades = [f'{{"s":"A","t":{START},"p":{p},"v":1,"c":[1]}}' for p in (5, 6, 7)]
    value = f'{{"type":"trade","data":[{",".join(trades)}]}}'.encode()
    spark.createDataFrame([(None, value)], "key binary, value binary").write.parquet(f"{tmp_path}/topic")
    for stage in ("ingest", "transform", "clean"):
        run_stage(spark, cfg, stage)
    assert [(r.price, r.position) for r in silver(spark, cfg).collect()] == [(5.0, 0)]
