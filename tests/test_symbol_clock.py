"""Candles closed by the trades of their own symbol."""

import math
import random

import pytest
from helpers import MINUTE, START, candles_as_dict, candles_by_hand, silver_rows

from ticksmith import PipelineConfig
from ticksmith.plans import run_stage
from ticksmith.sources import read_layer


def run_waves(spark, folder, waves, **settings):
    cfg = PipelineConfig(str(folder), clock="symbol", state_partitions=2, **settings)
    for rows in waves:
        silver_rows(spark, rows).repartition(3).write.mode("append").parquet(cfg.target("silver"))
        run_stage(spark, cfg, "ohlcv")
    return candles_as_dict(read_layer(spark, cfg, "gold", streaming=False))


def test_a_far_trade_closes_its_own_symbol_only(spark, tmp_path):
    far = START + 10_000 * MINUTE
    waves = [
        [("A", START, 1.0, 1.0), ("B", START, 2.0, 1.0), ("A", far, 9.0, 1.0)],
        [("A", START + MINUTE, 3.0, 1.0), ("B", START + 1000, 4.0, 1.0), ("B", START + 5 * MINUTE, 5.0, 1.0)],
        [("B", START + 9 * MINUTE, 6.0, 1.0)],
    ]
    found = run_waves(spark, tmp_path, waves)
    assert found == {
        ("A", START): (1.0, 1.0, 1.0, 1.0, 1.0),
        ("B", START): (2.0, 4.0, 2.0, 4.0, 2.0),
        ("B", START + 5 * MINUTE): (5.0, 5.0, 5.0, 5.0, 1.0),
    }


def test_equals_the_batch_but_for_open_windows(spark, tmp_path):
    draw = random.Random(3)
    rows, seen = [], set()
    for _ in range(1200):
        symbol, at = draw.choice("AAAABC"), START + draw.randrange(40 * 60) * 1000
        if (symbol, at) not in seen:
            seen.add((symbol, at))
            rows.append((symbol, at, float(draw.randrange(1, 90)), float(draw.randrange(9))))
    rows.sort(key=lambda r: r[1])
    # Cut by time, so that no trade comes after its window has closed.
    waves = [rows[:500], rows[500:900], rows[900:]]
    found = run_waves(spark, tmp_path, waves)
    clocks = {s: max(r[1] for r in rows if r[0] == s) for s in "ABC"}
    wanted = candles_by_hand([(None, *r) for r in rows])
    assert found == {k: v for k, v in wanted.items() if k[1] + MINUTE <= clocks[k[0]] - 2 * MINUTE}


def test_odd_values(spark, tmp_path):
    nan, late = math.nan, START + 30 * MINUTE
    rows = [
        (None, START, 1.0, 2.0), (None, late, 1.0, 1.0), ("A", START, 5.0, None), ("A", START + 1000, nan, None),
        ("A", late, 1.0, 1.0), ("A", None, 7.0, 1.0), ("B", START, 3.0, None), ("B", START + 2000, 2.0, 4.0),
        ("B", late, 1.0, 1.0),
    ]
    found = run_waves(spark, tmp_path, [rows])
    assert found[None, START] == (1.0, 1.0, 1.0, 1.0, 2.0)
    opening, high, low, closing, volume = found["A", START]
    assert (opening, low, volume) == (5.0, 5.0, None) and math.isnan(high) and math.isnan(closing)
    assert found["B", START] == (3.0, 3.0, 2.0, 2.0, 4.0)
    assert len(found) == 3


def test_settings_are_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="clock"):
        PipelineConfig(str(tmp_path), clock="wall")
    with pytest.raises(ValueError, match="event time"):
        run_waves(spark, tmp_path, [[("A", START, 1.0, 1.0)]], order="arrival")
