"""What reaches the files: columns, row filters and day folders."""

import re

import pytest
from helpers import MINUTE, START, plan, silver_rows
from pyspark.sql import functions as F

from ticksmith import PipelineConfig, candles, clean_trades
from ticksmith.sources import read_layer


@pytest.fixture
def silver(spark, tmp_path):
    cfg = PipelineConfig(str(tmp_path), partition_by_date=True)
    rows = [("AB"[i % 2], START + i * 60 * MINUTE, 1.0 + i, 1.0) for i in range(72)]
    days = silver_rows(spark, rows).withColumn("trade_date", F.to_date("time"))
    days.write.partitionBy("trade_date").parquet(cfg.target("silver"))
    return read_layer(spark, cfg, "silver", streaming=False)


def scan(df):
    text = plan(df)
    found = {name: re.search(rf"^{name}: (.*)$", text, re.M) for name in SCAN}
    return {name: match.group(1) if match else "" for name, match in found.items()}


SCAN = ("ReadSchema", "PushedFilters", "PartitionFilters")


def columns(read_schema):
    return re.findall(r"(\w+):", read_schema)


def test_candles_read_the_columns_they_use(silver):
    read = scan(candles(silver))
    assert columns(read["ReadSchema"]) == ["price", "symbol", "timestamp", "volume", "time"]
    assert "IsNotNull(time)" in read["PushedFilters"]


def test_a_symbol_of_the_result_is_filtered_in_the_files(silver):
    read = scan(candles(silver).where("symbol = 'A'"))
    assert "EqualTo(symbol,A)" in read["PushedFilters"]


def test_a_time_range_before_the_grouping_is_filtered_in_the_files(silver):
    since = F.lit("2024-01-02").cast("timestamp")
    read = scan(candles(silver.where(F.col("time") >= since)))
    assert "GreaterThanOrEqual(time" in read["PushedFilters"]


def test_a_day_skips_the_other_folders(silver):
    one_day = silver.where(F.col("trade_date") == F.lit("2024-01-02").cast("date"))
    assert "trade_date" in scan(candles(one_day))["PartitionFilters"]
    assert candles(one_day).count() == 24


def test_cleaning_for_candles_reads_neither_conditions_nor_text(silver):
    trades = silver.withColumn("arrival", F.col("timestamp"))
    read = scan(candles(clean_trades(trades, arrival="arrival")))
    assert columns(read["ReadSchema"]) == ["price", "symbol", "timestamp", "volume", "time"]
    assert "IsNotNull(symbol)" in read["PushedFilters"]
