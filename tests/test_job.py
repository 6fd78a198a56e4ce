import json
from dataclasses import fields

import job
import pytest

from ticksmith import PipelineConfig, run
from ticksmith.operators import to_messages
from ticksmith.sources import read_layer


NEEDED = ["--env", "dev", "--space", "feature", "--base-path", "/data"]


def test_options_win_over_the_file(tmp_path, monkeypatch):
    file = tmp_path / "job.json"
    file.write_text(json.dumps({
        "env": "prod", "space": "release", "base_path": "/x", "dedup_within": "1 hour",
        "symbols": ["A", "B"], "source_options": {"subscribe": "t", "secret": "in file"},
    }))
    monkeypatch.setenv("JOB_SECRET", "from the environment")
    cfg, stages = job.settings([
        "--config", str(file), "--env", "dev", "--stages", "clean", "--state-partitions", "7",
        "--no-collapse-copies", "--source-option", "a=b=c", "--source-option-env", "secret=JOB_SECRET",
    ])
    assert (cfg.env, cfg.space, cfg.base_path, stages) == ("dev", "release", "/x", ["clean"])
    assert (cfg.dedup_within, cfg.symbols, cfg.state_partitions) == ("1 hour", ("A", "B"), 7)
    assert not cfg.collapse_copies
    assert cfg.source_options == {
        "subscribe": "t", "secret": "from the environment", "a": "b=c",
    }


def test_every_field_can_be_set(tmp_path):
    plain, stages = job.settings(NEEDED)
    assert stages == ["ingest", "transform", "clean", "ohlcv"]
    file = tmp_path / "job.json"
    file.write_text(json.dumps({f.name: getattr(plain, f.name) for f in fields(PipelineConfig)}))
    assert job.settings(["--config", str(file)])[0] == plain


@pytest.mark.parametrize("content", [{"wathermark": "1 minute"}, {"env": "dev"}])
def test_unknown_and_missing_settings_are_refused(tmp_path, content):
    file = tmp_path / "job.json"
    file.write_text(json.dumps(content))
    with pytest.raises(SystemExit):
        job.settings(["--config", str(file)])


def test_a_bounded_dedup_runs_from_a_file(spark, tmp_path):
    topic = str(tmp_path / "topic")
    rows = [("A", 1_700_000_000_000 + i % 5 * 1000, 1.0, 1.0) for i in range(20)]
    trades = spark.createDataFrame(rows, "symbol string, timestamp long, price double, volume double")
    trades = trades.selectExpr("array(1) AS conditions", "price", "symbol", "timestamp", "volume")
    to_messages(trades).write.parquet(topic)
    file = tmp_path / "job.json"
    file.write_text(json.dumps({
        "env": "dev", "space": "feature", "base_path": str(tmp_path / "lake"), "dedup_within": "1 hour",
        "source_format": "parquet", "source_options": {"path": topic}, "state_partitions": 2,
    }))
    cfg, stages = job.settings(["--config", str(file)])
    run(spark, cfg, stages[:3])
    assert read_layer(spark, cfg, "silver", streaming=False).count() == 5


def test_landing_and_a_bounded_dedup_run_through_the_job(spark, tmp_path):
    raw, topic, lake = (str(tmp_path / name) for name in ("raw", "topic", "lake"))
    start = 1_700_000_000_000
    trade = '{"type":"trade","data":[{"c":[1],"p":2.5,"s":"A","t":%d,"v":1.0}]}'
    values = [trade % (start + i % 5 * 1000) for i in range(20)] + ['{"type":"ping"}', "garbage", ""]
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.text(raw)
    arguments = [
        "--env", "dev", "--space", "feature", "--base-path", lake, "--dedup-within", "1 hour",
        "--raw-format", "text", "--raw-option", f"path={raw}", "--source-format", "parquet",
        "--source-option", f"path={topic}", "--state-partitions", "2",
    ]
    cfg, stages = job.settings(arguments)
    assert stages == ["land", "ingest", "transform", "clean", "ohlcv"]
    for _ in range(2):
        run(spark, cfg, stages)
        assert spark.read.parquet(topic).count() == 20
        assert read_layer(spark, cfg, "silver", streaming=False).count() == 5


def test_options_of_landing(monkeypatch):
    monkeypatch.setenv("RAW_SECRET", "hidden")
    cfg, stages = job.settings([
        *NEEDED, "--raw-option", "subscribe=raw", "--raw-option-env", "password=RAW_SECRET",
        "--topic-option", "topic=trades", "--stages", "land",
    ])
    assert cfg.raw_options == {"subscribe": "raw", "password": "hidden"}
    assert (cfg.topic_options, cfg.source_options, stages) == ({"topic": "trades"}, {}, ["land"])
