"""Counts of what micro-batches hold, and keys in a stopped query's state."""

from helpers import MINUTE, START, silver_rows, utc

from ticksmith import PipelineConfig
from ticksmith.plans import LAND, run, run_stage
from ticksmith.streaming import delivery_report, keys_in_state


def counts(spark, query):
    report = delivery_report(spark, query)
    totals = report.groupBy("observed", "measure").sum("rows").collect()
    return {(r[0], r[1]): r[2] for r in totals}


def messages(spark, texts):
    rows = [(None, None if t is None else bytearray(t.encode())) for t in texts]
    return spark.createDataFrame(rows, "key binary, value binary")


def test_every_message_is_accounted_for(spark, tmp_path):
    raw, topic = {"path": f"{tmp_path}/raw"}, {"path": f"{tmp_path}/topic"}
    cfg = PipelineConfig(
        str(tmp_path), source_format="parquet", source_options=topic, raw_format="parquet",
        raw_options=raw, state_partitions=2, count_content=True,
    )
    trade = '{"type":"trade","data":[{"p":%s,"s":%s,"t":1704067200000,"v":1}]}'
    texts = [trade % (1, '"A"'), trade % (-1, '"B"'), trade % (1, "null"), trade % ("null", '"C"')]
    others = ['{"type":"ping"}', '{"type":"trade","data":[]}', '{"type":"trade"}', "no json", None, ""]
    messages(spark, texts + others).write.parquet(raw["path"])
    done = run(spark, cfg)
    assert counts(spark, done[LAND]) == {("read", "messages"): 10, ("written", "messages"): 6}
    # Without routing, so that the stage meets every kind.
    unrouted = {"path": f"{tmp_path}/unrouted"}
    messages(spark, others).write.parquet(unrouted["path"])
    other = PipelineConfig(
        f"{tmp_path}/other", source_format="parquet", source_options=unrouted, count_content=True
    )
    again = run_stage(spark, other, "ingest")
    first, second = counts(spark, done["ingest"]), counts(spark, again)
    assert first["messages", "read"] == 6 and first["messages", "accepted"] == 4
    assert first["messages", "rejected_empty"] == 1 and first["messages", "rejected_no_data"] == 1
    assert first["written", "rows"] == 4
    assert second["messages", "read"] == 6 == sum(
        n for (at, measure), n in second.items() if measure.startswith("rejected_")
    )
    assert counts(spark, done["clean"]) == {
        ("trades", "read"): 4, ("trades", "no_symbol"): 1, ("trades", "bad_price"): 2, ("written", "rows"): 1,
    }


def test_nothing_counted_without_the_setting(spark, tmp_path):
    cfg = PipelineConfig(str(tmp_path), state_partitions=2)
    silver_rows(spark, [("A", START, 1.0, 1.0)]).write.parquet(cfg.target("transformed"))
    assert delivery_report(spark, run_stage(spark, cfg, "clean")).count() == 0


def test_keys_leave_a_bounded_state(spark, tmp_path):
    cfg = PipelineConfig(str(tmp_path), state_partitions=2, dedup_within="2 minutes")
    for rows in (
        [("A", START, 1.0, 1.0), ("B", START + MINUTE, 1.0, 1.0), ("B", START + MINUTE, 2.0, 1.0)],
        [("A", START + 4 * MINUTE + 30_000, 1.0, 1.0)],
    ):
        silver_rows(spark, rows).write.mode("append").parquet(cfg.target("transformed"))
        run_stage(spark, cfg, "clean")
    held = keys_in_state(spark, cfg.checkpoint("clean"))
    found = {(r.symbol, r.timestamp) for r in held.collect()}
    assert found == {("A", START + 4 * MINUTE + 30_000), ("B", START + MINUTE)}
    until = held.where("symbol = 'B'").selectExpr("unix_millis(until)").first()[0]
    assert utc(until) == utc(START + 3 * MINUTE)
    earlier = keys_in_state(spark, cfg.checkpoint("clean"), batch=0)
    assert {(r.symbol, r.timestamp) for r in earlier.collect()} == {("A", START), ("B", START + MINUTE)}


def test_keys_of_an_unbounded_state(spark, tmp_path):
    cfg = PipelineConfig(str(tmp_path), state_partitions=2, state_provider="memory")
    silver_rows(spark, [("A", START, 1.0, 1.0), ("A", START, 2.0, 1.0), ("A", None, 1.0, 1.0)]).write.parquet(
        cfg.target("transformed")
    )
    run_stage(spark, cfg, "clean")
    found = keys_in_state(spark, cfg.checkpoint("clean")).collect()
    assert sorted((r.symbol, r.timestamp or 0, r.until) for r in found) == [("A", 0, None), ("A", START, None)]
