import random

import pytest
from pyspark.sql import functions as F

from ticksmith.llm.flow_mix import mix, quotas, repeated, route
from ticksmith.llm.queries import QUERIES

from . import brute
from .conftest import SF


def test_query_meets_targets(spark, documents):
    rows = QUERIES["op1_flow_mix"](spark, SF).collect()
    docs = {r.doc_id: r for r in documents.collect()}
    size = {i: len(brute.SPACED.findall(r.text or "")) for i, r in docs.items()}
    assert {r.doc_id: r["size"] for r in rows} == size
    by_source: dict = {}
    for i, r in docs.items():
        by_source[r.source] = by_source.get(r.source, 0) + size[i]
    names = sorted(by_source)
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target = quotas(by_source, weights, 1.5 * sum(size.values()), 2)
    for s in names:
        own = [r for r in rows if docs[r.doc_id].source == s]
        assert {r.source_size for r in own} == {by_source[s]}
        assert all(r.target == pytest.approx(target[s]) for r in own)
        words = [size[r.doc_id] for r in own]
        rounds, reach = int(target[s] // sum(words)), {0}
        for w in words:
            reach |= {r + w for r in reach}
        nearest = min(abs(rounds * sum(words) + r - target[s]) for r in reach)
        assert abs(sum(r.taken for r in own) - target[s]) <= nearest + 1
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    assert sorted(rows) == sorted(QUERIES["op1_flow_mix"](spark, SF).collect())


def test_quotas_stop_and_reshare():
    assert quotas({"a": 10, "b": 100, "c": 100}, {"a": 8, "b": 1, "c": 1}, 150, 2) == {
        "a": 20.0, "b": 65.0, "c": 65.0,
    }


def test_flow_is_largest_and_cheapest():
    draw = random.Random(3)
    for _ in range(60):
        sources = list("abc")
        members = [draw.sample(sources, draw.randint(1, 3)) for _ in range(4)]
        capacity = [float(draw.randint(0, 4)) for _ in members]
        quota = {s: float(draw.randint(0, 6)) for s in sources}
        flow = route(capacity, members, quota, 2)
        used = [sum(f.values()) for f in flow]
        assert all(-1e-9 <= u <= 2 * c + 1e-9 for u, c in zip(used, capacity, strict=True))
        got = {s: sum(f.get(s, 0) for f in flow) for s in sources}
        assert all(got[s] <= quota[s] + 1e-9 for s in sources)
        for rounds, total in ((2, sum(used)), (1, sum(min(u, c) for u, c in zip(used, capacity, strict=True)))):
            assert total == pytest.approx(_largest([rounds * c for c in capacity], members, quota))


def _largest(capacity, members, quota):
    """Largest flow by Hall's condition: the least cut over sets of sources."""
    names = list(quota)
    best = float("inf")
    for mask in range(1 << len(names)):
        cut = {s for k, s in enumerate(names) if mask >> k & 1}
        best = min(best, sum(quota[s] for s in cut) + sum(c for c, m in zip(capacity, members, strict=True) if set(m) - cut))
    return best


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a"] if i % 3 == 0 else ["b"] if i % 3 == 1 else ["b", "a"]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    mixed, plan = mix(docs, F.col("sources"), [5.0, 1.0], share=0.8)
    plan = {r.source: r for r in plan.collect()}
    assert plan["a"].routed == pytest.approx(plan["a"].target)
    assert plan["b"].routed == pytest.approx(plan["b"].target)
    taken = mixed.agg(F.sum("taken")).first()[0]
    assert taken == pytest.approx(plan["a"].target + plan["b"].target, abs=20)


def test_large_group_is_cut_in_passes(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    mixed, _ = mix(docs, F.array(F.lit("s")), [1.0], share=0.37)
    assert abs(mixed.agg(F.sum("taken")).first()[0] - 0.37 * 120_000) <= 3


def test_odd_rows(odd, nothing):
    mixed, plan = mix(odd, F.array("source"), [3.0, 1.0, 2.0])
    assert [r.source for r in plan.collect()] == ["a", "b", "c", None]
    rows = mixed.collect()
    assert len(rows) == odd.count()
    assert all(r.taken == 0 for r in rows if not (r.text or "").strip())
    copies = repeated(mixed)
    assert copies.columns == [c for c in odd.columns if c not in {"size", "taken"}]
    words = F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))
    assert copies.agg(words).first()[0] == sum(r.taken for r in rows)
    mixed, plan = mix(nothing, F.array("source"), [1.0])
    assert mixed.count() == plan.count() == 0
