import pytest
from pyspark.sql import functions as F

from ticksmith.llm import scaled_sketch as sk
from ticksmith.llm.queries import QUERIES

from . import brute
from .conftest import SF


def _edits(rows):
    """id, n_chars and edited text; rows in order of id."""
    out = []
    for i, (name, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        out.append((name, len(text), text[: len(text) - half] + after[:half]))
    return out


def _containment(a, b):
    least = min(len(a), len(b))
    return len(a & b) / least if least else float(a == b)


def _hashes(text):
    return {text[i : i + 16] for i in range(0, len(text), 16)}


def test_query_against_brute_force(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op5_scaled_sketch"](spark, SF).collect()}
    docs = sorted((r.doc_id, r.text or "") for r in documents.collect())
    prints = {}
    for i, (name, size, edited) in enumerate(_edits(docs)):
        r = rows[name]
        assert (r.n_chars, r.edited_sha256) == (size, brute.sha(edited))
        assert prints.setdefault(docs[i][1], r.fingerprint) == r.fingerprint
        own, after = _hashes(r.fingerprint), _hashes(rows[docs[(i + 1) % len(docs)][0]].fingerprint)
        assert r.near_edited == pytest.approx(_containment(own, _hashes(r.edited_fingerprint)))
        assert r.near_next == pytest.approx(_containment(own, after))
    assert sum(r.near_edited > r.near_next for r in rows.values()) > 0.9 * len(rows)


def test_containment_is_near_the_shingles_own(spark, documents):
    rows = {r.doc_id: r for r in QUERIES["op5_scaled_sketch"](spark, SF).collect()}

    def shingles(text):
        w = brute.SPACED.findall(text)
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    docs = sorted((r.doc_id, r.text or "") for r in documents.collect())
    errors = []
    for (name, _, edited), (_, text) in zip(_edits(docs), docs, strict=True):
        if len(shingles(text)) > 400:
            errors.append(abs(rows[name].near_edited - _containment(shingles(text), shingles(edited))))
    assert sum(errors) / len(errors) < 0.06


def test_union_of_sketches_is_the_sketch_of_both(spark):
    words = [f"w{i}" for i in range(3000)]
    frame = spark.createDataFrame([(" ".join(words[:1500]), " ".join(words[1496:]), " ".join(words))], "a string, b string, c string")
    for name in "abc":
        frame = sk.with_sketch(frame, name, f"s{name}")
    row = frame.select(sk.merged(F.col("sa"), F.col("sb")).alias("m"), "sc").first()
    assert row.m == row.sc
    assert 250 < len(row.m) < 500


def test_many_buckets_follow_on(spark, monkeypatch):
    monkeypatch.setattr(sk, "_BUCKET_BYTES", 50)
    monkeypatch.setattr(sk, "_FAN", 8)
    rows = [(i * i - 50, f"text number {i} of them") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.edited for r in sk.compared(docs).collect()}
    assert found == {name: edited for name, _, edited in _edits(sorted(rows))}


def test_odd_rows(odd, nothing):
    found = sk.compared(odd).collect()
    assert len(found) == odd.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    six = [r for r in found if r.doc_id == 6]
    assert sorted(r.near_next for r in six)[-1] == 1.0
    assert {tuple(r.sketch) for r in found if r.doc_id in (1, 2, 10)} == {()}
    assert sk.compared(nothing).count() == 0


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op5_scaled_sketch"](spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
