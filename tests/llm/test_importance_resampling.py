import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ticksmith.llm import importance_resampling as ir

from .brute import ALNUM, UPPER


def brute(docs, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    """{id: (n_features, weight, score, rank)} of (id, text) rows with different ids."""

    def features(text):
        words = ALNUM.findall((text or "").translate(UPPER))
        runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    own = [(i, *features(t)) for i, t in docs]
    s = Counter(b for _, _, f in own for b in f)
    t = Counter(b for _, text in target for b in features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))

    out, order = {}, []
    for i, n, f in own:
        weight = sum(map(gain, f))
        name = "" if i is None else str(i)
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = [len(f), weight, score, None]
        if n >= least:
            order.append((-score, i))
    for rank, (_, i) in enumerate(sorted(order)[: percent * len(order) // 100], 1):
        out[i][3] = rank
    return {i: tuple(v) for i, v in out.items()}


def result(frame):
    return {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in frame.collect()}


@pytest.mark.parametrize(("longest", "buckets", "percent"), [(1, 10_000, 10), (3, 997, 60), (2, 100_000, 100)])
def test_equals_brute_force(spark, documents, longest, buckets, percent):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(r.item_id, r.text) for r in target.collect()]
    found = ir.resampled(documents, target, longest=longest, buckets=buckets, percent=percent)
    assert result(found) == brute(rows, items, longest, buckets, percent)


def test_overlapped_scan_finds_every_run():
    text = "A-b  c\x1fÜ9;;d".encode()
    assert [list(g) for g in ir.ngrams(text, 3)] == [
        [b"a", b"b", b"c", "Ü9".encode(), b"d"],
        [b"a b", b"b c", "c Ü9".encode(), "Ü9 d".encode()],
        [b"a b c", "b c Ü9".encode(), "c Ü9 d".encode()],
    ]
    assert [list(g) for g in ir.ngrams(b" ;; ", 2)] == [[], []]


def test_odd_rows(spark, odd, nothing):
    target = spark.createDataFrame([(1, "same words here"), (2, None), (None, "ends")], "item_id long, text string")
    found = ir.resampled(odd, target, least_words=3, percent=100).collect()
    assert len(found) == odd.count()
    assert sorted(r["rank"] for r in found if r.n_words >= 3) == list(range(1, 1 + sum(r.n_words >= 3 for r in found)))
    assert all(r["rank"] is None and r.weight == 0 for r in found if not r.n_words)
    # Its own columns replace those of the same name; the others stay.
    assert {c for c in odd.columns if c != "score"} < set(found[0].asDict())
    assert ir.resampled(nothing, target).count() == 0
    empty = target.where("1 = 0")
    assert ir.resampled(odd, empty).count() == odd.count()
    whole = ir.draw(odd, target, least_words=3, percent=100)
    assert whole.columns == odd.columns
    assert whole.count() == sum(r.n_words >= 3 for r in found)


def test_rows_that_tie_in_everything_get_ranks_of_their_own(spark):
    text = " ".join(f"w{i}" for i in range(30))
    many = spark.range(2000).select(F.lit(7).alias("doc_id"), F.lit(text).alias("text"))
    others = spark.range(1000).select((F.col("id") + 10).cast("int").alias("doc_id"), F.lit("w1 w2 " + text).alias("text"))
    target = spark.createDataFrame([(1, text)], "item_id long, text string")
    found = ir.resampled(many.union(others), target, percent=50).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 1501))
    best = sorted(found, key=lambda r: (-r.score, r.doc_id))[:1500]
    assert sorted(r.doc_id for r in best) == sorted(r.doc_id for r in found if r["rank"])
