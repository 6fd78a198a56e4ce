import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ticksmith.llm import toxicity
from ticksmith.llm.queries import QUERIES

from . import brute


def _examples(spark, count=400):
    rows = []
    for i in range(count):
        bad = i % 4 == 0
        words = [f"w{(i * 7 + j) % 50}" for j in range(20)] + (["gruesome", "vile"] if bad else [])
        rows.append((i, " ".join(words), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_held_out_rows_of_the_tables(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op6_toxicity"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(r.held_out == (brute.crc_mod5(r.doc_id) == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    own = [r for r in rows if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in own) / len(own)
    majority = 1 - sum(truth[r.doc_id] for r in own) / len(own)
    assert right > majority
    taught = {r.doc_id for r in rows if not r.held_out}
    assert all(e.doc_id in taught for r in rows for e in r.evidence)


def test_learns_and_ignores_held_out_labels(spark):
    frame = _examples(spark)
    labels = frame.select("doc_id", "toxic")
    found = toxicity.scored(frame.select("doc_id", "text"), labels, least_chi2=5.0).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(r.predicted == truth[r.doc_id] for r in found)
    lying = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    again = toxicity.scored(frame.select("doc_id", "text"), lying, least_chi2=5.0).collect()
    assert sorted((r.doc_id, r.score) for r in again) == sorted((r.doc_id, r.score) for r in found)


def test_odd_rows(spark, odd, nothing):
    labels = _examples(spark, 80).select((F.col("doc_id") + 100).alias("doc_id"), "toxic")
    labels = labels.union(spark.createDataFrame([(4, None), (None, 1), (8, 1), (8, 0)], "doc_id long, toxic int"))
    found = toxicity.scored(odd, labels).collect()
    assert len(found) == odd.count()
    assert all(0 <= r.score <= 1 for r in found)
    assert toxicity.keep_clean(odd, labels).columns == odd.columns
    none = labels.where("1 = 0")
    assert toxicity.keep_clean(odd, none).count() == odd.count()
    assert toxicity.scored(nothing, labels).count() == 0


def test_texts_without_label_terms_have_their_neighbours(spark):
    frame = _examples(spark)
    rare = [(1000 + i, f"quiet{i} river{i} stones{i} under{i} w1") for i in range(6)]
    added = spark.createDataFrame(rare, "doc_id long, text string")
    labels = frame.select("doc_id", "toxic").union(added.select("doc_id", F.lit(1).alias("toxic")))
    turned = [(4000 + i, " ".join(reversed(t.split()))) for i, t in rare]
    docs = frame.select("doc_id", "text").union(added).union(spark.createDataFrame(turned, "doc_id long, text string"))
    found = {r.doc_id: r for r in toxicity.scored(docs, labels, least_chi2=5.0).collect()}
    taught = [i for i, _ in rare if not found[i].held_out]
    assert len(taught) > 2
    for i in taught:
        nearest = found[4000 + i].evidence[0]
        assert (nearest.doc_id, nearest.toxic) == (i, 1)
        assert abs(nearest.similarity - 1) < 1e-5
    assert all(r.evidence for r in found.values() if r.doc_id < 1000)


def _drawn(count=700, terms=400, seed=5):
    draw, rows = np.random.default_rng(seed), []
    for i in range(count):
        term = np.unique(np.minimum(draw.zipf(1.4, 30), terms) - 1)
        rows.append(toxicity._Example(i, int(draw.random() < 0.3), term, draw.integers(1, 4, len(term))))
    return draw, rows, 1 + draw.random(terms)


def test_nearest_is_exact_with_rare_and_frequent_terms(monkeypatch):
    draw, rows, idf = _drawn()
    monkeypatch.setattr(toxicity, "_BLOCK", 64)
    model = toxicity._ready(toxicity._indexed(rows, np.arange(400, dtype=np.uint64), idf, 7))
    assert 0 < model.matrix.shape[1] < 400
    dense = np.zeros((700, 400))
    for i, name in enumerate(model.ids):
        dense[i, rows[name].term] = toxicity._unit(rows[name].term, rows[name].n, idf)
    for i in range(200):
        term = np.unique(np.minimum(draw.zipf(1.4, 20), 400) - 1)
        weight = toxicity._unit(term, draw.integers(1, 4, len(term)).astype(float), idf)
        cosine = dense[:, term] @ weight
        cosine[i] = 0
        ((best, found),) = toxicity.nearest(model, [(term, weight)], [i])
        assert np.allclose(found, np.sort(cosine[cosine > 0])[::-1][:7], atol=1e-6)
        assert np.allclose(cosine[best], found, atol=1e-6)


def test_ceilings_leave_out_most_examples(monkeypatch):
    monkeypatch.setattr(toxicity, "_BLOCK", 64)
    draw, rows, idf = _drawn(3200, 400, 6)
    # Four kinds of examples with frequent terms of their own.
    rows = [r._replace(term=(r.term + 400 * (i % 4))) for i, r in enumerate(rows)]
    idf = np.tile(idf, 4)
    model = toxicity._ready(toxicity._indexed(rows, np.arange(1600, dtype=np.uint64), idf, 7))
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, rows):
            if isinstance(rows, slice):
                read.append(len(range(*rows.indices(len(self)))))
            return np.asarray(super().__getitem__(rows))

    counted = model._replace(matrix=model.matrix.view(Counted))
    for r in rows[:50]:
        toxicity.nearest(counted, [(r.term, toxicity._unit(r.term, r.n, idf))])
    assert sum(read) < 50 * 3200 / 2


def _whole_score(docs, labels, neighbours=7, max_terms=512, least=5.0, factor=4.0):
    """Scores of (id, text) rows by plain loops, for ids and labels that occur once."""

    def words(text):
        return Counter(brute.ALNUM.findall((text or "").translate(brute.UPPER)))

    counts = {i: words(t) for i, t in docs}
    taught = [i for i in counts if i in labels and brute.crc_mod5(i)]
    df = Counter(w for c in counts.values() for w in c)
    yes, no = sum(labels[i] for i in taught), sum(1 - labels[i] for i in taught)
    chi = {}
    for w in {w for i in taught for w in counts[i]}:
        a = sum(labels[i] for i in taught if w in counts[i])
        b = sum(1 - labels[i] for i in taught if w in counts[i])
        if 3 <= a + b < yes + no:
            chi[w] = (yes + no) * (a * no - b * yes) ** 2 / (yes * no * (a + b) * (yes + no - a - b))
    telling = sorted((w for w in chi if chi[w] >= least), key=lambda w: -chi[w])[:max_terms]
    known = {w for i in taught for w in counts[i]}

    def vector(c):
        v = {w: (1 + math.log(n)) * (math.log((1 + len(docs)) / (1 + df[w])) + 1) * (factor if w in telling else 1)
             for w, n in c.items() if w in known}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    vectors = {i: vector(c) for i, c in counts.items()}
    prior = (yes + 0.1) / (yes + no + 1)

    def vote(i, others):
        near = sorted((sum(x * vectors[j].get(w, 0) for w, x in vectors[i].items()) for j in others), reverse=True)
        least = near[neighbours - 1] if len(near) >= neighbours else 0
        pairs = [(sum(x * vectors[j].get(w, 0) for w, x in vectors[i].items()), labels[j]) for j in others]
        pairs = [p for p in pairs if p[0] > 0 and p[0] >= least - 1e-12]
        assert len(pairs) <= neighbours, "the fixture must have no ties"
        return (sum(c * y for c, y in pairs) + prior) / (sum(c for c, _ in pairs) + 1)

    left = sorted((round(vote(i, [j for j in taught if j != i]), 9), labels[i]) for i in taught)
    pools = []
    for v, y in left:
        if pools and pools[-1][0] == v:
            pools[-1][1] += y
            pools[-1][2] += 1
        else:
            pools.append([v, y + prior * 0.1, 1.1])
    merged = []
    for pool in pools:
        merged.append(pool)
        while len(merged) > 1 and merged[-2][1] / merged[-2][2] >= merged[-1][1] / merged[-1][2]:
            _, y, n = merged.pop()
            merged[-1][1] += y
            merged[-1][2] += n

    def calibrated(v):
        share = [y / n for at, y, n in merged if at <= v + 1e-9] or [merged[0][1] / merged[0][2]]
        return 0.98 * share[-1] + 0.02 * v

    return {i: calibrated(vote(i, taught)) for i in counts}


def test_whole_score_equals_plain_loops(spark):
    draw = np.random.default_rng(8)
    rows = []
    for i in range(220):
        bad = i % 4 == 0
        drawn = [f"w{int(k)}" for k in np.minimum(draw.zipf(1.3, int(draw.integers(5, 60))), 800)]
        rows.append((i, " ".join(drawn + (["gruesome"] * int(draw.integers(1, 3)) if bad else [])), int(bad)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = frame.where("doc_id % 11 <> 0").select("doc_id", "toxic")
    found = toxicity.scored(frame.select("doc_id", "text"), labels, least_chi2=5.0).collect()
    wanted = _whole_score([(i, t) for i, t, _ in rows], {i: y for i, _, y in rows if i % 11}, least=5.0)
    assert len(found) == len(rows)
    for r in found:
        assert abs(r.score - wanted[r.doc_id]) < 1e-5
