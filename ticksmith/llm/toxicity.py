"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index of
all their words."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.shared import (
    ALNUM,
    LOWER,
    pieces,
    require,
    texts,
    word_bounds,
    word_hashes,
    written,
)

#: Terms in more than this share of the examples have a ceiling in every block of so many examples.
_OFTEN = 1 / 16
_BLOCK = 512
#: Texts that are searched for together.
_TOGETHER = 64
#: Groups that examples are ordered by, so that the examples of a block resemble each other.
_GROUPS = 64
#: Terms whose counts of a task are packed together, and tasks whose counts are added together.
_PACKED = 1 << 14
_TASKS = 1024
#: More than single precision can move a cosine.
_SLACK = 1e-4
_EVIDENCE = "array<struct<doc_id: bigint, similarity: double, toxic: int>>"
_SCORED = f"struct<score: double, evidence: {_EVIDENCE}>"


class Model(NamedTuple):
    """An inverted index of labelled examples, whose frequent terms have a ceiling per block."""

    terms: np.ndarray  # sorted term hashes
    idf: np.ndarray
    first: np.ndarray  # of each term's postings
    example: np.ndarray  # of each posting
    weight: np.ndarray  # unit-length TF-IDF
    often: np.ndarray  # of each term, its place among the frequent ones, or -1
    matrix: np.ndarray | None  # weights of frequent terms, a row for each example; not sent
    ceilings: np.ndarray | None  # the highest weights of each block of rows; not sent
    ids: np.ndarray
    label: np.ndarray
    prior: float
    neighbours: int


class Calibration(NamedTuple):
    """Votes, and what share of the examples with such votes is toxic."""

    steps: np.ndarray
    shares: np.ndarray


def _term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every term, a lower-cased word, in a piece."""
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, ALNUM)
    return np.repeat(np.arange(len(offsets) - 1), np.diff(first)), word_hashes(data, starts, ends)


def _known_terms(column: pa.Array, terms: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For each piece: its first row, its rows, and row, term and count of known terms there."""
    data, offsets = texts(column)
    for a, b in pieces(offsets):
        rows, hashes = _term_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        distinct, each = np.unique(hashes, return_inverse=True)
        place = np.searchsorted(terms, distinct)
        place[place == len(terms)] = 0
        known = (terms[place] == distinct if len(terms) else np.zeros(len(distinct), bool))[each]
        place = place[each]
        pairs, counts = np.unique(rows[known] * max(len(terms), 1) + place[known], return_counts=True)
        yield a, b - a, pairs // max(len(terms), 1), pairs % max(len(terms), 1), counts


def _label_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Examples of either label that hold a term, summed for a piece of examples."""
    for batch in batches:
        labels = batch.column("toxic").to_numpy()
        data, offsets = texts(batch.column("text"))
        for a, b in pieces(offsets):
            rows, hashes = _term_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            order = np.lexsort((rows, hashes))
            rows, hashes = rows[order], hashes[order]
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
            rows, hashes = rows[new], hashes[new]
            toxic = labels[a:b][rows] == 1
            distinct, place = np.unique(hashes, return_inverse=True)
            yes = np.bincount(place, toxic, len(distinct)).astype(np.int64)
            no = np.bincount(place, ~toxic, len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct.view(np.int64)), pa.array(yes), pa.array(no)], ["term", "yes", "no"]
            )


def _document_counts(terms_of: object):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = terms_of.value
        total = np.zeros(len(terms) + 1, dtype=np.int64)  # and rows
        for batch in batches:
            for _, size, _, term, _ in _known_terms(batch.column(0), terms):
                total[:-1] += np.bincount(term, minlength=len(terms))
                total[-1] += size
        parts = [total[at : at + _PACKED] for at in range(0, len(total), _PACKED)]
        packed = pa.array([zlib.compress(x.tobytes(), 1) for x in parts], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), packed], ["part", "docs"])

    return run


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in table["docs"].to_pylist())
    return pa.table({"part": table["part"][:1], "docs": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def _document_frequencies(docs: DataFrame, terms_of: object, count: int) -> np.ndarray:
    """Rows of ``docs`` that hold each term, and all rows last.

    Tasks count in packed parts; the parts of some tasks are added together, then those sums, so
    that no group holds a part of every task.
    """
    packed = docs.select("text").mapInArrow(_document_counts(terms_of), "part int, docs binary")
    packed = packed.withColumn("tasks", F.floor(F.spark_partition_id() / _TASKS).cast("int"))
    some = packed.groupBy("part", "tasks").applyInArrow(_summed, "part int, docs binary")
    found = np.zeros(count + 1, dtype=np.int64)
    for r in some.groupBy("part").applyInArrow(_summed, "part int, docs binary").collect():
        own = np.frombuffer(zlib.decompress(r.docs), np.int64)
        found[r.part * _PACKED : r.part * _PACKED + len(own)] = own
    return found


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_examples: int = 16_000,
    max_terms: int = 512,
    least_chi2: float = 24.0,
    neighbours: int = 7,
    seed: int = 41,
    label_weight: float = 4.0,
) -> tuple[object, Calibration]:
    """A broadcast model of the ``labels`` (``doc_id``, ``toxic`` 0 or 1, an id once) of ``docs``
    (``doc_id``, ``text``), and what its votes mean.

    At most ``max_examples`` examples are kept, those whose ids have the smallest seeded hashes;
    of several texts of an id the least. Every word of theirs is indexed, so ``max_examples`` and
    their length bound what comes to the driver and is broadcast. The ``max_terms`` whose presence depends
    most on the label (chi-square, ``least_chi2`` at least, in three examples or more) weigh
    ``label_weight`` times their IDF. Chance alone reaches 24 once in a million terms; lower
    bounds raise terms that say nothing. Document frequencies count every row of ``docs``. Each
    example's vote without itself, taken in tasks, calibrates the votes.
    """
    spark = docs.sparkSession
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    there = named.select("doc_id").join(labels, "doc_id").distinct()
    # Only ids are sorted; at most max_examples of them go to every executor.
    chosen = there.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_examples)
    chosen = named.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.coalesce(F.min("text"), F.lit("")).alias("text")
    )
    chosen = written(chosen, "examples")
    spread = chosen.repartition(max(1, min(64, max_examples // 500)), "doc_id")
    counted = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    yes, no = counted.get(1, 0), counted.get(0, 0)
    seen = spread.mapInArrow(_label_counts, "term long, yes long, no long")
    seen = written(seen.groupBy("term").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")), "terms")
    there = F.col("yes") + F.col("no")
    chi2 = (yes + no) * F.pow(F.col("yes") * F.lit(float(no)) - F.col("no") * F.lit(float(yes)), 2) / (
        F.lit(float(yes or 1) * float(no or 1)) * there * (yes + no - there)
    )
    scored = seen.where((there >= 3) & (there < yes + no)).withColumn("chi2", chi2)
    best = scored.where(F.col("chi2") >= least_chi2).orderBy(F.desc("chi2"), "term").limit(max_terms)
    telling = np.array([r.term for r in best.collect()], dtype=np.int64).view(np.uint64)
    terms = np.sort(_column(seen.select("term"), "term").view(np.uint64))
    terms_of = spark.sparkContext.broadcast(terms)

    found = _document_frequencies(docs, terms_of, len(terms))
    idf = np.log((1 + found[-1]) / (1 + found[:-1])) + 1
    idf[np.searchsorted(terms, telling)] *= label_weight

    vectors = spread.mapInArrow(_vectors(terms_of), "doc_id long, toxic int, term binary, n binary")
    vectors = written(vectors, "vectors")
    rows = []
    for batch in vectors.toArrow().to_batches():  # of max_examples at most
        for i, y, t, n in zip(*batch.columns, strict=True):
            t, n = (np.frombuffer(x.as_buffer(), np.int32) for x in (t, n))
            rows.append(_Example(i.as_py(), y.as_py(), t, n))
    rows.sort(key=lambda r: r.doc_id)
    model_of = spark.sparkContext.broadcast(_indexed(rows, terms, idf, neighbours))
    truth = {r.doc_id: r.toxic for r in rows}
    del rows
    votes = vectors.mapInArrow(_left_out(model_of), "doc_id long, vote double").toArrow()
    label = np.array([truth[i] for i in votes["doc_id"].to_pylist()], dtype=np.int64)
    prior = (label.sum() + 0.1) / (len(label) + 1)
    return model_of, _rising(votes["vote"].to_numpy(), label, prior)


class _Example(NamedTuple):
    doc_id: int
    toxic: int
    term: np.ndarray
    n: np.ndarray


def _column(frame: DataFrame, name: str) -> np.ndarray:
    return frame.toArrow()[name].to_numpy()


def _vectors(terms_of: object):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, count = [], []
            for _, size, row, term, n in _known_terms(batch.column("text"), terms_of.value):
                edges = np.searchsorted(row, np.arange(size + 1))
                place += [term[a:b].astype(np.int32).tobytes() for a, b in zip(edges, edges[1:], strict=False)]
                count += [n[a:b].astype(np.int32).tobytes() for a, b in zip(edges, edges[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(place, pa.binary()),
                 pa.array(count, pa.binary())], ["doc_id", "toxic", "term", "n"],
            )

    return run


def _unit(term: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weight = (1 + np.log(count)) * idf[term]
    length = np.sqrt((weight * weight).sum())
    return weight / length if length else weight


def _indexed(rows: list, terms: np.ndarray, idf: np.ndarray, neighbours: int) -> Model:
    """Postings by term, with examples in the order of their groups, so that a block's ceilings
    are close to its weights."""
    label = np.array([r.toxic for r in rows], dtype=np.int64)
    ids = np.array([r.doc_id if r.doc_id is not None else -1 for r in rows], dtype=np.int64)
    sizes = [len(r.term) for r in rows]
    term = np.concatenate([np.asarray(r.term, np.int32) for r in rows] or [np.zeros(0, np.int32)])
    weights = [_unit(np.asarray(r.term), np.asarray(r.n, np.float64), idf).astype(np.float32) for r in rows]
    weight = np.concatenate(weights or [np.zeros(0, np.float32)])
    docs = np.bincount(term, minlength=len(terms))
    frequent = docs > len(rows) * _OFTEN
    often = np.where(frequent, np.cumsum(frequent) - 1, -1).astype(np.int32)
    example = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    own = often[term] >= 0
    matrix = np.zeros((len(rows), int(frequent.sum())), dtype=np.float32)
    matrix[example[own], often[term[own]]] = weight[own]
    order = _grouped(matrix)
    del matrix
    place = np.empty(len(rows), dtype=np.int32)
    place[order] = np.arange(len(rows), dtype=np.int32)
    by = np.lexsort((place[example], term))
    example = place[example[by]].astype(np.uint16 if len(rows) <= 1 << 16 else np.int32)
    prior = (label.sum() + 0.1) / (len(label) + 1)
    first = np.append(0, np.cumsum(docs))
    return Model(terms, idf, first, example, weight[by], often, None, None, ids[order], label[order], prior, neighbours)


def _grouped(matrix: np.ndarray, rounds: int = 3) -> np.ndarray:
    """Rows in an order that keeps those with the same frequent terms together: groups around
    moving centres, neighbouring groups alike."""
    if not matrix.size:
        return np.arange(len(matrix))
    centres = matrix[np.linspace(0, len(matrix) - 1, min(_GROUPS, len(matrix))).astype(np.int64)].copy()
    for _ in range(rounds):
        group = (matrix @ centres.T).argmax(axis=1)
        for g in range(len(centres)):
            total = matrix[group == g].sum(axis=0)
            length = float(np.sqrt((total * total).sum()))
            if length:
                centres[g] = total / length
    alike, path, left = centres @ centres.T, [0], set(range(1, len(centres)))
    while left:
        path.append(max(sorted(left), key=lambda g: alike[path[-1], g]))
        left.remove(path[-1])
    near = matrix @ centres.T
    return np.lexsort((-near.max(axis=1), np.argsort(path)[near.argmax(axis=1)]))


def _ready(model: Model) -> Model:
    """The model with its matrix and the ceilings of every block of rows."""
    often = np.repeat(model.often, np.diff(model.first))
    own = often >= 0
    matrix = np.zeros((len(model.label), int(model.often.max(initial=-1)) + 1), dtype=np.float32)
    matrix[model.example[own], often[own]] = model.weight[own]
    starts = np.arange(0, len(matrix), _BLOCK)
    ceilings = np.maximum.reduceat(matrix, starts, axis=0) if matrix.size else np.zeros((len(starts), matrix.shape[1]))
    return model._replace(matrix=matrix, ceilings=ceilings.astype(np.float32))


def nearest(
    model: Model, vectors: list[tuple[np.ndarray, np.ndarray]], without: list[int] | None = None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of some unit vectors (terms and weights) the examples of largest cosine, and the
    cosines; exact, ties by place.

    Postings of rarer terms are added up. With the ceilings of the frequent terms they bound
    every block of examples. Each vector takes the block of the highest bound first; then the
    blocks that can hold an example as near as the last of its nearest so far, and no others.
    """
    count, texts_ = len(model.label), len(vectors)
    if not count:
        return [(np.zeros(0, np.int64), np.zeros(0))] * texts_
    text = np.repeat(np.arange(texts_), [len(t) for t, _ in vectors])
    term = np.concatenate([t for t, _ in vectors])
    weight = np.concatenate([w for _, w in vectors])
    place = model.often[term]
    rare = place < 0
    firsts, sizes = model.first[term[rare]], model.first[term[rare] + 1] - model.first[term[rare]]
    at = np.arange(int(sizes.sum())) + np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes)
    by = model.weight[at] * np.repeat(weight[rare], sizes)
    sums = np.bincount(model.example[at] + np.repeat(text[rare] * count, sizes), by, texts_ * count)
    sums = sums.astype(np.float64, copy=False).reshape(texts_, count)
    if without is not None:
        sums[np.arange(texts_), without] = -np.inf
    queries = np.zeros((texts_, model.matrix.shape[1]), dtype=np.float32)
    queries[text[~rare], place[~rare]] = weight[~rare]
    starts = np.arange(0, count, _BLOCK)
    bounds = np.maximum.reduceat(sums, starts, axis=1) + queries @ model.ceilings.T

    about = np.full((texts_, count), -np.inf)

    def take(wanted: np.ndarray) -> None:
        for block in np.flatnonzero(wanted.any(axis=0)):
            own, rows = np.flatnonzero(wanted[:, block]), slice(starts[block], starts[block] + _BLOCK)
            about[own, rows] = sums[own, rows] + queries[own] @ model.matrix[rows].T

    first = np.zeros(bounds.shape, dtype=bool)
    first[np.arange(texts_), bounds.argmax(axis=1)] = True
    take(first)
    last = min(model.neighbours, count)
    best = starts[bounds.argmax(axis=1)]
    spans = [about[i, a : a + _BLOCK] for i, a in enumerate(best)]
    least = np.array([np.partition(x, -last)[-last] if len(x) >= last else 0.0 for x in spans])
    least = np.maximum(least, 0.0) - _SLACK
    take((bounds >= least[:, None]) & ~first)

    found = []
    for i, (t, w) in enumerate(vectors):
        rows = np.flatnonzero(about[i] >= least[i])
        rough = about[i, rows]
        if len(rows) > last:
            rows = rows[rough >= np.partition(rough, -last)[-last] - _SLACK]
        # Whatever single precision can have moved is summed again, row by row, so that equal
        # examples have equal cosines.
        common = model.often[t] >= 0
        cosine = sums[i, rows] + (model.matrix[np.ix_(rows, model.often[t][common])] * w[common]).sum(axis=1)
        rows, cosine = rows[cosine > 0], cosine[cosine > 0]
        top = np.lexsort((rows, -np.round(cosine, 12)))[: model.neighbours]
        found.append((rows[top], cosine[top]))
    return found


def _left_out(model_of: object):
    """The vote of every example without itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _ready(model_of.value)
        place = {i: p for p, i in enumerate(model.ids.tolist())}
        for batch in batches:
            own, vectors, votes = [place[i] for i in batch.column("doc_id").to_pylist()], [], []
            for t, n in zip(batch.column("term"), batch.column("n"), strict=True):
                term, count = (np.frombuffer(x.as_buffer(), np.int32) for x in (t, n))
                vectors.append((term, _unit(term, count.astype(np.float64), model.idf)))
            for at in range(0, len(vectors), _TOGETHER):
                found = nearest(model, vectors[at : at + _TOGETHER], own[at : at + _TOGETHER])
                votes += [vote(model, *x) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(votes, pa.float64())], ["doc_id", "vote"])

    return run


def vote(model: Model, best: np.ndarray, cosine: np.ndarray) -> float:
    """Labels weighted by cosine, with the share of toxic examples as one vote more."""
    return float(((model.label[best] * cosine).sum() + model.prior) / (cosine.sum() + 1))


def _rising(votes: np.ndarray, label: np.ndarray, prior: float) -> Calibration:
    """Rising shares of toxic examples by vote: neighbours that fall are pooled."""
    at, place = np.unique(np.round(votes, 9), return_inverse=True)
    pools: list[list[float]] = []
    for v, y, n in zip(at, np.bincount(place, label), np.bincount(place), strict=False):
        pools.append([v, y + prior * 0.1, n + 0.1])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            v, y, n = pools.pop()
            pools[-1][1] += y
            pools[-1][2] += n
    return Calibration(np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools]))


def _calibrated(scale: Calibration, value: float) -> float:
    """The share learned for such a vote; a fiftieth of the vote itself keeps the order within
    a pool."""
    if not len(scale.steps):
        return value
    place = max(int(np.searchsorted(scale.steps, value + 1e-9, "right")) - 1, 0)
    return 0.98 * float(scale.shares[place]) + 0.02 * value


def score(docs_text: Column, model_of: object, scale: Calibration) -> Column:
    """``score`` (0 to 1) and ``evidence``: the nearest examples, for every text.

    A text that shares no term with any example has no neighbours and no evidence.
    """

    ready: list = []  # the model with its matrix, once a task

    @F.arrow_udf(_SCORED)
    def run(column: pa.Array) -> pa.Array:
        if not ready:
            ready.append(_ready(model_of.value))
        model: Model = ready[0]
        held: dict = {}
        scores, evidence = np.zeros(len(column)), [[]] * len(column)
        for first, size, row, term, count in _known_terms(column, model.terms):
            edges = np.searchsorted(row, np.arange(size + 1))
            keys, fresh = [], {}
            for i in range(size):
                t, n = term[edges[i] : edges[i + 1]], count[edges[i] : edges[i + 1]]
                keys.append(xxhash.xxh3_128_digest(t.tobytes() + n.tobytes()))
                if keys[i] not in held:
                    fresh[keys[i]] = t, _unit(t, n, model.idf)
            names, vectors = list(fresh), list(fresh.values())
            for at in range(0, len(names), _TOGETHER):
                found = nearest(model, vectors[at : at + _TOGETHER])
                for key, (best, cosine) in zip(names[at:], found, strict=False):
                    shown = [
                        {"doc_id": int(model.ids[b]), "similarity": float(c), "toxic": int(model.label[b])}
                        for b, c in zip(best[:5], cosine[:5], strict=True)
                    ]
                    held[key] = (_calibrated(scale, vote(model, best, cosine)), shown)
            for i, key in enumerate(keys):
                scores[first + i], evidence[first + i] = held[key]
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
        return pa.StructArray.from_arrays(
            [pa.array(scores), pa.array(evidence, kind)], ["score", "evidence"]
        )

    return run(docs_text)


def held_out(identity: Column) -> Column:
    """Whether labels of the row are kept from learning: crc32 of the id's text, modulo 5, is 0."""
    return F.coalesce(F.crc32(identity.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Every row of ``docs`` with ``held_out``, ``score``, ``predicted`` and ``evidence``.

    Labels come from ``labels`` (``doc_id``, ``toxic``), from rows that are not held out; of
    several labels of an id the highest holds, null and other values are none. Texts alone
    decide a score. Null and empty texts have no terms; without any label every score is the
    same. Repeated rows are scored each. Columns named as the results are replaced.
    """
    require(docs, "doc_id", "text")
    require(labels, "doc_id", "toxic")
    taught = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    taught = taught.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    body = docs.select(F.col("doc_id"), F.col("text"))
    model_of, scale = fit(body, taught, **settings)
    rest = [c for c in docs.columns if c.lower() not in {"held_out", "score", "predicted", "evidence"}]
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"),
        held_out(F.col("doc_id")).alias("held_out"),
        score(F.col("text"), model_of, scale).alias("s"),
    )
    return packed.select(
        "row.*", "held_out", F.col("s.score").alias("score"),
        F.when(F.col("s.score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.col("s.evidence").alias("evidence"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows that are not predicted toxic, whole, with docs' columns."""
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id"), F.col("text"))
    kept = scored(packed, labels, **settings).where("predicted = 0")
    return kept.select("row.*")
