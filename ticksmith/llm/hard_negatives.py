"""Hard negatives of anchors and positives by exact inner-product search in cover trees."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.llm import cover_tree
from ticksmith.llm.shared import require, written

#: Bytes of points that one tree holds; it is built and searched in one task.
TREE_BYTES = 4 << 20
#: Whole-number components stay within this, so that products of up to 8,192 of them are exact.
_LARGEST = 1 << 20
#: Queries that search a tree together.
_TOGETHER = 256
_FOUND = "query long, positive_score long, vec_id long, score long"


def whole_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id``, ``label`` and ``vec`` of the rows that take part, components floored after
    scaling."""
    parts = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bound = F.lit(float(_LARGEST))
    vec = F.transform("parts", lambda x: F.floor(F.greatest(F.least(x * scale, bound), -bound)).cast("int"))
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                    parts.alias("parts"))
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("parts").isNotNull() & finite)
        .select("vec_id", "label", vec.alias("vec"))
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; what a shorter one lacks is 0."""
    flat, sizes = column.flatten().to_numpy(), column.value_lengths().to_numpy()
    out = np.zeros((len(column), width), dtype=np.int32)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _grown(width: int):
    """A tree for every block; a partition holds whole blocks in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(edges, edges[1:], strict=False):
                if b == a:
                    continue
                if held and blocks[a] != at:
                    yield _packed(at, held)
                    held = []
                at = int(blocks[a])
                part = batch.slice(a, b - a)
                held.append((_matrix(part.column("vec"), width), part.column("vec_id").to_numpy(), part.column("label").to_numpy()))
        if held:
            yield _packed(at, held)

    def _packed(at: int, held: list) -> pa.RecordBatch:
        tree = cover_tree.build(*(np.concatenate(x) for x in zip(*held, strict=True)))
        body = pickle.dumps(tuple(tree), protocol=5)
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([body], pa.binary())], ["block", "tree"])

    return run


def _searched(width: int, same: bool, count: int, limits: Callable[[list[int] | None], list[tuple]]):
    """Each block's tree comes first, then the queries that search it, many at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            bodies = batch.column("tree")
            there = np.flatnonzero(bodies.is_valid().to_numpy(zero_copy_only=False))
            edges = [0, *(there + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                stop = b - 1 if b - 1 in there else b  # a tree's own row ends a stretch of queries
                for at in range(a, stop, _TOGETHER):
                    yield answers(tree, batch.slice(at, min(stop, at + _TOGETHER) - at))
                if stop < b:
                    # Written by this job's own tasks.
                    tree = cover_tree.Tree(*pickle.loads(bodies[stop].as_buffer()))

    def answers(tree: cover_tree.Tree, part: pa.RecordBatch) -> pa.RecordBatch:
        asked = part.column("scores").to_pylist()
        windows = [limits(x) for x in asked]
        most = max(map(len, windows))
        bounds = np.array([w + [(np.inf, -np.inf)] * (most - len(w)) for w in windows])
        query, window, ids, scores = cover_tree.search(
            tree, _matrix(part.column("vec"), width), part.column("label").to_numpy(), same,
            bounds[:, :, 0], bounds[:, :, 1], count,
        )
        names = part.column("query").to_numpy()[query]
        positive = [asked[q][w] if asked[q] else None for q, w in zip(query.tolist(), window.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(positive, pa.int64()), pa.array(ids), pa.array(scores)],
            ["query", "positive_score", "vec_id", "score"],
        )

    return run


def _search(trees: DataFrame, queries: DataFrame, blocks: int, searched: Callable) -> DataFrame:
    """All queries against all blocks: every query goes to every block, no pair of rows is made."""
    here = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.lit(None).cast("binary").alias("tree"), "query", "label", "vec", "scores",
    )
    first = trees.select(
        "block", "tree", F.lit(None).cast("long").alias("query"), F.lit(None).cast("long").alias("label"),
        F.lit(None).cast("array<int>").alias("vec"), F.lit(None).cast("array<bigint>").alias("scores"),
    )
    count = max(blocks, int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # The tree's row sorts before the queries, which name it null.
    both = first.union(here).repartition(count, "block")
    both = both.sortWithinPartitions("block", F.col("query").asc_nulls_first())
    return both.mapInArrow(searched, _FOUND)


def _first(rows: DataFrame, keys: list[str], order: list[Column], count: int) -> DataFrame:
    """The first rows of every key; a hot key is cut before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= count)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores, for the rows of
    ``vec_id``, ``label`` and ``embedding`` where ``anchor`` holds.

    A component x counts as floor(scale * x), a score is an inner product. An anchor's positives
    are its first ``positives`` other rows of its label, by falling score and then vec_id. For
    each, its negatives are the first ``negatives`` rows of another label whose score times 100
    is from ``low`` to ``high`` times the positive's.

    Rows that lack an id, a label, a vector or a finite component take no part. A shorter vector
    counts as if it ended in zeros, and components beyond 2^20 as 2^20. Rows equal in id, label
    and vector are one, and rows of the anchor's own id are not its positives. Of the rows equal in vector and
    label only those of the smallest ids can be returned; the others are left out before any
    search, so a vector that many rows hold costs no more than one. Anchors equal in vector and
    label are searched for once. An empty table gives an empty result; other columns are left out.
    """
    require(rows, "vec_id", "label", "embedding")
    vectors = written(whole_vectors(rows, scale).dropDuplicates(["vec_id", "label", "vec"]), "vectors")
    named = F.xxhash64("label", "vec").alias("query")
    anchors = vectors.where(anchor).select(F.col("vec_id").alias("anchor_id"), "label", "vec", named)
    anchors = written(anchors, "anchors")
    kept = max(positives + 1, negatives)
    points = written(_first(vectors, ["label", "vec"], [F.col("vec_id")], kept).drop("place"), "points")
    count, width = points.agg(F.count("*"), F.max(F.size("vec"))).first()
    width = max(width or 0, 1)
    blocks = max(1, -(-count * width * 8 // TREE_BYTES))
    blocked = points.withColumn("block", F.pmod(F.xxhash64("vec"), F.lit(blocks)).cast("int"))
    blocked = blocked.repartition(blocks, "block").sortWithinPartitions("block")
    trees = written(blocked.mapInArrow(_grown(width), "block int, tree binary"), "trees")

    queries = written(anchors.dropDuplicates(["query"]).select("query", "label", "vec"), "queries")
    asked = queries.withColumn("scores", F.lit(None).cast("array<bigint>"))
    best = positives + 1  # the anchor itself may be among them
    near = _search(trees, asked, blocks, _searched(width, True, best, lambda _: [(-np.inf, np.inf)]))
    order = [F.desc("score"), F.col("vec_id")]
    near = written(_first(near, ["query"], order, best).select("query", "vec_id", "score"), "near")

    def windows(scores: list[int]) -> list[tuple[int, int]]:
        return [(-(-low * s // 100), high * s // 100) for s in scores]

    scores = near.groupBy("query").agg(F.collect_set("score").alias("scores"))  # best at most
    far = _search(trees, queries.join(scores, "query"), blocks, _searched(width, False, negatives, windows))
    far = _first(far, ["query", "positive_score"], order, negatives)
    far = far.select(
        "query", "positive_score", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"),
        F.col("place").alias("rank"),
    )

    pairs = anchors.select("anchor_id", "query").join(near, "query").where("vec_id <> anchor_id")
    pairs = _first(pairs, ["anchor_id", "query"], order, positives).select(
        "anchor_id", "query", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return pairs.join(far, ["query", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
