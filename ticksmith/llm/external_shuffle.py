"""Sharding by a two-pass external shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticksmith.llm.shared import require, written

_SLICES = 1 << 16
_RESULTS = {"shard", "slot", "grown_shard"}


def shard_of(identity: Column, shards: int, seed: int) -> Column:
    """The shard whose seeded hash of the id is largest, so that one more shard takes rows
    only into itself. The id's null is an id like any other."""
    weights = [
        F.struct(F.xxhash64(F.lit(seed), F.lit(s), identity).alias("w"), F.lit(s).alias("s"))
        for s in range(shards)
    ]
    return (F.greatest(*weights) if shards > 1 else weights[0]).getField("s")


def shuffle_into_shards(
    docs: DataFrame,
    shards: int,
    identity: str = "doc_id",
    text: str = "text",
    seed: int = 17,
    bucket_bytes: int = 32 << 20,
) -> DataFrame:
    """Every row with its ``shard``, its ``slot`` there and ``grown_shard``, in slot order.

    Pass one scatters whole rows by seeded hashes into buckets of about ``bucket_bytes``, each
    a random part of one shard. Pass two holds one bucket in memory, shuffles it by
    Fisher-Yates with the bucket's own seed, and hands it on. Slots count from 0 without gaps
    within a shard. The law is by key: id and shard count decide the shard. A shard has as many
    buckets as its own bytes need. Rows scatter by id and text; those that repeat both beyond
    ``bucket_bytes`` are dealt to buckets of their own, rows equal in every column one by one, so
    that no group fills a task.

    A null text has no bytes, a null id is an id. Repeated rows each get a slot; which of them
    gets which cannot be told. Any column type may be carried. An empty table gives an empty result. Columns named as the
    results are replaced.
    """
    require(docs, identity, text)
    key, body = F.col(f"`{identity}`"), F.col(f"`{text}`")
    kept = [f for f in docs.schema if f.name.lower() not in _RESULTS]
    rest = [F.col(f"`{f.name}`") for f in kept]
    scattered = docs.select(
        F.struct(*rest).alias("row"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 16).cast("long").alias("size"),
        shard_of(key, shards, seed).alias("shard"),
        shard_of(key, shards + 1, seed).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit(seed + 1), key, body), F.lit(_SLICES)).alias("slice"),
        # The total order makes a bucket, and so its shuffle, the same when a task runs again.
        F.xxhash64(F.lit(seed + 2), *[_hashable(f) for f in kept]).alias("order"),
    )
    slices = written(
        scattered.groupBy("shard", "slice").agg(
            F.count("*").alias("rows"), F.sum("size").alias("bytes")
        ),
        "slices",
    )
    large = (F.col("bytes") > bucket_bytes) & (F.col("rows") > 1)
    split = not slices.where(large).isEmpty()
    # One row per shard, of which there are no more than the plan has hashes.
    filled = slices.where(~large).groupBy("shard").agg(F.sum("bytes")).collect()
    parts = _parts(dict(map(tuple, filled)), shards, bucket_bytes)
    bucket = F.pmod(F.col("slice"), F.get(F.array(*map(F.lit, parts)), F.col("shard"))).cast("long")
    buckets = slices.where(~large).select("shard", bucket.alias("bucket"), "rows")
    usual = scattered.withColumn("bucket", bucket)
    count = sum(parts)
    if split:
        # A slice above a bucket's size is dealt out by the hash of whole rows, and rows that are
        # equal in all beyond that size one by one. The deal is written, since a task that ran
        # again could deal those otherwise.
        deals = slices.where(large).select(
            "shard", "slice", F.ceil(F.col("bytes") / F.lit(bucket_bytes)).alias("deals")
        )
        cut = scattered.join(deals, ["shard", "slice"])
        repeated = cut.groupBy("shard", "slice", "order").agg(
            (F.sum("size") > bucket_bytes).alias("repeated")
        )
        cut = cut.join(repeated.where("repeated"), ["shard", "slice", "order"], "left")
        one_by_one = F.when(F.col("repeated"), F.monotonically_increasing_id()).otherwise(F.lit(0))
        dealt = F.pmod(F.xxhash64(F.lit(seed + 3), "order", one_by_one), F.col("deals"))
        apart = (F.col("slice") + 1) * F.lit(1 << 32) + dealt
        spread = cut.withColumn("bucket", apart.cast("long")).drop("deals", "repeated")
        spread = written(spread, "dealt")
        sums = spread.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
        buckets = buckets.unionByName(sums)
        count += deals.agg(F.sum("deals")).first()[0]
        usual = usual.join(deals, ["shard", "slice"], "left_anti").unionByName(spread)
    counts = buckets.groupBy("shard", "bucket").agg(F.sum("rows").alias("rows"))
    # A shard's prefix sums are a small sort: a row per bucket.
    before = (
        Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    firsts = counts.select(
        "shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first")
    )
    placed = usual.join(firsts, ["shard", "bucket"]).select(
        "row", "shard", "grown_shard", "bucket", "first", "order"
    )
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucketed = placed.repartition(max(tasks, count), "shard", "bucket")
    bucketed = bucketed.sortWithinPartitions("shard", "bucket", "order")
    schema = placed.select("row", "shard", "grown_shard").schema.add("slot", "long")
    return bucketed.mapInArrow(_shuffled(seed), schema).select(
        "row.*", "shard", "slot", "grown_shard"
    )


def _parts(filled: dict[int, int], shards: int, bucket_bytes: int) -> list[int]:
    """Buckets of every shard: a power of two, so many that they fit their size on average."""
    parts = []
    for shard in range(shards):
        wanted = -(-filled.get(shard, 0) // bucket_bytes)
        parts.append(min(1 << max(wanted - 1, 0).bit_length(), _SLICES))
    return parts


def _hashable(field: T.StructField) -> Column:
    """The column, as JSON if it holds a map, which has no hash."""
    column = F.col(f"`{field.name}`")
    return F.to_json(F.struct(column)) if _holds_map(field.dataType) else column


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(field.dataType) for field in kind)
    return isinstance(kind, T.MapType)


def _shuffled(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column("shard").to_numpy()
            bucket = batch.column("bucket").to_numpy()
            changes = np.flatnonzero((shard[1:] != shard[:-1]) | (bucket[1:] != bucket[:-1])) + 1
            edges = [0, *changes.tolist(), batch.num_rows]
            for first, last in zip(edges, edges[1:], strict=False):
                here = (int(shard[first]), int(bucket[first]))
                if here != at and held:
                    yield from _permuted(held, at, seed)
                    held = []
                at = here
                held.append(batch.slice(first, last - first))
        if held:
            yield from _permuted(held, at, seed)

    return run


def _permuted(
    held: list[pa.RecordBatch], at: tuple, seed: int
) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(held)
    order = np.arange(rows.num_rows)
    # numpy's shuffle is Fisher-Yates.
    np.random.default_rng([seed, *at]).shuffle(order)
    first = rows.column("first")[0].as_py()
    table = rows.select(["row", "shard", "grown_shard"]).take(pa.array(order))
    slots = pa.array(first + np.arange(rows.num_rows), pa.int64())
    yield from table.append_column("slot", slots).to_batches(max_chunksize=5000)


def write_shards(sharded: DataFrame, path: str) -> None:
    """The shards as folders ``shard=N`` of files; a file holds whole buckets in slot order."""
    sharded.write.partitionBy("shard").parquet(path)
