"""Resampling documents towards a target distribution by importance weights of hashed n-grams."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.shared import ALNUM, LOWER, require, written

#: Lower case for A-Z, a space for every byte that is in no word.
_FOLDED = np.where(ALNUM[LOWER], LOWER, 0x20).astype(np.uint8).tobytes()
#: Buckets whose counts and gains the driver and every worker may hold.
MAX_BUCKETS = 1 << 20
_PLACES = (1 << 33) - 1  # a row's place in its partition, in a monotonic id
_RESULTS = ("n_words", "n_features", "weight", "score", "rank")


def ngrams(text: bytes, longest: int) -> Iterator[Iterator[bytes]]:
    """For each size up to ``longest`` the runs of so many neighbouring words, in order.

    Everything between words becomes one space. An overlapped scan then finds every run by
    itself: a match begins and ends at a word's boundary, and the next may begin inside it.
    """
    folded = b" ".join(text.translate(_FOLDED).split())
    for size in range(1, longest + 1):
        pattern = rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (size - 1)
        yield (m[0] for m in regex.finditer(pattern, folded, overlapped=True))


def hashed(text: bytes, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words of a text, and the buckets of all its n-grams."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    parts = [
        (np.fromiter(map(zlib.crc32, grams), dtype=np.uint32) % buckets).astype(kind)
        for grams in ngrams(text, longest)
    ]
    return len(parts[0]), np.concatenate(parts)


def _scan(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, packed = [], []
            for value in batch.column("text"):
                count, found = hashed(value.as_buffer().to_pybytes() if value.is_valid else b"", longest, buckets)
                words.append(count)
                packed.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("name"), pa.array(words, pa.int64()), pa.array(packed, pa.binary())],
                ["row", "name", "n_words", "buckets"],
            )

    return run


def _held(value: pa.Scalar, buckets: int) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint16 if buckets <= 1 << 16 else np.uint32)


def _count(buckets: int):
    """How often each bucket occurs in a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(_held(value, buckets), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    return run


def scanned(
    frame: DataFrame, identity: str, text: str, longest: int, buckets: int, keep: Sequence[str] = ()
) -> DataFrame:
    """Each row's kept columns (``row``), id as text (``name``), words and packed buckets, written once."""
    key = F.col(f"`{identity}`")
    packed = frame.select(
        F.struct(*[F.col(f"`{c}`") for c in keep] or [F.lit(0).alias("none")]).alias("row"),
        F.coalesce(key.cast("string"), F.lit("")).alias("name"),
        F.col(f"`{text}`").alias("text"),
    )
    schema = packed.select("row", "name").schema.add("n_words", "long").add("buckets", "binary")
    return written(packed.mapInArrow(_scan(longest, buckets), schema), "features")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Occurrences of every bucket over all rows: summed by task, then by bucket."""
    counted = features.select("buckets").mapInArrow(_count(buckets), "bucket long, n long")
    summed = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # a row a bucket at most
    total = np.zeros(buckets, dtype=np.int64)
    total[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What an occurrence of each bucket says for the target, in thousandths, with add-one counts."""
    size = len(corpus)
    whole, wanted = float(int(corpus.sum()) + size), float(int(target.sum()) + size)
    found = zip(corpus.tolist(), target.tolist(), strict=True)
    values = [math.floor(1000 * math.log((t + 1) * whole / ((s + 1) * wanted))) for s, t in found]
    return np.array(values, dtype=np.int64)


def _weights(packed: Column, gains_of: object) -> Column:
    @F.arrow_udf("long")
    def run(column: pa.Array) -> pa.Array:
        gain = gains_of.value
        return pa.array([int(gain[_held(v, len(gain))].sum()) for v in column], pa.int64())

    return run(packed)


def _noise(name: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a seeded hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name).cast("binary"), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def ranked(rows: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """The rows with their ``rank`` in an order, from 1; null beyond ``limit``.

    Rows are dealt by ranges of the order, sorted in their partition and written with their
    place there; the partitions' sizes, a row each, give where every partition begins. Rows that
    tie in the whole order are dealt by their place in the table, so no value needs one task.
    """
    spark = rows.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = [*order, F.col("_tie")]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(count, *whole)
    placed = dealt.sortWithinPartitions(*whole).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACES)).alias("_place"),
    )
    placed = written(placed.drop("_tie"), "placed")
    sizes = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    starts, at = [], 1
    for part, size in sizes:
        starts.append((part, at))
        at += size
    firsts = spark.createDataFrame(starts, "_part int, _first long")
    rank = F.col("_first") + F.col("_place")
    found = placed.join(F.broadcast(firsts), "_part").withColumn("rank", F.when(rank <= limit, rank))
    return found.drop("_part", "_place", "_first")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    identity: str = "doc_id",
    target_identity: str = "item_id",
    text: str = "text",
    longest: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Features are all runs of 1 to ``longest`` neighbouring words of a whole text, repeats
    counted, hashed into ``buckets`` by CRC-32. A bucket's gain compares its share in ``target``
    with that in ``docs``; a row's weight adds up the gains of its features, and its score adds
    Gumbel noise by the seed and the id, so that the highest scores are a draw without
    replacement. Of the N rows of ``least_words`` words or more, the best ``percent`` of 100 are
    ranked, ties by the smaller id; every other rank is null.

    ``keep`` names the columns of ``docs`` to keep, by default all but those named as results.
    A null text has no words and weighs 0. A null id is hashed as an empty text and ranks before
    others at ties. Repeated rows are scored and ranked each. Empty tables give an empty result, or gains
    over an empty target.
    """
    require(docs, identity, text)
    require(target, target_identity, text)
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"from 1 to {MAX_BUCKETS} buckets")
    if keep is None:
        keep = [c for c in docs.columns if c.lower() not in _RESULTS]
    features = scanned(docs, identity, text, longest, buckets, [identity, *(c for c in keep if c != identity)])
    wanted = scanned(target, target_identity, text, longest, buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # buckets numbers
    width = 2 if buckets <= 1 << 16 else 4
    weighed = features.select(
        "row", "name", "n_words",
        (F.octet_length("buckets") / width).cast("long").alias("n_features"),
        _weights(F.col("buckets"), sent).alias("weight"),
    )
    scored = weighed.withColumn("score", F.col("weight") + _noise(F.col("name"), seed)).drop("name")
    scored = written(scored, "scored")
    enough = scored.where(F.col("n_words") >= least_words)
    drawn = percent * enough.count() // 100
    order = [F.desc("score"), F.asc(F.col("row").getField(identity))]
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    both = ranked(enough, order, drawn).unionByName(rest)
    shown = [F.col("row").getField(c).alias(c) for c in keep]
    return both.select(*shown, *_RESULTS)


def draw(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows, whole, with docs' columns; see ``resampled``."""
    packed = resampled(
        docs.select(F.struct("*").alias("_whole"), *[F.col(f"`{settings.get(n, d)}`") for n, d in
                    (("identity", "doc_id"), ("text", "text"))]),
        target, **settings, keep=["_whole"],
    )
    return packed.where("rank is not null").select("_whole.*")
