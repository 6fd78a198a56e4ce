"""Document fingerprints: every shingle hash below a fixed fraction of all hashes.

Built of DataFrame functions alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.llm.shared import require

_SHINGLE = 5
_BUCKET_BYTES = 8 << 20
_FAN = 256


def with_sketch(frame: DataFrame, text: str, name: str, halvings: int = 3) -> DataFrame:
    """``frame`` with the sketch of a column's text as a sorted array of bigints.

    Words lie between ASCII white space; every five neighbours are a shingle, fewer are one. Of
    the distinct 64-bit shingle hashes those below ``2^-halvings`` of their range stay, so the
    union of two sketches is the sketch of both texts together. Where none is, the least one
    stays for comparison. A text without words has an empty sketch. Each step is a column of its
    own, since an expression used twice would be computed twice.
    """
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashed = frame.withColumn(f"{name}_words", F.transform(words, lambda w: F.xxhash64(w)))
    h = F.col(f"{name}_words")
    shingled = F.when(
        F.size(h) >= _SHINGLE,
        F.transform(
            F.sequence(F.lit(0), F.size(h) - _SHINGLE),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(_SHINGLE)]),
        ),
    ).when(F.size(h) > 0, F.array(F.xxhash64(h)))
    shingled = hashed.withColumn(f"{name}_all", F.coalesce(shingled, F.array().cast("array<bigint>")))
    every = F.col(f"{name}_all")
    low = F.filter(every, lambda x: F.shiftrightunsigned(x, 64 - halvings) == 0)
    kept = shingled.withColumn(f"{name}_low", F.array_sort(F.array_distinct(low)))
    one = F.when(F.size(every) > 0, F.array(F.array_min(every))).otherwise(F.array().cast("array<bigint>"))
    sketch = F.when(F.size(f"{name}_low") > 0, F.col(f"{name}_low")).otherwise(one)
    kept = kept.withColumn(name, sketch)
    return kept.drop(f"{name}_words", f"{name}_all", f"{name}_low")


def merged(one: Column, other: Column) -> Column:
    """The sketch of two texts together, from sketches with a hash below the fraction."""
    return F.array_sort(F.array_union(one, other))


def as_string(sketch: Column) -> Column:
    """Sixteen hex digits for every hash, in order."""
    return F.lower(F.array_join(F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def containment(one: Column, other: Column) -> Column:
    """Share of the smaller sketch that the larger holds, 0 to 1; 1 for two empty ones.

    It estimates the share of the smaller text's shingles found in the other, however much
    longer that is.
    """
    least = F.least(F.size(one), F.size(other))
    both = F.size(F.array_intersect(one, other)) / least
    return F.when(least > 0, both).when(F.size(one) == F.size(other), 1.0).otherwise(0.0)


def with_next(
    frame: DataFrame,
    identity: str,
    columns: list[str],
    size: Column,
    derive: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``derive(frame)`` with ``next``, a struct of ``columns`` of the row with the next greater
    id, of the first row after the last. What is derived of a row is derived once.

    Ids are cut by their quantiles into buckets of some megabytes, which are sorted each; the
    first rows of the buckets close the gaps. Null ids come last, equal ids in order of
    ``columns``. ``identity`` must be a bigint.
    """
    total = frame.agg(F.sum(size)).first()[0] or 0
    buckets = min(max(int(total / _BUCKET_BYTES), 1), _FAN * _FAN)
    key = F.col(identity)
    shares = [i / buckets for i in range(1, buckets)]
    bounds = []
    if shares:
        accuracy = F.lit(max(10_000, 4 * buckets))
        bounds = sorted(set(frame.agg(F.percentile_approx(key, shares, accuracy)).first()[0] or []))
    bucket = F.when(key.isNull(), F.lit(len(bounds) + 1)).otherwise(_below(bounds, key))
    placed = derive(frame).withColumn("bucket", bucket)
    order = [F.asc_nulls_last(identity), *columns]
    after = F.lead(F.struct(*columns)).over(Window.partitionBy("bucket").orderBy(*order))
    # At most 65,537 buckets, of each the least id.
    firsts = frame.withColumn("bucket", bucket).groupBy("bucket").agg(F.min(identity).alias("first")).orderBy("bucket").collect()
    following = [(a["bucket"], b["first"]) for a, b in zip(firsts, firsts[1:] + firsts[:1], strict=True)]
    ends = frame.sparkSession.createDataFrame(following, "bucket int, first long")
    wanted = F.broadcast(ends.withColumnRenamed("bucket", "before"))
    heads = derive(frame.join(wanted, key.eqNullSafe(F.col("first"))))
    heads = heads.groupBy("before").agg(F.min(F.struct(*columns)).alias("head"))
    joined = placed.withColumn("after", after).join(
        heads, F.col("bucket") == F.col("before"), "left"
    )
    return joined.withColumn("next", F.coalesce("after", "head")).drop("bucket", "after", "before", "head")


def _below(bounds: list[int], key: Column) -> Column:
    """How many of the sorted bounds are at most the key; two steps of at most 256 each."""
    if not bounds:
        return F.lit(0)
    groups = [bounds[i : i + _FAN] for i in range(0, len(bounds), _FAN)]
    tops = F.array(*[F.lit(g[0]).cast("bigint") for g in groups])
    group = F.size(F.filter(tops, lambda b: b <= key))
    if len(groups) == 1:
        whole = F.array(*[F.lit(b).cast("bigint") for b in bounds])
        return F.size(F.filter(whole, lambda b: b <= key))
    parts = F.array(*[F.array(*[F.lit(b).cast("bigint") for b in g]) for g in groups])
    inside = F.size(F.filter(F.get(parts, group - 1), lambda b: b <= key))
    return F.when(group > 0, (group - 1) * _FAN + inside).otherwise(0)


def compared(docs: DataFrame, identity: str = "doc_id", text: str = "text", halvings: int = 3) -> DataFrame:
    """For every row its ``n_chars``, its ``edited`` text, both sketches and two likenesses.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as many
    (or all) of the next row's text. ``near_edited`` and ``near_next`` are containments of the
    sketch and that of the edited text, or of the next row's text.

    Null and empty texts have no code points and an empty sketch. Repeated rows follow each
    other; a row alone is its own next. An empty table gives an empty result. Columns other than
    ``identity`` are left out.
    """
    require(docs, identity, text)
    base = docs.select(
        F.col(f"`{identity}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body")
    )
    rows = with_next(
        base, "id", ["body", "sketch"], F.octet_length("body"),
        lambda rows: with_sketch(rows, "body", "sketch", halvings),
    )
    edited = rows.select(
        F.col("id").alias(identity),
        F.length("body").cast("long").alias("n_chars"),
        F.concat(
            F.expr("left(body, length(body) - length(body) div 2)"),
            F.expr("left(next.body, length(body) div 2)"),
        ).alias("edited"),
        "sketch",
        F.col("next.sketch").alias("next_sketch"),
    )
    done = with_sketch(edited, "edited", "edited_sketch", halvings)
    return done.select(
        identity, "n_chars", "edited", "sketch", "edited_sketch",
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
