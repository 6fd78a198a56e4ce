"""Near-duplicate documents by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.components import components
from ticksmith.llm.shared import require, written

#: Shingles whose hash bits are held at a time.
_HELD = 1 << 16
_HALF = 32


def fingerprint(text: Column, words: int = 3) -> Column:
    """The 64-bit SimHash of a text as a bigint.

    Lower-cases A-Z and takes words between ASCII white space. Each shingle of ``words`` words,
    joined by single spaces, repeats included, votes with the bits of its XXH64 (seed 42); a
    text of fewer words is one shingle. A bit is set if more than half the votes have it. Null
    and empty texts have fingerprint 0.
    """

    @F.arrow_udf("long")
    def run(column: pa.Array) -> pa.Array:
        prints = np.zeros(len(column), dtype=np.uint64)
        for i, value in enumerate(column):
            if value.is_valid:
                prints[i] = _simhash(value.as_buffer().to_pybytes(), words)
        return pa.array(prints.view(np.int64))

    return run(text)


def _simhash(text: bytes, words: int) -> int:
    tokens = text.lower().split()  # bytes: A-Z alone, and ASCII white space alone
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = max(len(tokens) - words, 0)
    begins, stops = starts[: last + 1].tolist(), ends[min(words, len(tokens)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    votes, ones = len(begins), np.zeros(64, dtype=np.int64)
    for at in range(0, votes, _HELD):
        part = zip(begins[at : at + _HELD], stops[at : at + _HELD], strict=True)
        hashes = np.array([digest(joined[b:e], 42) for b, e in part], dtype=np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > votes).tobytes(), "big")


def hex_fingerprint(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def linked_fingerprints(prints: DataFrame, bits: int = 3) -> DataFrame:
    """Pairs ``u``, ``v`` of different fingerprints at ``bits`` (at most 3) or fewer bits.

    ``prints`` has distinct bigints in ``fingerprint``. Of two halves of 32 bits, one differs in
    at most one bit. The table holds each half as it is; the probes are the half and the half
    with one of its set bits cleared, so that of two neighbours the one with the extra bit finds
    the other. Complete distances decide.
    """
    if not 0 <= bits <= 3:
        raise ValueError("two halves and balls of one bit find at most 3 differing bits")
    halves = F.array(
        F.struct(F.lit(0).alias("part"), F.shiftrightunsigned("fingerprint", _HALF).alias("half")),
        F.struct(
            F.lit(1).alias("part"),
            F.col("fingerprint").bitwiseAND(F.lit((1 << _HALF) - 1)).alias("half"),
        ),
    )
    table = prints.select("fingerprint", F.inline(halves))
    masks = F.array(*[F.lit(1 << i) for i in range(_HALF)])
    ball = F.concat(
        F.array(F.col("half")),
        F.transform(
            F.filter(masks, lambda m: F.col("half").bitwiseAND(m) != 0),
            lambda m: F.col("half").bitwiseXOR(m),
        ),
    )
    probes = table.select(
        F.col("fingerprint").alias("v"), "part", F.explode(ball).alias("half")
    )
    table = table.select(F.col("fingerprint").alias("u"), "part", "half")
    distance = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    # Spark sizes what a generator makes as one row of each, and would broadcast balls 34 times as large.
    found = table.join(probes.hint("merge"), ["part", "half"])
    found = found.where((distance <= bits) & (F.col("u") != F.col("v")))
    return found.select("u", "v")


def near_duplicates(
    docs: DataFrame, identity: str = "doc_id", text: str = "text", words: int = 3, bits: int = 3
) -> DataFrame:
    """``identity``, ``fingerprint`` (bigint) and ``component_id`` of every row.

    Rows link when their fingerprints differ in ``bits`` or fewer bits; the component is named
    by its smallest id. Equal fingerprints collapse to one entry before any search, so copies
    cost one row each and never meet in one task.

    Null and empty texts have fingerprint 0 and link like others. Null ids are rows like
    others but name a component only if it has no other id. Repeated rows stay. An empty table
    gives an empty result; other columns are left out.
    """
    prints, named = _grouped(docs, identity, text, words, bits)
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(names, "root").select("fp", "component_id")
    # A written table is sized as its compressed files, several times too low to broadcast it by.
    return prints.join(labels.hint("merge"), "fp").select(
        F.col("id").alias(identity), F.col("fp").alias("fingerprint"), "component_id"
    )


def _grouped(docs: DataFrame, identity: str, text: str, words: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """``id``, ``body`` (a hash of the text) and ``fp`` of every row, and of every fingerprint its
    ``least`` id, its first row (``first``: by id, null last, and then body) and its component's
    ``root``."""
    require(docs, identity, text)
    body = F.col(f"`{text}`")
    prints = written(
        docs.select(
            F.col(f"`{identity}`").alias("id"), F.xxhash64(body).alias("body"), fingerprint(body, words).alias("fp")
        ),
        "fingerprints",
    )
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "body")).alias("first")
    least = prints.groupBy("fp").agg(F.min("id").alias("least"), first)
    links = linked_fingerprints(least.select(F.col("fp").alias("fingerprint")), bits)
    roots = components(links)
    named = least.join(roots, F.col("fp") == F.col("node"), "left")
    return prints, named.select("fp", "least", "first", F.coalesce("root", "fp").alias("root"))


def keep_one(
    docs: DataFrame, identity: str = "doc_id", text: str = "text", words: int = 3, bits: int = 3
) -> DataFrame:
    """One row of each group, whole, with docs' columns: that of the smallest id, and of several
    texts of that id the one with the smallest hash.

    Rows that repeat both id and text count as one. A row without an id stays only where its
    group has no other, and then one. An empty table gives an empty result.
    """
    _, named = _grouped(docs, identity, text, words, bits)
    kept = named.groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.id").alias("kept_id"), F.col("first.body").alias("kept_body"))
    packed = docs.select(
        F.struct("*").alias("row"),
        F.col(f"`{identity}`").alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("body"),
    )
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("body") == F.col("kept_body"))
    return packed.join(kept, same, "left_semi").dropDuplicates(["id", "body"]).select("row.*")
