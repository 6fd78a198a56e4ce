"""Benchmark decontamination by suffix arrays over the training text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

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

#: Benchmark text that one pass over the documents carries to every executor.
PASS_BYTES = 32 << 20
_SPANS = "array<struct<start: bigint, end: bigint>>"
_FOUND = "struct<words: bigint, longest: bigint, spans: {spans}, items: array<{ids}>>"


class Suffixes(NamedTuple):
    """Every test suffix that begins a window: word hashes, where each begins, how many words
    its window has, and its item; and the words themselves, by hash, to confirm matches."""

    words: np.ndarray
    begins: np.ndarray
    lengths: np.ndarray
    items: np.ndarray
    spelled: dict


def test_suffixes(item_texts: list, window: int) -> Suffixes:
    """Windows of ``window`` words; an item of fewer words, but not none, is one window."""
    data, offsets = texts(pa.array(item_texts, pa.large_string()))
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, ALNUM)
    hashes = word_hashes(data, starts, ends)
    begins, lengths, items = [], [], []
    for item, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if b > a:
            size = min(window, b - a)
            count = b - a - size + 1
            begins += range(a, a + count)
            lengths += [size] * count
            items += [item] * count
    raw = data.tobytes()
    spelled = {h: raw[s:e] for h, s, e in zip(hashes.tolist(), starts.tolist(), ends.tolist(), strict=True)}
    return Suffixes(hashes, *(np.array(x, dtype=np.int64) for x in (begins, lengths, items)), spelled)


def suffix_array(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in the order of their next ``depth`` words at least, the words' ranks, and the
    sorted distinct words. Ranks are doubled: pairs, then pairs of pairs."""
    known, ranks = np.unique(words, return_inverse=True)
    rank, step = ranks.astype(np.uint64) + np.uint64(1), 1
    order = np.argsort(rank, kind="stable")
    while step < depth:
        behind = np.zeros_like(rank)
        behind[:-step] = rank[step:]
        pair = (rank << np.uint64(32)) | behind
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(order) else np.zeros(0, bool)
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(fresh).astype(np.uint64)
        step *= 2
        if fresh.all():
            break
    return order, ranks, known


def search(
    order: np.ndarray, ranks: np.ndarray, known: np.ndarray, tests: Suffixes
) -> tuple[np.ndarray, np.ndarray]:
    """For each test suffix the range of the suffix array that begins with its window, found by
    binary search word after word; empty where the longest match is shorter than the window."""
    count = len(tests.begins)
    low, high = np.zeros(count, dtype=np.int64), np.full(count, len(order), dtype=np.int64)
    place = np.searchsorted(known, tests.words)
    place[place == len(known)] = 0
    there = known[place] == tests.words if len(known) else np.zeros(len(tests.words), bool)
    wanted = np.where(there, place, -1)
    active = np.arange(count)
    for t in range(int(tests.lengths.max(initial=0))):
        active = active[(tests.lengths[active] > t) & (low[active] < high[active])]
        if not len(active):
            break
        goal = wanted[tests.begins[active] + t]
        for side in ("left", "right"):
            a, b = low[active].copy(), high[active].copy()
            while len(open_ := np.flatnonzero(a < b)):
                middle = (a[open_] + b[open_]) // 2
                at = order[middle] + t
                seen = np.where(at < len(ranks), ranks[np.minimum(at, len(ranks) - 1)], -2)
                right = seen < goal[open_] if side == "left" else seen <= goal[open_]
                a[open_[right]] = middle[right] + 1
                b[open_[~right]] = middle[~right]
            if side == "left":
                lower = a
            else:
                high[active] = np.where(goal < 0, lower, a)
        low[active] = lower
    return low, high


def _matches(words: np.ndarray, tests: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """Test suffix and position of every occurrence of a window in a run of words."""
    order, ranks, known = suffix_array(words, int(tests.lengths.max(initial=1)))
    low, high = search(order, ranks, known, tests)
    sizes = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return which, order[np.repeat(low, sizes) + within]


def _found_in(data: np.ndarray, offsets: np.ndarray, tests: Suffixes) -> list[dict]:
    rows = len(offsets) - 1
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets, ALNUM)
    # A separator after each row keeps matches inside it; no test word hashes to it.
    row_of = np.repeat(np.arange(rows), np.diff(first))
    slot = np.arange(len(starts)) + row_of
    words = np.zeros(len(starts) + rows, dtype=np.uint64)
    words[slot] = word_hashes(data, starts, ends)
    begins = first[:-1] + np.arange(rows)
    which, at = _matches(words, tests)
    length = tests.lengths[which]
    hit = _covered(at, at + length, len(words))
    raw, word_at = data, np.full(len(words), -1)
    word_at[slot] = np.arange(len(starts))
    wrong = [
        p for p in np.flatnonzero(hit).tolist()
        if tests.spelled.get(int(words[p])) != raw[starts[word_at[p]] : ends[word_at[p]]].tobytes()
    ]
    if wrong:  # two spellings of one hash: matches that pass over one are none
        bad = np.zeros(len(words) + 1, dtype=np.int64)
        bad[np.array(wrong) + 1] = 1
        bad = np.cumsum(bad)
        right = bad[at + length] == bad[at]
        which, at, length = which[right], at[right], length[right]
        hit = _covered(at, at + length, len(words))
    found: list[dict] = [
        {"words": n, "longest": 0, "spans": [], "items": []} for n in np.diff(first).tolist()
    ]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    row = np.searchsorted(begins, edges[::2], "right") - 1
    for r, a, b in zip(row.tolist(), edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        found[r]["spans"].append({"start": a - int(begins[r]), "end": b - int(begins[r])})
    row = np.searchsorted(begins, at, "right") - 1
    # A match that goes on from one suffix to the next is one longer match.
    by = np.lexsort((at, at - which, row, tests.items[which]))
    item, row, diagonal, at, length = (x[by] for x in (tests.items[which], row, at - which, at, length))
    new = np.ones(len(at), dtype=bool)
    new[1:] = (
        (item[1:] != item[:-1]) | (row[1:] != row[:-1])
        | (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1)
    )
    runs = np.flatnonzero(new)
    sizes = np.diff(np.append(runs, len(at)))
    for r, i, n in zip(row[runs].tolist(), item[runs].tolist(), (length[runs] + sizes - 1).tolist(), strict=True):
        found[r]["longest"] = max(found[r]["longest"], n)
        if i not in found[r]["items"]:
            found[r]["items"].append(i)
    return found


def _covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def _searching(held: Broadcast, ids: Broadcast, kind: str):
    @F.arrow_udf(_FOUND.format(spans=_SPANS, ids=kind))
    def run(column: pa.Array) -> pa.Array:
        tests, names, out = held.value, ids.value, []
        data, offsets = texts(column)
        for a, b in pieces(offsets):
            part = data[offsets[a] : offsets[b]]
            out += _found_in(part, offsets[a : b + 1] - offsets[a], tests)
        for row in out:
            row["items"] = [names[i] for i in row["items"]]
        named = pa.int64() if kind == "bigint" else pa.string()
        found = pa.struct([
            ("words", pa.int64()), ("longest", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("items", pa.list_(named)),
        ])
        return pa.array(out, found)

    return run


def _united(column: pa.Array) -> pa.Array:
    """Runs that overlap or touch as one."""
    out = []
    for spans in column.to_pylist():
        merged: list[dict] = []
        for span in sorted(spans, key=lambda s: s["start"]):
            if merged and span["start"] <= merged[-1]["end"]:
                merged[-1]["end"] = max(merged[-1]["end"], span["end"])
            else:
                merged.append(dict(span))
        out.append(merged)
    return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """``item``, a whole number if the id is one and a string otherwise, and ``text``."""
    number = isinstance(benchmark.schema[item].dataType, T.IntegralType)
    name = F.col(f"`{item}`").cast("long" if number else "string").alias("item")
    return benchmark.select(name, F.col(f"`{text}`").alias("text")).where(F.length(f"`{text}`") > 0)


def _blocks(items: DataFrame, limit: int) -> Iterator[list[Row]]:
    """The benchmark in blocks of bounded text; a block comes to the driver alone."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // limit))
    for block in range(count):
        # Items of one text may lie in different blocks.
        part = F.pmod(F.xxhash64("text", "item"), F.lit(count)) == block
        yield items.where(part).orderBy("item", "text").collect()


def matched(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_hit``, ``longest``, ``spans`` and ``items``.

    Words are runs of digits, a-z and non-ASCII characters after lower-casing A-Z. Each piece
    of the training text gets a suffix array; every test suffix that begins a window of
    ``window`` words (or all words of a shorter item) is binary-searched in it, which gives the
    locations, and neighbouring matches give the longest. ``spans`` are the runs of document
    words inside occurrences, ``items`` the ids whose windows occur.

    The benchmark is sent to the executors ``pass_bytes`` of text at a time; a larger one takes one
    pass over the documents per such block, whose findings are written before the next block comes to
    the driver. With one block documents are never shuffled; findings of several are joined to them
    by 128 bits of hashes of the text.

    Item ids are whole numbers or taken as strings. A null or wordless text has no words and no matches, as have null items; items of a null id
    match but are not listed. Repeated rows are treated each. Columns named as the results are
    replaced.
    """
    require(docs, text)
    require(benchmark, item, item_text)
    results = {"n_words", "n_hit", "longest", "spans", "items"}
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in results]
    items = _items(benchmark, item, item_text)
    kind = items.schema["item"].dataType.simpleString()
    blocks = _blocks(items, pass_bytes)
    rows, more = next(blocks), next(blocks, None)
    body = F.col(f"`{text}`")
    packed = docs.select(F.struct(*rest).alias("row"), body.alias("body"))
    if more is None:
        found = packed.select("row", _pass(docs.sparkSession, rows, window, kind)[0](F.col("body")).alias("f"))
    else:
        found = _in_passes(packed, chain([rows, more], blocks), window, kind)
    out = found.select(
        "row",
        F.col("f.words").alias("n_words"),
        F.col("f.longest").alias("longest"),
        F.col("f.spans").alias("spans"),
        F.array_sort(F.array_distinct(F.array_compact("f.items"))).alias("items"),
    )
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("row.*", "n_words", hit.alias("n_hit"), "longest", "spans", "items")


def _pass(spark: SparkSession, rows: list[Row], window: int, kind: str):
    """The search for one block, and what it broadcasts."""
    sent = [
        spark.sparkContext.broadcast(test_suffixes([r["text"] for r in rows], window)),
        spark.sparkContext.broadcast([r["item"] for r in rows]),
    ]
    return _searching(*sent, kind), sent


def _in_passes(packed: DataFrame, blocks: Iterable[list[Row]], window: int, kind: str) -> DataFrame:
    """``row`` and ``f``, what all blocks find in it. Each pass writes its findings, by the text's
    hash, and gives its broadcast back before the next block comes to the driver."""
    spark = packed.sparkSession
    place = [F.xxhash64("body").alias("k1"), F.xxhash64(F.lit(1), "body").alias("k2")]
    passes = []
    for number, rows in enumerate(blocks):
        search, sent = _pass(spark, rows, window, kind)
        found = packed.select(*place, search(F.col("body")).alias("f"))
        hits = found.where(F.size("f.spans") > 0).dropDuplicates(["k1", "k2"])
        passes.append(written(hits, f"pass-{number}"))
        for broadcast in sent:
            broadcast.destroy()
    hits = reduce(DataFrame.unionByName, passes).groupBy("k1", "k2").agg(
        F.max("f.longest").alias("longest"),
        F.flatten(F.collect_list("f.spans")).alias("spans"),
        F.flatten(F.collect_list("f.items")).alias("items"),
    )
    counted = packed.select("row", _pass(spark, [], window, kind)[0](F.col("body"))["words"].alias("words"), *place)
    united = F.arrow_udf(_united, _SPANS)(F.coalesce("spans", F.array().cast(_SPANS)))
    found = F.struct(
        "words",
        F.coalesce("longest", F.lit(0).cast("long")).alias("longest"),
        united.alias("spans"),
        F.coalesce("items", F.array().cast(f"array<{kind}>")).alias("items"),
    )
    return counted.join(hits, ["k1", "k2"], "left").select("row", found.alias("f"))


def contaminated(n_hit: Column, n_words: Column, one_in: int = 20) -> Column:
    """Whether at least one word in ``one_in`` lies inside an occurrence of a window."""
    return (n_hit > 0) & (one_in * n_hit >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20) -> DataFrame:
    """The documents that are not contaminated, whole, with their own columns."""
    rest = docs.columns
    packed = docs.select(F.struct("*").alias("row"), F.col("text"))
    found = matched(packed, benchmark, window)
    clean = found.where(~contaminated(F.col("n_hit"), F.col("n_words"), one_in))
    return clean.select(*[F.col("row").getField(c).alias(c) for c in rest])
