"""Documents that share most of their word n-grams, by adaptive multi-match prefixes.

Every document is the set of its distinct n-grams, rarest first. If two sets have to share
``required`` n-grams to be similar enough, their prefixes that leave out ``required - level`` of
them share at least ``level``, for any level. A document lengthens its prefix as long as that is
worth its cost: longer lists to read, but more shared n-grams asked for before a pair is verified.
A pair is held to the smaller level of its two documents, for which both prefixes are long enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.components import components
from ticksmith.llm.shared import (
    LOWER,
    NOT_SPACE,
    mixed,
    pieces,
    require,
    texts,
    word_bounds,
    word_hashes,
    written,
)

#: Cells of the table that estimates how many documents hold an n-gram: 2 MB at any input size.
CELL_BITS = 18
#: The longest prefixes ask for so many shared n-grams.
MAX_LEVEL = 8
#: What verifying a pair costs, in list entries read, and what an entry costs by itself.
_VERIFY, _ENTRY = 8.0, 1.0
#: Bits of the filter that tells which documents a verification needs, and hashes of each.
_FILTER_BITS, _FILTER_HASHES = 24, 2
_WORDS_AT_ONCE = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)


def gram_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of every row; fewer words make one n-gram, none none."""
    data, offsets = texts(column)
    for a, b in pieces(offsets):
        part = LOWER[data[offsets[a] : offsets[b]]]
        starts, ends, first = word_bounds(part, offsets[a : b + 1] - offsets[a], NOT_SPACE)
        portions = [
            word_hashes(part, starts[i : i + _WORDS_AT_ONCE], ends[i : i + _WORDS_AT_ONCE])
            for i in range(0, len(starts), _WORDS_AT_ONCE)
        ]
        values = mixed(np.concatenate(portions) + np.uint64(1)) if portions else np.zeros(0, np.uint64)
        grams = _joined(values, words)
        for i, j in zip(first.tolist(), first[1:].tolist(), strict=False):
            if j - i >= words:
                found = np.sort(grams[i : j - words + 1])
                new = np.ones(len(found), dtype=bool)
                new[1:] = found[1:] != found[:-1]
                yield found[new]
            else:
                yield _joined(values[i:j], j - i) if j > i else values[:0]


def _joined(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` neighbouring values, and of their number."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    total = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        total = total * _BASE + values[k : k + count]
    return mixed(total)


def _key(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes())


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def _measure(words: int):
    """Id, size and key of every row's set (``cell`` null); a task's documents of each cell, a set
    that repeats counted once (``n`` in ``cell``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen = np.zeros(1 << CELL_BITS, dtype=np.int64), set()
        kind, names = None, ["id", "n", "key", "cell"]
        for batch in batches:
            sizes, keys, held, count = [], [], [], 0
            for grams in gram_sets(batch.column("text"), words):
                sizes.append(len(grams))
                keys.append(_key(grams) if len(grams) else 0)
                if len(grams) and keys[-1] not in seen:
                    seen.add(keys[-1])
                    held.append(grams >> np.uint64(64 - CELL_BITS))
                    count += len(grams)
                if count > len(cells):
                    cells += np.bincount(np.concatenate(held), minlength=len(cells))
                    held, count = [], 0
            if held:
                cells += np.bincount(np.concatenate(held), minlength=len(cells))
            kind = batch.column("id").type
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), _signed(keys), pa.nulls(len(sizes), pa.int32())], names
            )
        there = np.flatnonzero(cells)
        if len(there):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(there), kind), pa.array(cells[there]), pa.nulls(len(there), pa.int64()),
                 pa.array(there.astype(np.int32))], names,
            )

    return run


def required(n: np.ndarray | int, percent: int):
    """The least overlap of a set of n with any set that is similar enough."""
    return (percent * n + 99) // 100


def overlap(n, other, percent: int):
    """What two sets have to share."""
    return -(-percent * (n + other) // (100 + percent))


def chosen_level(lists: np.ndarray, n: int, percent: int) -> int:
    """The level of least estimated cost, for other documents' entries in the order of a prefix.

    A candidate at level l takes l entries at least, so the entries of the prefix over l bound
    how many pairs have to be verified. The prefix is that for partners of the same size.
    """
    least = overlap(n, n, percent)
    levels = np.arange(1, min(MAX_LEVEL, required(n, percent)) + 1)
    read = np.cumsum(lists)[n - least + levels - 1]
    cost = (n - least + levels) * _ENTRY + read * (1 + _VERIFY / levels)
    return int(levels[np.argmin(cost)])


def _prefixes(words: int, percent: int, cells_of: object):
    """Prefix entries of every set, once a task: n-gram, key, size, and level, which stands for
    the n-gram's place in the prefix, from 1, and the document's level in the last four bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen = cells_of.value, set()
        mean = cells.mean() if len(cells) else 0.0
        usual = mean + 3 * np.sqrt(mean)  # what chance alone puts into a cell
        over = np.maximum(cells - usual, 0.0)
        rank = np.minimum(8 * np.log2(1 + over), 255).astype(np.uint8)
        for batch in batches:
            tokens, keys, sizes, levels, counts = [], [], [], [], []
            for grams in gram_sets(batch.column(0), words):
                n = len(grams)
                if not n or (key := _key(grams)) in seen:
                    continue
                seen.add(key)
                cell = grams >> np.uint64(64 - CELL_BITS)
                order = np.argsort(rank[cell], kind="stable")  # rarest first, then by hash
                least = required(n, percent)
                level = chosen_level(over[cell[order[: n - least + MAX_LEVEL]]], n, percent)
                own = order[: n - least + level]
                tokens.append(grams[own])
                levels.append((np.arange(1, len(own) + 1) * 16 + level).astype(np.int32))
                keys.append(key)
                sizes.append(n)
                counts.append(len(own))
            if not keys:
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens).view(np.int64)),
                 pa.array(np.repeat(np.array(keys, np.uint64).view(np.int64), counts)),
                 pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                 pa.array(np.concatenate(levels))],
                ["token", "key", "n", "level"],
            )

    return run


def _bodies(words: int, filter_of: object):
    """The text of every set whose key passes the filter, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = filter_of.value, set()
        for batch in batches:
            keys, rows = [], []
            for row, grams in enumerate(gram_sets(batch.column(0), words)):
                if len(grams) and (key := _key(grams)) not in seen and _passes(bits, key):
                    seen.add(key)
                    keys.append(key)
                    rows.append(row)
            yield pa.RecordBatch.from_arrays(
                [_signed(keys), batch.column(0).take(pa.array(rows, pa.int64()))], ["key", "body"]
            )

    return run


def _places(key: int) -> Iterator[int]:
    for i in range(_FILTER_HASHES):
        yield key >> (_FILTER_BITS * i) & ((1 << _FILTER_BITS) - 1)


def _passes(bits: np.ndarray, key: int) -> bool:
    return all(int(bits[p >> 6]) >> (p & 63) & 1 for p in _places(key))


def key_filter(keys: DataFrame) -> np.ndarray:
    """A filter of 2 MB over ``key``, whatever their number; more keys let more others pass."""
    places = [
        F.shiftrightunsigned("key", _FILTER_BITS * i).bitwiseAND(F.lit((1 << _FILTER_BITS) - 1))
        for i in range(_FILTER_HASHES)
    ]
    at = keys.select(F.explode(F.array(*places)).alias("place"))
    words = at.groupBy(F.shiftright("place", 6).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))).alias("bits")
    )
    found = words.toArrow()  # at most a row for each 64 bits
    bits = np.zeros(1 << (_FILTER_BITS - 6), dtype=np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits.view(np.uint64)


def _similar(one: str, other: str, words: int, percent: int) -> Column:
    """Whether two texts' sets are similar enough; equal texts of a batch are hashed once."""

    @F.arrow_udf("boolean")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        found, places = [], []
        for column in (left, right):
            coded = column.dictionary_encode()
            found.append(list(gram_sets(coded.dictionary, words)))
            places.append(coded.indices.to_numpy())
        close = []
        for i, j in zip(*places, strict=True):
            both = np.concatenate([found[0][i], found[1][j]])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            close.append(100 * common >= percent * (len(both) - common))
        return pa.array(close, pa.bool_())

    return run(one, other)


def _sizes_fit(one: str, other: str, percent: int) -> Column:
    return F.least(one, other) * 100 >= F.greatest(one, other) * percent


def _enough(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` that share as many n-grams of their prefixes as the smaller of their
    levels asks for, of entries ``n``, ``level`` and ``n2``, ``level2`` with one token.

    The prefixes are those that the pair's own sizes ask for, which are shorter than what each
    document keeps for partners of any size.
    """
    n, n2, asked = F.col("n"), F.col("n2"), F.least(F.col("level") % 16, F.col("level2") % 16)
    more = asked - F.ceil(percent * (n + n2) / F.lit(100 + percent))
    place, place2 = F.shiftright("level", 4), F.shiftright("level2", 4)
    near = _sizes_fit("n", "n2", percent) & (place <= n + more) & (place2 <= n2 + more)
    counted = pairs.where(near).groupBy("a", "b").agg(F.count("*").alias("shared"), F.max(asked).alias("asked"))
    return counted.where("shared >= asked").select("a", "b")


def _star(entries: DataFrame, turn: int, percent: int) -> DataFrame:
    """Candidates between each document of a list and one of them, the list's hub.

    The first hub is the document that holds the n-gram earliest, so the one with the fewest
    n-grams that are rarer: of edited copies, the least edited. Other turns draw a hub by hash.
    Documents of a large group have mostly the same hub, so the group costs a pair for each of
    its documents instead of all pairs.
    """
    mark = F.xxhash64(F.lit(turn), "key")
    if turn == 0:
        early = F.shiftleft(F.least(F.shiftright("level", 4), F.lit((1 << 15) - 1)).cast("long"), 48)
        mark = early.bitwiseOR(mark.bitwiseAND(F.lit((1 << 48) - 1)))
    marked = entries.withColumn("mark", mark)
    least = marked.groupBy("token").agg(F.min("mark").alias("mark"))
    hubs = marked.join(least, ["token", "mark"]).select(
        "token", F.col("key").alias("b"), F.col("n").alias("n2"), F.col("level").alias("level2")
    )
    pairs = entries.withColumnRenamed("key", "a").join(hubs, "token").where("a <> b")
    return _enough(pairs, percent)


def _across(entries: DataFrame, percent: int) -> DataFrame:
    """Candidates between documents of different parts.

    In a pair's prefixes the smaller document's n-gram stands in the prefix it would need for a
    partner of its own size, so only those entries look for partners in a list.
    """
    n, level = F.col("n"), F.col("level")
    short = F.shiftright("level", 4) <= n + level % 16 - F.ceil(percent * (n + n) / F.lit(100 + percent))
    one = entries.where(short).withColumnRenamed("key", "a")
    two = entries.select(
        "token", F.col("part").alias("part2"), F.col("key").alias("b"), n.alias("n2"), level.alias("level2")
    )
    smaller = (n < F.col("n2")) | ((n == F.col("n2")) & (F.col("a") < F.col("b")))
    return _enough(one.join(two, "token").where((F.col("part") != F.col("part2")) & smaller), percent)


def _likely(pairs: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """The pairs that can be similar enough by all the n-grams that are kept of them.

    All common n-grams up to the earlier end of the two lists are in both; behind it there are at
    most as many as its document has left.
    """
    n, level = F.col("n"), F.col("level")
    kept = F.ceil(percent * n / F.lit(100)) - level % 16  # n-grams behind the list
    heads = entries.groupBy("key").agg(
        F.max("n").alias("n"), F.max(kept).alias("rest"), F.collect_list("token").alias("tokens")
    )
    one = heads.select(F.col("key").alias("a"), n.alias("n1"), F.col("rest").alias("rest1"), F.col("tokens").alias("t1"))
    two = heads.select(F.col("key").alias("b"), n.alias("n2"), F.col("rest").alias("rest2"), F.col("tokens").alias("t2"))
    common = F.size(F.array_intersect("t1", "t2"))
    least = F.ceil(percent * (F.col("n1") + F.col("n2")) / F.lit(100 + percent))
    fits = common + F.greatest("rest1", "rest2") >= least
    return pairs.join(one, "a").join(two, "b").where(fits).select("a", "b")


def near_copies(
    docs: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    words: int = 4,
    percent: int = 85,
    hubs: int = 2,
) -> DataFrame:
    """``identity``, ``n_shingles`` (the set's size) and ``component_id`` of every row.

    A set holds the distinct runs of ``words`` words, lower-cased for A-Z and split at ASCII
    white space; fewer words make one run. Rows link when 100 times their sets' intersection is
    at least ``percent`` times their union; a component is named by its smallest id. Equal sets
    collapse first. Then documents are compared with ``hubs`` of every prefix list, and what that
    connects is one part; last, exactly the pairs across parts that share enough are verified.
    Links inside a part could join nothing new, so none that matters is left out.

    Sets are compared by 64-bit hashes of their runs. Null and empty texts have empty sets,
    which link with nothing; their component is their own id. Null ids are rows like others but
    name a component only if it has no other id. Repeated rows stay. An empty table gives an
    empty result; other columns are left out.
    """
    require(docs, identity, text)
    if not 0 < percent <= 100:
        raise ValueError("percent is from 1 to 100")
    spark = docs.sparkSession
    named = docs.select(F.col(f"`{identity}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = named.select("id").schema.add("n", "long").add("key", "long").add("cell", "integer")
    seen = written(named.mapInArrow(_measure(words), schema), "sets")
    rows = seen.where("cell is null").select("id", "n", "key")
    summed = seen.where("cell is not null").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells = np.zeros(1 << CELL_BITS, dtype=np.int64)
    cells[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    cells_of = spark.sparkContext.broadcast(cells)

    bodies = named.select("text")
    entries = bodies.mapInArrow(
        _prefixes(words, percent, cells_of), "token long, key long, n int, level int"
    )
    entries = written(entries, "prefixes")
    lists = entries.groupBy("token").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    lists = written(lists.where("least <> most").select("token"), "lists")
    entries = written(entries.join(lists, "token").distinct(), "shared")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = written(pairs, "pairs")
        keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
        filter_of = spark.sparkContext.broadcast(key_filter(keys))
        found = bodies.mapInArrow(_bodies(words, filter_of), "key long, body string")
        # One exchange by key serves both sides; texts move in fewer bytes than their sets.
        sets = written(found, "bodies").groupBy("key").agg(F.any_value("body").alias("body"))
        one = sets.select(F.col("key").alias("a"), F.col("body").alias("one"))
        two = sets.select(F.col("key").alias("b"), F.col("body").alias("two"))
        both = pairs.join(one, "a").join(two, "b").where(_similar("one", "two", words, percent))
        return written(both.select(F.col("a").alias("u"), F.col("b").alias("v")), "links")

    starred = _star(entries, 0, percent)
    for turn in range(1, hubs):
        starred = starred.union(_star(entries, turn, percent))
    links = verified(_likely(starred.distinct(), entries, percent))
    entries = _apart(entries, links)
    links = links.union(verified(_likely(_across(entries, percent), entries, percent)))

    roots = components(links)
    sized = rows.where("n > 0")
    least = sized.groupBy("key").agg(F.min("id").alias("least"))
    parted = least.join(roots, F.col("key") == F.col("node"), "left").select(
        "key", "least", F.coalesce("root", "key").alias("root")
    )
    names = parted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = parted.join(names, "root").select("key", "component_id")
    linked = sized.join(labels, "key").select("id", "n", "component_id")
    alone = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return linked.union(alone).select(
        F.col("id").alias(identity), F.col("n").alias("n_shingles"), "component_id"
    )


def _apart(entries: DataFrame, links: DataFrame) -> DataFrame:
    """The entries of lists that hold several parts still, with their documents' ``part``."""
    roots = components(links)
    entries = entries.select("token", "key", "n", "level").join(
        roots.select(F.col("node").alias("key"), "root"), "key", "left"
    )
    entries = entries.select("token", "key", "n", "level", F.coalesce("root", "key").alias("part"))
    several = entries.groupBy("token").agg(F.min("part").alias("least"), F.max("part").alias("most"))
    several = several.where("least <> most").select("token")
    return written(entries.join(several, "token"), "apart")
