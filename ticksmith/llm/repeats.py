"""Where long repeats can be: contexts around anchors that several places share.

Two equal windows of ``window`` units (bytes or words) hold the same ``gram`` units with the
least hash, their anchor, at the same distance. Every window start belongs to one anchor; the
starts that belong to one occurrence of an anchor, with the units their windows cover, are a
context. Windows can only be equal if their contexts share the anchor's hash (the key). So
contexts whose key occurs once are done, and the others are compared key by key. Contexts of a
key with too many are texts of their own, in which longer anchors part them again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.shared import pieces, rolling, row_key, texts, written

_PLACE_BITS = 24  # places in a piece or slice
_SLICE = 1 << 20
_PIECE = 1 << 20
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)


class Units(NamedTuple):
    """The units of some rows: a value for each, each row's first, and where a unit begins and
    ends in the bytes of the rows."""

    values: np.ndarray
    first: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


class Method(NamedTuple):
    """What tells bytes and words apart, and how contexts that share a key are compared."""

    window: int
    gram: int
    units: Callable[[np.ndarray, np.ndarray], Units]
    #: Repeated starts of each of some payloads, the bytes of contexts, given which of them stand
    #: for several places.
    repeated: Callable[[list[bytes], list[bool], int], list[np.ndarray]]
    chunk_bytes: int
    #: Different contexts of a key that are compared together.
    hot_contexts: int

    def longer(self) -> Method:
        """The method with anchors that leave a window an eighth of the room, at last none."""
        return self._replace(gram=self.window - (self.window - self.gram) // 8)


def contexts(units: Units, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, first start, number of starts and key of every context of some rows."""
    values, first = units.values, units.first
    span = window - gram + 1
    sizes = np.diff(first)
    rows = np.flatnonzero(sizes >= window)
    empty = np.zeros(0, dtype=np.int64)
    if not len(rows):
        return empty, empty, empty, np.zeros(0, dtype=np.uint64)
    hashes = rolling(values, gram)
    # The place in the low bits makes the leftmost of equal hashes the least.
    marked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    least, step = marked, 1
    while 2 * step <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < span:
        least = np.minimum(least[: len(least) - (span - step)], least[span - step :])
    anchor = (least & _PLACE).astype(np.int64)  # of the window at every start
    counts = sizes[rows] - window + 1
    row = np.repeat(rows, counts)
    start = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    start = start + first[row]
    chosen = anchor[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    begins = np.flatnonzero(new)
    starts = np.diff(np.append(begins, len(start)))
    row, start, chosen = row[begins], start[begins], chosen[begins]
    return row, start - first[row], starts, hashes[chosen]


def _emit_contexts(method: Method):
    """The contexts of each text, as often as the text stands for places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, stands = (batch.column(i).to_numpy() for i in (0, 1, 3))
            data, offsets = texts(batch.column(2))
            for a, b in pieces(offsets, _PIECE):
                units = method.units(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for found in _sliced(units, method):
                    times = stands[a:b][found[0]]
                    row, start, starts, key = (np.repeat(c, times) for c in found)
                    body = _digests(units, method, row, start, starts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k1[a:b][row]), pa.array(k2[a:b][row]),
                         pa.array(start.astype(np.int32)), pa.array(starts.astype(np.int32)),
                         pa.array(key.view(np.int64)), pa.array(body.view(np.int64))],
                        ["k1", "k2", "start", "starts", "key", "body"],
                    )

    return run


def _digests(units: Units, method: Method, row, start, starts) -> np.ndarray:
    """A hash of all units of every context."""
    raw = memoryview(np.ascontiguousarray(units.values)).cast("B")
    digest, width = xxhash.xxh3_64_intdigest, units.values.itemsize
    at = (start + units.first[row]) * width
    to = at + (starts + method.window - 1) * width
    values = (digest(raw[i:j]) for i, j in zip(at.tolist(), to.tolist(), strict=True))
    return np.fromiter(values, dtype=np.uint64, count=len(row))


def _sliced(units: Units, method: Method) -> Iterator[tuple[np.ndarray, ...]]:
    """The contexts of some rows; a long row in slices of starts, which changes no anchor."""
    if len(units.first) > 2 or len(units.values) <= 2 * _SLICE:
        yield contexts(units, method.window, method.gram)
        return
    for at in range(0, len(units.values) - method.window + 1, _SLICE):
        values = units.values[at : at + _SLICE + method.window - 1]
        part = Units(values, np.array([0, len(values)]), values, values)
        row, start, starts, key = contexts(part, method.window, method.gram)
        yield row, start + at, starts, key


def _cut_payloads(method: Method):
    """The bytes of the contexts listed for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1)
            data, offsets = texts(batch.column(0))
            for a, b in pieces(offsets, _PIECE):
                raw = data[offsets[a] : offsets[b]]
                units = method.units(raw, offsets[a : b + 1] - offsets[a])
                raw, part = memoryview(np.ascontiguousarray(raw)), wanted.slice(a, b - a)
                flat, sizes = part.flatten(), part.value_lengths().to_numpy()
                start, starts = (flat.field(n).to_numpy() for n in ("start", "starts"))
                at = start + np.repeat(units.first[:-1], sizes)
                to = units.ends[at + starts + method.window - 2]
                at = units.begins[at]
                for i, j in _portions(to - at):
                    ends = zip(at[i:j].tolist(), to[i:j].tolist(), strict=True)
                    payload = [bytes(raw[x:y]) for x, y in ends]
                    yield pa.RecordBatch.from_arrays(
                        [*(flat.field(n).slice(i, j - i) for n in ("key", "body", "many")),
                         pa.array(payload, pa.binary())],
                        ["key", "body", "many", "payload"],
                    )

    return run


def _portions(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    return pieces(np.concatenate([[0], np.cumsum(sizes)]), 4 * _PIECE) if len(sizes) else iter(())


def _compare(method: Method):
    """Contexts sorted by key, compared chunk by chunk; a chunk holds whole keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != last and size >= method.chunk_bytes:
                    yield _compared(method, held)
                    held, size = [], 0
                # Repeated rows of the input give the same context again.
                if held and held[-1][:2] == row[:2]:
                    continue
                held.append(row)
                size, last = size + len(row[3]), row[0]
        if held:
            yield _compared(method, held)

    return run


def _compared(method: Method, held: list[tuple]) -> pa.RecordBatch:
    keys, bodies, many, payloads = zip(*held, strict=True)
    found = method.repeated(list(payloads), list(many), method.window)
    out = [_runs(starts) for starts in found]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(bodies, pa.int64()), pa.array(out, pa.binary())],
        ["key", "body", "found"],
    )


def _runs(starts: np.ndarray) -> bytes:
    """Runs of neighbouring starts as first and end, 32-bit numbers in turn."""
    if not len(starts):
        return b""
    gaps = np.flatnonzero(np.diff(starts) != 1)
    first = np.concatenate([[starts[0]], starts[gaps + 1]])
    end = np.concatenate([starts[gaps], [starts[-1]]]) + 1
    return np.stack([first, end], axis=1).astype("<i4").tobytes()


def _merged(found: pa.Array) -> pa.Array:
    """The runs of a context from those of its parts, one after the other."""
    out = []
    for parts in found.to_pylist():
        runs = [np.frombuffer(p["runs"], dtype="<i4") + np.int32(p["start"]) for p in parts]
        out.append(np.concatenate(runs).astype("<i4").tobytes())
    return pa.array(out, pa.binary())


def with_repeats(docs: DataFrame, text: str, identity: str, method: Method) -> DataFrame:
    """``row`` (all of ``docs``), ``text`` and ``found``: a list of ``start``, where a context
    begins, and ``runs``, the repeated window starts in it. Null where nothing repeats.

    Texts are shuffled by two hashes that name the row; rows equal in id and text share them, and
    count as several places.
    """
    packed = docs.select(F.struct("*").alias("row"), *row_key(identity, text))
    body = F.col("row").getField(text).alias("text")
    named = packed.select(
        F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), body, F.lit(1).alias("stands")
    )
    places = _repeats(named, method).withColumnsRenamed({"k1": "_k1", "k2": "_k2"})
    return packed.join(places, ["_k1", "_k2"], "left").select("row", body, "found")


def _repeats(named: DataFrame, method: Method) -> DataFrame:
    """``found`` for the texts in which something repeats.

    Equal contexts collapse to one that stands for many, whose windows all repeat. Contexts of
    one key are compared together in one task while they are at most ``hot_contexts``. Those of a
    key with more are texts of a further round with longer anchors: whatever differs inside an
    anchor parts them, and what is equal around it collapses. Anchors as long as the window, one
    to each start, end the rounds.
    """
    names = ", ".join(f"{n} {t}" for n, t in named.dtypes if n in ("k1", "k2"))
    schema = f"{names}, start int, starts int, key long, body long"
    seen = written(named.mapInArrow(_emit_contexts(method), schema), "contexts")
    shared = seen.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    # A table on either side lets a key of very many contexts be split in the join.
    seen = written(seen.join(written(shared, "keys"), "key"), "shared")
    at = F.min(F.struct("k1", "k2", "start", "starts")).alias("at")
    distinct = seen.groupBy("key", "body").agg(at, (F.count("*") > 1).alias("many"))
    last = method.gram == method.window
    hot = distinct.groupBy("key").agg(F.count("*").alias("n")).where(
        F.lit(False) if last else F.col("n") > method.hot_contexts
    )
    distinct = distinct.select("key", "body", "many", "at.*").join(
        hot.select("key", F.lit(True).alias("hot")), "key", "left"
    )
    distinct = written(distinct, "distinct")

    def payloads(part: DataFrame) -> DataFrame:
        wanted = F.collect_list(F.struct("key", "body", "many", "start", "starts")).alias("wanted")
        listed = part.groupBy("k1", "k2").agg(wanted)
        cut = named.join(listed, ["k1", "k2"]).select("text", "wanted")
        return cut.mapInArrow(
            _cut_payloads(method), "key long, body long, many boolean, payload binary"
        )

    cold = payloads(distinct.where("hot is null")).repartition("key")
    found = cold.sortWithinPartitions("key", "body").mapInArrow(
        _compare(method), "key long, body long, found binary"
    )
    if not last and not distinct.where("hot").isEmpty():
        stands = F.when(F.col("many"), 2).otherwise(1).alias("stands")
        parts = payloads(distinct.where("hot")).select(
            F.col("key").alias("k1"), F.col("body").alias("k2"), F.col("payload").alias("text"), stands
        )
        again = _repeats(written(parts, "hot"), method.longer())
        merged = F.arrow_udf(_merged, "binary")("found").alias("found")
        found = found.union(again.select(F.col("k1").alias("key"), F.col("k2").alias("body"), merged))
    found = found.where(F.length("found") > 0)
    # Rows equal in id and text have one name and the same places, which a set keeps once.
    return seen.join(found, ["key", "body"]).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("start", F.col("found").alias("runs"))).alias("found")
    )


def covered(found: list | None, window: int, size: int) -> list[tuple[int, int]]:
    """Maximal runs of units inside repeated windows."""
    change = np.zeros(size + 1, dtype=np.int64)
    for place in found or []:
        runs = np.frombuffer(place["runs"], dtype="<i4").reshape(-1, 2) + place["start"]
        np.add.at(change, runs[:, 0], 1)
        np.add.at(change, runs[:, 1] - 1 + window, -1)
    inside = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]])
    edges = np.flatnonzero(np.diff(inside))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
