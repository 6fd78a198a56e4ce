"""Removing byte strings that occur more than once, by two-stage suffix sorting."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.repeats import Method, Units, covered, with_repeats
from ticksmith.llm.shared import require, texts

_SPANS = "array<struct<start: bigint, end: bigint>>"
_SEPARATOR = b"\xff"  # in no UTF-8 text


def two_stage_order(text: bytes, depth: int) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes, exact to ``depth`` bytes.

    Only suffixes smaller than their successors are sorted directly. The others follow: scanning
    the order from its beginning, the predecessor of every suffix met, if it is larger than its
    successor, is the next of its first byte. The scan takes one bucket of first bytes at a
    time; a run of equal bytes is followed inside its bucket.
    """
    size = len(text)
    if not size:
        return np.zeros(0, dtype=np.int64)
    values = np.frombuffer(text, dtype=np.uint8)
    step = np.zeros(size, dtype=np.int16)
    step[:-1] = values[1:].astype(np.int16) - values[:-1]
    step[-1] = -1  # the end is smaller than any byte
    decided = np.where(step != 0, np.arange(size), size - 1)
    smaller = step[np.minimum.accumulate(decided[::-1])[::-1]] > 0

    direct = np.flatnonzero(smaller)
    direct = direct[np.argsort(values[direct], kind="stable")]
    edges = np.searchsorted(values[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[values[-1]].append(np.array([size - 1]))
    order: list[np.ndarray] = []
    for byte in range(256):
        now = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, dtype=np.int64)
        passed = []
        while len(now):
            passed.append(now)
            before = now[now > 0] - 1
            now = before[(values[before] == byte) & ~smaller[before]]
        own = direct[edges[byte] : edges[byte + 1]].tolist()
        own.sort(key=lambda i: text[i : i + depth])
        passed.append(np.array(own, dtype=np.int64))
        here = np.concatenate(passed)
        order.append(here)
        before = here[here > 0] - 1
        before = before[values[before] > byte]
        first = values[before]
        before = before[np.argsort(first, kind="stable")]
        counts = np.bincount(first, minlength=256)
        at = np.cumsum(counts) - counts
        for b in np.flatnonzero(counts).tolist():
            waiting[b].append(before[at[b] : at[b] + counts[b]])
    return np.concatenate(order)


def common_prefixes(text: bytes, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes at pairs of positions, up to ``most``, eight bytes a step."""
    padded = text + bytes(16)
    eight = np.ndarray((len(text) + 8,), dtype="<u8", buffer=padded, strides=(1,))
    lengths = most.copy()
    active, at = np.flatnonzero(most > 0), 0
    while len(active):
        differ = eight[left[active] + at] ^ eight[right[active] + at]
        ended = differ != 0
        low = differ[ended]
        same = np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
        lengths[active[ended]] = np.minimum(at + same, most[active[ended]])
        at += 8
        active = active[~ended]
        active = active[most[active] > at]
    return lengths


def repeated_starts(payloads: list[bytes], many: list[bool], window: int) -> list[np.ndarray]:
    """Starts, in each payload, of the strings of ``window`` bytes that start elsewhere too."""
    sizes = np.array([len(p) for p in payloads])
    text = _SEPARATOR.join(payloads) + _SEPARATOR
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    owner = np.repeat(np.arange(len(payloads)), sizes + 1)
    end = (begins + sizes)[owner]
    whole = np.arange(len(text)) + window <= end
    order = two_stage_order(text, window)
    order = order[whole[order]]
    marked = np.zeros(len(text), dtype=bool)
    if len(order) > 1:
        left, right = order[:-1], order[1:]
        by = np.argsort(right)
        left, right = left[by], right[by]
        # Where both neighbours only moved on by one equal byte, their prefix is one shorter.
        values = np.frombuffer(text, dtype=np.uint8)
        fresh = np.ones(len(left), dtype=bool)
        fresh[1:] = (
            (right[1:] != right[:-1] + 1) | (left[1:] != left[:-1] + 1)
            | (values[right[:-1]] != values[left[:-1]])
        )
        heads = np.flatnonzero(fresh)
        most = np.minimum(end[left[heads]] - left[heads], end[right[heads]] - right[heads])
        lengths = common_prefixes(text, left[heads], right[heads], most)
        of = np.cumsum(fresh) - 1
        prefix = lengths[of] - (right - right[heads][of])
        same = prefix >= window
        marked[left[same]] = True
        marked[right[same]] = True
    stands = np.array(many, dtype=bool)
    marked |= whole & stands[owner]
    places = np.flatnonzero(marked)
    cuts = np.searchsorted(places, np.append(begins, len(text)))
    return [places[a:b] - at for a, b, at in zip(cuts, cuts[1:], begins, strict=False)]


def _bytes(data: np.ndarray, offsets: np.ndarray) -> Units:
    places = np.arange(len(data) + 1)
    return Units(data, offsets, places[:-1], places[1:])


def _removal(window: int):
    @F.arrow_udf(f"struct<spans: {_SPANS}, kept: binary>")
    def run(text: pa.Array, found: pa.Array) -> pa.Array:
        data, offsets = texts(text)
        raw = memoryview(np.ascontiguousarray(data))
        spans, kept = [], []
        for i, places in enumerate(found):
            a, b = int(offsets[i]), int(offsets[i + 1])
            own = covered(places.as_py(), window, b - a) if places.is_valid else []
            spans.append([{"start": x, "end": y} for x, y in own])
            edges = [0, *(e for span in own for e in span), b - a]
            kept.append(b"".join(raw[a + x : a + y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays(
            [pa.array(spans, kind), pa.array(kept, pa.binary())], ["spans", "kept"]
        )

    return run


def remove_repeated_bytes(
    docs: DataFrame,
    window: int = 400,
    identity: str = "doc_id",
    text: str = "text",
    gram: int = 64,
    hot_contexts: int = 2000,
    chunk_bytes: int = 1 << 20,
) -> DataFrame:
    """Every row of ``docs`` with ``spans``, its maximal removed runs of bytes, and ``kept``,
    the remaining bytes.

    A byte is removed if a string of ``window`` bytes that covers it also starts anywhere else
    in ``docs``, the same text included; no string crosses texts, and all are judged on the
    input. Texts are UTF-8, so a run may begin inside a character.

    Anchors (see ``repeats``) bring the contexts that can repeat together, about three times
    the bytes concerned; each chunk of them is suffix-sorted in two stages, and neighbours with
    a common prefix of ``window`` bytes repeat.

    Null and empty texts have no bytes. Rows that repeat a text repeat all its strings. An empty
    table gives an empty result. Columns named as the results are replaced.
    """
    require(docs, identity, text)
    if not 0 < gram <= window or gram & (gram - 1):
        raise ValueError("gram must be a power of two, at most the window")
    rest = [c for c in docs.columns if c.lower() not in {"spans", "kept"}]
    method = Method(window, gram, _bytes, repeated_starts, chunk_bytes, hot_contexts)
    found = with_repeats(docs.select(*[F.col(f"`{c}`") for c in rest]), text, identity, method)
    done = found.select("row", _removal(window)("text", "found").alias("done"))
    return done.select("row.*", "done.spans", "done.kept")
