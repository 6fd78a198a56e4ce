"""Removing word sequences that occur more than once, by suffix automata."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.repeats import Method, Units, covered, with_repeats
from ticksmith.llm.shared import NOT_SPACE, require, texts, word_bounds, word_hashes

_SPANS = "array<struct<start: bigint, end: bigint>>"


class Automaton:
    """The suffix automaton of several sequences, with the number of places of every state."""

    def __init__(self) -> None:
        self.follow: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.places = [0]

    def add(self, sequence: list, weight: int) -> None:
        """Take in a sequence that stands for ``weight`` places."""
        follow, link, length, places = self.follow, self.link, self.length, self.places
        last = 0
        for unit in sequence:
            known = follow[last].get(unit)
            if known is not None:
                if length[known] != length[last] + 1:
                    known = self._split(last, unit, known)
                last = known
                places[last] += weight
                continue
            state = len(length)
            follow.append({})
            link.append(0)
            length.append(length[last] + 1)
            places.append(weight)
            at = last
            while at >= 0:
                known = follow[at].get(unit)
                if known is not None:
                    if length[known] != length[at] + 1:
                        known = self._split(at, unit, known)
                    link[state] = known
                    break
                follow[at][unit] = state
                at = link[at]
            last = state

    def _split(self, at: int, unit: object, known: int) -> int:
        follow, link, length = self.follow, self.link, self.length
        state = len(length)
        follow.append(follow[known].copy())
        link.append(link[known])
        length.append(length[at] + 1)
        self.places.append(0)
        link[known] = state
        while at >= 0 and follow[at].get(unit) == known:
            follow[at][unit] = state
            at = link[at]
        return state

    def finish(self) -> None:
        """Sum places along links; ``repeated`` gets the longest repeated suffix of a state."""
        order = np.argsort(np.array(self.length), kind="stable").tolist()
        link, places = self.link, self.places
        for state in reversed(order[1:]):
            places[link[state]] += places[state]
        self.repeated = [0] * len(order)
        for state in order[1:]:
            above = self.repeated[link[state]]
            self.repeated[state] = self.length[state] if places[state] > 1 else above

    def matches(self, sequence: list) -> list[int]:
        """Matching statistics of a sequence that was taken in: for every end, the longest
        suffix there that has several places."""
        follow, link, places, repeated = self.follow, self.link, self.places, self.repeated
        state, out = 0, []
        for size, unit in enumerate(sequence, 1):
            state = follow[state][unit]
            out.append(size if places[state] > 1 else repeated[link[state]])
        return out


def repeated_starts(payloads: list[bytes], many: list[bool], window: int) -> list[np.ndarray]:
    """Starts, in each payload, of windows of words that start elsewhere too."""
    sequences = [p.split() for p in payloads]
    shard = Automaton()
    for sequence, stands in zip(sequences, many, strict=True):
        shard.add(sequence, 2 if stands else 1)
    shard.finish()
    return [
        np.flatnonzero(np.array(shard.matches(sequence), dtype=np.int64) >= window) - window + 1
        for sequence in sequences
    ]


def _words(data: np.ndarray, offsets: np.ndarray) -> Units:
    starts, ends, first = word_bounds(data, offsets, NOT_SPACE)
    return Units(word_hashes(data, starts, ends), first, starts, ends)


def _removal(window: int):
    @F.arrow_udf(f"struct<n_words: bigint, spans: {_SPANS}, kept: string>")
    def run(text: pa.Array, found: pa.Array) -> pa.Array:
        sizes, spans, kept = [], [], []
        for value, places in zip(text, found, strict=True):
            words = value.as_buffer().to_pybytes().split() if value.is_valid else []
            own = covered(places.as_py(), window, len(words)) if places.is_valid else []
            edges = [0, *(e for span in own for e in span), len(words)]
            rest = [w for x, y in zip(edges[::2], edges[1::2], strict=True) for w in words[x:y]]
            sizes.append(len(words))
            spans.append([{"start": x, "end": y} for x, y in own])
            kept.append(b" ".join(rest).decode())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.string())],
            ["n_words", "spans", "kept"],
        )

    return run


def remove_repeated_words(
    docs: DataFrame,
    window: int = 35,
    identity: str = "doc_id",
    text: str = "text",
    gram: int = 4,
    hot_contexts: int = 2000,
    chunk_bytes: int = 1 << 18,
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``spans``, its maximal removed runs of words, and
    ``kept``, the remaining words joined by single spaces.

    Words lie between ASCII white space and stay as they are. A word is removed if a window of
    ``window`` words that covers it also starts anywhere else in ``docs``, the same text
    included; windows do not cross texts and are judged on the input.

    A corpus that is its own reference cannot send all its automata everywhere, so anchors (see
    ``repeats``) bring the contexts that can repeat together, a shard of them gets one suffix
    automaton, and the shard's contexts are streamed through it for their matching statistics.

    Null and empty texts have no words. Rows that repeat a text repeat all its windows. An empty
    table gives an empty result. Columns named as the results are replaced.
    """
    require(docs, identity, text)
    if not 0 < gram <= window or gram & (gram - 1):
        raise ValueError("gram must be a power of two, at most the window")
    rest = [c for c in docs.columns if c.lower() not in {"n_words", "spans", "kept"}]
    method = Method(window, gram, _words, repeated_starts, chunk_bytes, hot_contexts)
    found = with_repeats(docs.select(*[F.col(f"`{c}`") for c in rest]), text, identity, method)
    done = found.select("row", _removal(window)("text", "found").alias("done"))
    return done.select("row.*", "done.n_words", "done.spans", "done.kept")
