"""Dropping lines whose template recurs across documents, by a log-template tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.shared import require, row_key, written

WILD = b"<*>"
_DIGITS = frozenset(b"0123456789")
_PLACES = "k1 long, k2 int, line int, leaf long, exact long, fresh_leaf boolean, fresh boolean"


def masked(line: bytes) -> list[bytes]:
    """Tokens between ASCII white space, those with a digit as wild cards."""
    return [WILD if _DIGITS.intersection(t) else t for t in line.split()]


def _hash(count: int, tokens: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b"%d " % count + b" ".join(tokens)) - (1 << 63)


def leaves(tokens: list[bytes], depth: int) -> tuple[int, int]:
    """Leaf of a line in the tree and its masked self: hashes of its token count with its leading
    tokens, or with all."""
    count = len(tokens)
    return _hash(count, tokens[:depth]), _hash(count, tokens)


def _emit_places(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[tuple] = []
            for row, text in enumerate(batch.column(2)):
                seen: set = set()
                lines = text.as_buffer().to_pybytes().split(b"\n") if text.is_valid else []
                for number, line in enumerate(lines):
                    tokens = masked(line)
                    if not tokens:
                        continue
                    leaf, exact = leaves(tokens, depth)
                    out.append((k1[row], k2[row], number, leaf, exact, (0, leaf) not in seen, (1, exact) not in seen))
                    seen.add((0, leaf))
                    seen.add((1, exact))
                if len(out) > 50_000:
                    yield _places(out)
                    out = []
            if out:
                yield _places(out)

    return run


def _places(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    names = ["k1", "k2", "line", "leaf", "exact", "fresh_leaf", "fresh"]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The masked lines listed for each text."""
    for batch in batches:
        node, exact, lines, held = [], [], [], 0
        for text, wanted in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            own = text.as_buffer().to_pybytes().split(b"\n")
            for place in wanted:
                node.append(place["node"])
                exact.append(place["exact"])
                lines.append(b" ".join(masked(own[place["line"]])))
                held += len(lines[-1])
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(exact), pa.array(lines, pa.binary())], ["node", "exact", "line"]
                )
                node, exact, lines, held = [], [], [], 0
        if node:
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(exact), pa.array(lines, pa.binary())], ["node", "exact", "line"]
            )


class Leaf:
    """A leaf's templates. A line joins the first of those that share most tokens with it, of
    those that share ``similar`` of the tokens that are not wild in both, else it becomes a new
    one. Where a template and its line differ, the template gets a wild card. Wild cards of both
    say nothing, so they neither count as shared nor as differing; a join needs a shared token.

    Only templates are held, never the lines. The first ``direct`` of them are compared with
    every line. Once there are more, a line meets those that hold one of its rarest tokens in
    its place: a template that shares enough has one of any that many, so the result is the same.
    """

    def __init__(self, width: int, similar: float, direct: int):
        self.similar, self.direct = similar, direct
        self.known: dict = {WILD: 0}
        self.templates, self.count = np.zeros((4, width), dtype=np.int32), 0
        self.places: dict = {}  # templates made with a token in a place, once there is an index

    def add(self, line: list[bytes]) -> int:
        """The number of the template that the line joins or becomes."""
        known = self.known
        row = np.array([known.get(t, -1) for t in line], dtype=np.int32)
        if self.count:
            some = None if self.count <= self.direct else self._candidates(row)
            here = self.templates[: self.count] if some is None else self.templates[some]
            same = ((here == row) & (row > 0)).sum(axis=1)
            told = ((here != 0) | (row != 0)).sum(axis=1)
            same[same < self.similar * told] = 0
            best = int(same.argmax()) if len(same) else 0
            if len(same) and same[best]:
                best = best if some is None else int(some[best])
                own = self.templates[best]
                own[own != row] = 0
                return best
        if self.count == len(self.templates):
            self.templates = np.concatenate([self.templates, np.zeros_like(self.templates)])
        self.templates[self.count] = [known.setdefault(t, len(known)) for t in line]
        self.count += 1
        if self.count > self.direct:
            for number in range(self.count - 1 if self.places else 0, self.count):
                self._list(number)
        return self.count - 1

    def _list(self, number: int) -> None:
        for place in enumerate(self.templates[number].tolist()):
            if place[1]:
                self.places.setdefault(place, []).append(number)

    def _candidates(self, row: np.ndarray) -> np.ndarray:
        lists = sorted((self.places.get(p, ()) for p in enumerate(row.tolist()) if p[1]), key=len)
        enough = max(int(np.ceil(self.similar * len(lists) - 1e-9)), 1)
        found = set().union(*lists[: max(len(lists) - enough + 1, 0)])
        return np.array(sorted(found), dtype=np.int64)


def _grow_leaves(similar: float, direct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, last, leaf, named = None, None, None, []
        for batch in batches:
            rows: list[tuple] = []
            for n, e, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = line.split(b" ")
                if n != node:
                    node, last, leaf, named = n, None, Leaf(len(tokens), similar, direct), []
                # Repeated rows of the input give the same line again.
                if e == last:
                    continue
                last, number = e, leaf.add(tokens)
                if number == len(named):
                    named.append(e)
                rows.append((e, n, named[number]))
            if rows:
                yield _template_batch(rows)

    return run


def _template_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["exact", "node", "template"])


def _removal(text: pa.Array, dropped: pa.Array) -> pa.Array:
    kept, sizes, gone = [], [], []
    for value, numbers in zip(text, dropped, strict=True):
        out = set(numbers.as_py()) if numbers.is_valid else set()
        if not value.is_valid:
            kept.append(None)
            sizes.append(0)
            gone.append(0)
            continue
        raw = value.as_buffer().to_pybytes()
        lines = raw.split(b"\n") if raw else []
        kept.append(b"\n".join(x for i, x in enumerate(lines) if i not in out).decode())
        sizes.append(len(lines))
        gone.append(len(out))
    return pa.StructArray.from_arrays(
        [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
        ["n_lines", "n_dropped", "kept"],
    )


def drop_recurring_lines(
    docs: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    min_docs: int = 10,
    depth: int = 3,
    similar: float = 0.7,
    leaf_lines: int = 4000,
) -> DataFrame:
    """Every row of ``docs`` with ``n_lines``, ``n_dropped`` and ``kept``: its text without the
    lines whose template occurs in ``min_docs`` or more rows.

    Lines end at line feeds. A line's tokens, those with a digit as wild cards, are parsed by
    their number and their ``depth`` leading tokens to a leaf of the tree. In a leaf, different
    lines are taken in order of their hashes and join the template that shares most tokens with
    them, at least ``similar`` of those not wild in both, which turns differing fields into wild
    cards. However many tokens hold a digit, the others decide.

    Leaves in fewer than ``min_docs`` rows are done after counting. Lines collapse to one entry
    per masked line before any meet. A leaf is grown by one task, which streams its lines and
    holds its templates; from ``leaf_lines`` templates on it finds them by an index. That changes
    its time and never the result, which is the same rule at every size.

    Lines without tokens are never dropped. A null text stays null and has no lines, an empty
    one has none either. Rows that repeat id and text are rows each. An empty table gives an
    empty result. Columns named as the results are replaced.
    """
    require(docs, identity, text)
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in {"n_lines", "n_dropped", "kept"}]
    packed = docs.select(F.struct(*rest).alias("row"), *row_key(identity, text))
    body = F.col("row").getField(text).alias("text")
    named = packed.select(F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), body)
    places = written(named.mapInArrow(_emit_places(depth), _PLACES), "places")
    often = places.groupBy("leaf").agg(F.sum(F.col("fresh_leaf").cast("int")).alias("rows"))
    often = written(often.where(F.col("rows") >= min_docs).select("leaf"), "leaves")
    places = written(places.join(often, "leaf"), "recurring")
    at = F.min(F.struct("k1", "k2", "line")).alias("at")
    lines = places.groupBy(F.col("leaf").alias("node"), "exact").agg(at)
    listed = lines.groupBy("at.k1", "at.k2").agg(
        F.collect_list(F.struct("node", "exact", "at.line")).alias("wanted")
    )
    # Lists and texts both grow with the corpus, so neither is ever sent to every executor.
    cut = named.join(listed.hint("merge"), ["k1", "k2"]).select("text", "wanted")
    grown = cut.mapInArrow(_cut_lines, "node long, exact long, line binary").repartition("node")
    grown = grown.sortWithinPartitions("node", "exact").mapInArrow(
        _grow_leaves(similar, leaf_lines), "exact long, node long, template long"
    )
    templates = written(grown, "templates")
    marked = places.join(templates, "exact").select("k1", "k2", "line", "fresh", "node", "template", "exact")
    # Rows that repeat id and text are several documents; their lines come once for each.
    once = marked.where("fresh").groupBy("node", "template", "k1", "k2", "exact").agg(F.count("*").alias("n"))
    once = once.groupBy("node", "template", "k1", "k2").agg(F.max("n").alias("n"))
    rows = once.groupBy("node", "template").agg(F.sum("n").alias("rows"))
    recurring = written(rows.where(F.col("rows") >= min_docs).select("node", "template"), "templates")
    dropped = marked.join(recurring, ["node", "template"]).groupBy("k1", "k2").agg(
        F.collect_set("line").alias("dropped")
    )
    dropped = dropped.withColumnsRenamed({"k1": "_k1", "k2": "_k2"})
    joined = packed.join(dropped.hint("merge"), ["_k1", "_k2"], "left")
    done = joined.select(
        "row",
        F.arrow_udf(_removal, "struct<n_lines: bigint, n_dropped: bigint, kept: string>")(
            body, F.col("dropped")
        ).alias("done"),
    )
    return done.select("row.*", "done.*")
