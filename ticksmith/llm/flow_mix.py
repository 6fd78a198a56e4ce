"""Mixing overlapping sources to target weights by min-cost flow."""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.llm.shared import require, written

#: Patterns and their arcs live on the driver; a mix of more is refused.
MAX_ARCS = 200_000
_FAN = 1024
_LEAF_ROWS = 256
_AROUND = 20
_RESULTS = {"taken", "copies"}


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quotas(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Shares of ``total`` by weight, none above ``most`` times its source's size; what is cut
    off is shared among the others by weight until none is above."""
    given: dict = {}
    free, left = dict(weights), total
    while free:
        share = left / sum(free.values())
        full = [s for s, w in free.items() if share * w > most * sizes[s]]
        if not full:
            return given | {s: share * w for s, w in free.items()}
        for s in full:
            given[s] = float(most * sizes[s])
            left -= given[s]
            del free[s]
    return given


def route(capacity: list[float], members: list[list], quota: dict, repeats: int) -> list[dict]:
    """Words each pattern gives to each of its sources: a maximum flow of least cost.

    A pattern may be used ``repeats`` times over, every further time at a higher cost. All cost
    lies on the arcs that feed patterns, so the cheapest augmenting paths are those that use
    the cheapest open level: the levels are opened in order of cost, each filled by shortest
    augmenting paths, which may reroute what earlier levels sent.
    """
    flow: list[dict] = [dict.fromkeys(m, 0.0) for m in members]
    needs = dict(quota)
    users: dict = {s: [] for s in quota}
    for p, sources in enumerate(members):
        for s in sources:
            users[s].append(p)
    tiny = 1e-9 * max([1.0, *quota.values()])
    for _ in range(repeats):
        for p, spare in enumerate(capacity):
            while spare > tiny:
                path, room = _augmenting(p, members, users, flow, needs, tiny)
                if not path:
                    break
                sent = min(spare, room)
                for pattern, source, sign in path:
                    flow[pattern][source] += sign * sent
                needs[path[-1][1]] -= sent
                spare -= sent
    return flow


def _augmenting(start: int, members, users, flow, needs, tiny) -> tuple[list, float]:
    """The shortest path from a pattern to a source that needs words, and its room."""
    came: dict = {}
    seen, queue = {start}, deque([start])
    while queue:
        p = queue.popleft()
        for s in members[p]:
            if s in came:
                continue
            came[s] = p
            if needs[s] > tiny:
                return _traced(s, start, came, flow, needs)
            for other in users[s]:
                if other not in seen and flow[other][s] > tiny:
                    seen.add(other)
                    came[("pattern", other)] = s
                    queue.append(other)
    return [], 0.0


def _traced(source, start: int, came: dict, flow, needs) -> tuple[list, float]:
    path, room = [], needs[source]
    while True:
        p = came[source]
        path.append((p, source, 1))
        if p == start:
            return path[::-1], room
        source = came[("pattern", p)]
        path.append((p, source, -1))
        room = min(room, flow[p][source])


def mix(
    docs: DataFrame,
    sources: Column,
    weights: list[float],
    share: float = 1.5,
    repeats: int = 2,
    identity: str = "doc_id",
    text: str = "text",
    seed: int = 29,
) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` and its plan.

    ``sources`` is an array column: the sources a document belongs to. Sources in order of code
    points, null last, weigh ``weights``, repeating; they share ``share`` times all words, no
    source more than ``repeats`` times its size. Documents are counted by the set of their
    sources (the pattern); a minimum-cost flow routes each pattern's words to source quotas,
    and documents are taken in order of their seeded hashes until the pattern's words are
    reached: first whole rounds, then part of one more. Near the end of that part some
    documents are exchanged so that the sum comes nearer.

    Returns the rows of ``docs`` with ``size`` (words), ``pattern`` and ``taken`` (0 up to
    ``repeats`` times the size), and the plan: ``source``, ``size``, ``target``, ``routed``.
    Columns of these names in ``docs`` are replaced. Patterns and their arcs are planned on
    the driver; more than ``MAX_ARCS`` are refused.

    A null or wordless text has size 0 and is not taken. Rows that repeat an id share their
    fate. No source at all, or null, is the pattern of the null source. An empty table gives
    an empty result and an empty plan.
    """
    require(docs, identity, text)
    known = F.when(F.size(F.coalesce(sources, F.array())) > 0, F.array_sort(F.array_distinct(sources)))
    results = {"size", "pattern", "taken", "repeats_taken"}
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in results]
    sized = docs.select(
        F.struct(*rest).alias("row"),
        word_count(F.col(f"`{text}`")).alias("size"),
        F.coalesce(known, F.array(F.lit(None).cast("string"))).cast("array<string>").alias("pattern"),
        # 53 bits, exact in a double too; rows of one id stand in one place
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(f"`{identity}`")), 11).alias("place"),
    )
    narrow = written(sized.select("size", "pattern", "place"), "sizes")
    found = narrow.groupBy("pattern").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    top = found.limit(MAX_ARCS + 1).collect()
    if sum(len(r.pattern) for r in top) > MAX_ARCS:
        raise ValueError(f"more than {MAX_ARCS} pairs of patterns and sources")
    patterns = sorted(top, key=lambda r: [(s is None, s or "") for s in r.pattern])
    members = [list(r.pattern) for r in patterns]
    sizes: dict = {}
    for row in patterns:
        for s in row.pattern:
            sizes[s] = sizes.get(s, 0) + row["size"]
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weighed = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = share * sum(r["size"] for r in patterns)
    quota = quotas(sizes, weighed, total, repeats) if total else dict.fromkeys(names, 0.0)
    flow = route([float(r["size"]) for r in patterns], members, quota, repeats)

    spark = docs.sparkSession
    wanted = []
    for row, given in zip(patterns, flow, strict=True):
        words = sum(given.values())
        rounds = int(words // row["size"]) if row["size"] else 0
        wanted.append((row.pattern, min(rounds, repeats), words - rounds * row["size"]))
    ends = _ends(
        narrow,
        {tuple(p): part for p, _, part in wanted},
        {tuple(r.pattern): r["rows"] for r in patterns},
    )
    cuts = spark.createDataFrame(
        [(p, rounds, *ends.get(tuple(p), (0, []))) for p, rounds, _ in wanted],
        "pattern array<string>, rounds int, below long, extra array<long>",
    )
    routed = dict.fromkeys(names, 0.0)
    for given in flow:
        for s, words in given.items():
            routed[s] += words
    plan = spark.createDataFrame(
        [(s, int(sizes[s]), float(quota[s]), routed[s]) for s in names],
        "source string, size long, target double, routed double",
    )
    # Patterns are at most MAX_ARCS, and each has at most _LEAF_ROWS places beside its cut.
    mixed = sized.join(F.broadcast(cuts), "pattern")
    once = (F.col("place") < F.col("below")) | F.array_contains("extra", F.col("place"))
    taken = F.col("size") * (F.col("rounds") + F.when(once, 1).otherwise(0))
    return mixed.select("row.*", "size", "pattern", taken.cast("long").alias("taken")), plan


def _ends(narrow: DataFrame, parts: dict, rows: dict) -> dict:
    """For each pattern where its last, partial round ends: all places below the first number
    are in it, and a few listed places beyond.

    Places are cut into equal slices whose words are summed; the slice in which the wanted
    words end is cut again, until it has few places. Every pass reads only the slices in
    question, and never sorts the rows of a pattern.
    """
    spark = narrow.sparkSession
    open_ = {p: (0, 1 << 53, float(part), rows[p]) for p, part in parts.items() if part >= 1}
    done: dict = {}
    leaves = []
    while open_:
        for p, (low, high, need, count) in list(open_.items()):
            if count <= _LEAF_ROWS or high - low == 1:
                leaves.append((list(p), low, high, need))
                done[p] = (low, [])
                del open_[p]
        if not open_:
            break
        table = [
            (list(p), low, max((high - low) // min(_FAN, 2 * count // _LEAF_ROWS), 1), high, need)
            for p, (low, high, need, count) in open_.items()
        ]
        table = spark.createDataFrame(
            table, "pattern array<string>, low long, width long, high long, need double"
        )
        inside = narrow.join(F.broadcast(table), "pattern").where("place >= low and place < high")
        keys = ["pattern", "low", "width", "high", "need"]
        slices = inside.groupBy(*keys, F.expr("(place - low) div width").alias("slice")).agg(
            F.sum("size").alias("words"), F.count("*").alias("rows")
        )
        order = Window.partitionBy("pattern").orderBy("slice")
        upto = slices.withColumn("upto", F.sum("words").over(order))
        # At most one row per pattern.
        ending = upto.where("upto >= need and upto - words < need").collect()
        at = {tuple(r.pattern): r for r in ending}
        for p, (_, high, _, _) in list(open_.items()):
            if p not in at:  # rounding left a little more wanted than there is
                done[p] = (high, [])
                del open_[p]
                continue
            r = at[p]
            start = r.low + r.slice * r.width
            left = r.need - r.upto + r.words
            open_[p] = (start, min(start + r.width, high), left, r.rows)
    if leaves:
        ends = spark.createDataFrame(
            leaves, "pattern array<string>, low long, high long, need double"
        )
        near = narrow.join(F.broadcast(ends), "pattern").where(
            "place >= low and place < high and size > 0"
        )
        near = near.groupBy("pattern", "place", "need").agg(F.sum("size").alias("size"))
        fitted = near.groupBy("pattern").applyInPandas(
            _fitting, "pattern array<string>, place array<long>"
        )
        for r in fitted.collect():
            done[tuple(r.pattern)] = (done[tuple(r.pattern)][0], list(r.place))
    return done


def _fitting(near: pd.DataFrame) -> pd.DataFrame:
    """Places in order until the needed words are near; of the places around the end, those
    whose words together come nearest to what is left."""
    near = near.sort_values("place")
    size, need = near["size"].astype("int64").tolist(), round(float(near["need"].iloc[0]))
    end = int(np.searchsorted(np.cumsum(size), need))
    first, last = max(end - _AROUND, 0), end + _AROUND
    need -= sum(size[:first])
    around = size[first:last]
    # Bit s of sums[i] is set if some of the first i sizes add up to s.
    sums = [1]
    for words in around:
        sums.append(sums[-1] | sums[-1] << words)
    best = _nearest_bit(sums[-1], need)
    inside = list(range(first))
    for i in range(len(around), 0, -1):
        if not sums[i - 1] >> best & 1:
            inside.append(first + i - 1)
            best -= around[i - 1]
    places = near["place"].to_numpy()[sorted(inside)]
    return pd.DataFrame({"pattern": [near["pattern"].iloc[0]], "place": [places]})


def _nearest_bit(bits: int, at: int) -> int:
    below = (bits & ((1 << at + 1) - 1)).bit_length() - 1
    rest = bits >> at + 1
    above = at + (rest & -rest).bit_length() if rest else None
    return below if above is None or at - below <= above - at else above


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows of a mix as often as it takes them, without the mix's own columns."""
    copies = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(0).cast("int")
    rest = [c for c in mixed.columns if c not in {"size", "pattern", "taken"}]
    times = mixed.withColumn("copy_", F.explode(F.array_repeat(F.lit(0), copies)))
    return times.select(*[F.col(f"`{c}`") for c in rest])
