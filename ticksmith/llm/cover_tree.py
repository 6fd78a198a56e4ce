"""A cover tree over vectors of one augmented norm, searched by inner product.

Every vector gets one more component, so that all have the same norm M and lie on a sphere; a
query's extra component is 0, so no inner product changes. A node stands for a ball around one
of its points. Its children's centres lie further apart than the next level's radius and cover
all its points within it. The node keeps the radius that its points really reach, as an angle:
a point within the angle r of a centre at the angle t from the query has an inner product of
at most M|q| cos(t - r) and at least M|q| cos(t + r).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: From a level to the next, radii shrink by this; nodes of no more points than this are leaves.
SHRINK = 1.25
LEAF = 64
#: Leaves that every query takes first, pairs of a query and a point scored together, and points
#: held before only the best are kept.
_FIRST, _PAIRS, _HELD = 32, 1 << 14, 1 << 18
#: What is added to every angle for rounding.
_ALIKE = 1e-7


class Tree(NamedTuple):
    """Points in leaf order; of every node its centre, angle, first and last point, children."""

    points: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    norm: float
    centre: np.ndarray
    angle: np.ndarray
    first: np.ndarray
    last: np.ndarray
    child: np.ndarray  # of every node its first child; 0 for a leaf
    children: np.ndarray  # and how many


def build(points: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Tree:
    """A tree of whole-number points, which later products keep exact."""
    points = points.astype(np.float64)
    squares = (points * points).sum(axis=1)
    norm = float(np.sqrt(squares.max(initial=0.0)))
    whole = np.hstack([points, np.sqrt(np.maximum(norm * norm - squares, 0.0))[:, None]])
    order: list[np.ndarray] = []
    nodes: list[list[float]] = []  # centre, radius, first, last, first child, children
    at = 0

    def away(members: np.ndarray, centre: int) -> np.ndarray:
        gap = whole[members] - whole[centre]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    # Levels of the tree in turn, so that a node's children stand side by side.
    level = [(np.arange(len(points)), 0)] if len(points) else []
    leaves: list[tuple[int, np.ndarray]] = []
    while level:
        below: list[tuple[np.ndarray, int]] = []
        base = len(nodes) + len(level)
        for members, centre in level:
            gaps = away(members, centre)
            radius = float(gaps.max())
            here = len(nodes)
            if len(members) <= LEAF or radius == 0.0:
                nodes.append([centre, radius, 0, 0])
                leaves.append((here, members))
                continue
            nearest, owner, centres = gaps, np.zeros(len(members), dtype=np.int64), [centre]
            while nearest.max() > radius / SHRINK:
                far = int(members[nearest.argmax()])
                gaps = away(members, far)
                closer = gaps < nearest
                owner[closer] = len(centres)
                nearest = np.where(closer, gaps, nearest)
                centres.append(far)
            nodes.append([centre, radius, base + len(below), len(centres)])
            by = np.argsort(owner, kind="stable")
            edges = np.searchsorted(owner[by], np.arange(len(centres) + 1))
            below += [(members[by[a:b]], c) for a, b, c in zip(edges, edges[1:], centres, strict=False)]
        level = below
    firsts, lasts = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
    for here, members in leaves:
        firsts[here], at = at, at + len(members)
        lasts[here] = at
        order.append(members)
    by = np.concatenate(order) if order else np.zeros(0, np.int64)
    table = np.array(nodes, dtype=np.float64).reshape(-1, 4)
    # A chord of the sphere as an angle; a little more, for rounding.
    chord = np.minimum(table[:, 1] / (2 * norm) if norm else table[:, 1] * 0, 1.0)
    return Tree(
        points[by], ids[by], labels[by], norm, points[table[:, 0].astype(np.int64)],
        2 * np.arcsin(chord) + _ALIKE, firsts, lasts, table[:, 2].astype(np.int64), table[:, 3].astype(np.int64),
    )


def _bounds(tree: Tree, nodes: np.ndarray, queries: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the highest inner product that a node's points (row) can have with a query
    (column)."""
    reach = tree.norm * lengths
    low = tree.centre[nodes] @ queries.T
    high = low.copy()
    wide = np.flatnonzero(tree.angle[nodes] > _ALIKE)  # the others hold one point, or copies of it
    if len(wide):
        angle = np.arccos(np.clip(low[wide] / np.where(reach > 0, reach, 1.0), -1.0, 1.0))
        own = tree.angle[nodes[wide]][:, None]
        low[wide] = reach * np.cos(np.minimum(angle + own, np.pi))
        high[wide] = reach * np.cos(np.maximum(angle - own, 0.0))
    slack = 1e-6 * reach
    return low - slack, high + slack


class Best:
    """The best points found for some queries' windows, and what is the least worth finding."""

    def __init__(self, lows: np.ndarray, highs: np.ndarray, count: int):
        self.count, self.highs = count, highs
        self.least = np.array(lows, dtype=np.float64)
        self.kept: list[np.ndarray] = []  # of query, window, id; and of scores
        self.scores: list[np.ndarray] = []
        self.held = 0

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        for window in range(self.highs.shape[1]):
            inside = (scores >= self.least[query, window]) & (scores <= self.highs[query, window])
            if inside.any():
                own = query[inside]
                self.kept.append(np.stack([own, np.full(len(own), window), ids[inside]]))
                self.scores.append(scores[inside])
                self.held += len(own)
        if self.held > _HELD:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray]:
        """Only the best of every window stay, by falling score and then by id; the last of a full
        window raises its least."""
        if not self.kept:
            return np.zeros((3, 0), np.int64), np.zeros(0)
        (query, window, ids), scores = np.concatenate(self.kept, axis=1), np.concatenate(self.scores)
        by = np.lexsort((ids, -scores, window, query))
        query, window, ids, scores = query[by], window[by], ids[by], scores[by]
        group = query * self.highs.shape[1] + window
        first = np.searchsorted(group, group)
        place = np.arange(len(group)) - first
        last = place == self.count - 1
        self.least[query[last], window[last]] = np.maximum(self.least[query[last], window[last]], scores[last])
        stay = place < self.count
        self.kept, self.scores = [np.stack([query, window, ids])[:, stay]], [scores[stay]]
        self.held = int(stay.sum()) if 2 * stay.sum() < _HELD else 0
        return self.kept[0], self.scores[0]


def search(
    tree: Tree, queries: np.ndarray, labels: np.ndarray, same: bool, lows: np.ndarray, highs: np.ndarray, count: int
) -> tuple[np.ndarray, ...]:
    """Query, window, id and score of the best ``count`` points of every window (a column of
    ``lows`` and ``highs``) of each query that have its label, or another one.

    The bounds of a node are no wider than its parent's, and a node none of whose queries has a
    window that it can reach is not opened. Of the leaves left, each query takes those of the
    highest bounds first, a few and then more; a leaf is left out once it can hold no point
    better than the worst of a full window, nor any in a window not yet full.
    """
    best = Best(lows, highs, count)
    queries = queries.astype(np.float64)
    lengths = np.sqrt((queries * queries).sum(axis=1))
    if not len(tree.centre) or not len(queries):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    nodes = np.zeros(1, dtype=np.int64)
    low, high = _bounds(tree, nodes, queries, lengths)
    leaves, bottoms, tops = [], [], []
    while len(nodes):
        wanted = _wanted(best, low, high).any(axis=1)
        nodes, low, high = nodes[wanted], low[wanted], high[wanted]
        leaf = tree.children[nodes] == 0
        leaves.append(nodes[leaf])
        bottoms.append(low[leaf])
        tops.append(high[leaf])
        nodes, low, high = nodes[~leaf], low[~leaf], high[~leaf]
        parent = np.repeat(np.arange(len(nodes)), tree.children[nodes])
        nodes = _ranges(tree.child[nodes], tree.child[nodes] + tree.children[nodes])
        under, over = _bounds(tree, nodes, queries, lengths)
        low, high = np.maximum(under, low[parent]), np.minimum(over, high[parent])
    leaves, low, high = np.concatenate(leaves), np.concatenate(bottoms), np.concatenate(tops)
    left, take = _wanted(best, low, high), _FIRST
    while left.any():
        some = left.any(axis=1)
        leaves, low, high, left = leaves[some], low[some], high[some], left[some]
        now = left
        if len(leaves) > take:
            worth = np.ascontiguousarray(np.where(left, high, -np.inf).T)
            least = np.partition(worth, len(leaves) - take, axis=1)[:, len(leaves) - take]
            now = left & (high >= least)
        own, place = np.nonzero(now.T)
        _verify(tree, leaves[place], own, queries, labels, same, best)
        best.settle()
        left = left & ~now & _wanted(best, low, high)
        take *= 4
    (query, window, ids), scores = best.settle()
    return query, window, ids, scores.astype(np.int64)


def _wanted(best: Best, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether any window of a query (column) can take a point of a node (row)."""
    wanted = np.zeros(low.shape, dtype=bool)
    for least, most in zip(best.least.T, best.highs.T, strict=True):
        wanted |= (high >= least) & (low <= most) & (least <= most)
    return wanted


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    sizes = last - first
    return np.arange(int(sizes.sum())) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


def _verify(tree: Tree, leaves: np.ndarray, own: np.ndarray, queries, labels, same: bool, best: Best) -> None:
    """Take the exact scores of leaves' points for a query each."""
    sizes = tree.last[leaves] - tree.first[leaves]
    ends = np.cumsum(sizes)
    at = 0
    while at < len(leaves):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
        point = _ranges(tree.first[leaves[at:stop]], tree.last[leaves[at:stop]])
        query = np.repeat(own[at:stop], sizes[at:stop])
        fits = (tree.labels[point] == labels[query]) == same
        point, query = point[fits], query[fits]
        best.add(query, tree.ids[point], np.einsum("ij,ij->i", tree.points[point], queries[query]))
        at = stop
