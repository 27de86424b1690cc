"""A multiway hyperplane tree that is searched by score windows.

Integer vectors get one more coordinate that makes them all equally long. A query keeps zero
there, so its distance to a vector falls as their inner product rises, and a window of scores is
an annulus around the query. A node has a few split points, each vector belongs to the nearest
one, and the node keeps for every split point the least and the largest distance to the vectors
of every child. A child is left out when, by the triangle inequality from any of the split
points, none of its vectors can lie in a query's annulus. What is left is scored exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

DEGREE = 16
LEAF_ROWS = 192
#: Queries that are looked at together.
QUERY_BLOCK = 512
#: Share of the longest vector by which distances may be wrong from rounding.
SLACK = 1e-5
#: Scores stay below; as a bound it means that there is none.
FAR = 1 << 62
NOTHING = -(1 << 63)


def lift(rows: np.ndarray, longest: int) -> np.ndarray:
    """Rows with the coordinate that brings every squared length to ``longest``."""
    rows = rows.astype(np.float64)
    rest = longest - np.einsum("ij,ij->i", rows, rows)
    return np.concatenate([rows, np.sqrt(np.maximum(rest, 0.0))[:, None]], axis=1)


def distances(products: np.ndarray, lengths: np.ndarray | float, longest: int) -> np.ndarray:
    return np.sqrt(np.maximum(lengths + longest - 2.0 * products, 0.0))


def split_points(points: np.ndarray, degree: int, longest: int) -> np.ndarray:
    """Rows of ``points`` that lie far from each other, picked greedily from a few candidates."""
    step = max(1, len(points) // (3 * degree))
    candidates = points[::step][: 3 * degree]
    nearest = np.full(len(candidates), np.inf)
    chosen: list[int] = []
    at = 0
    while len(chosen) < degree:
        chosen.append(at)
        gap = distances(candidates @ candidates[at], float(longest), longest)
        nearest = np.minimum(nearest, gap)
        at = int(nearest.argmax())
        if nearest[at] <= SLACK * np.sqrt(longest):
            break
    return candidates[chosen]


@dataclass
class Node:
    """Split points, the distance ranges from each of them to each child, and the children:
    numbers of nodes, or of leaves as -1 - leaf."""

    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: list[int] = field(default_factory=list)


class SplitTree:
    """``nodes[0]`` is the root; without nodes there is one leaf, number 0."""

    def __init__(self, longest: int):
        self.longest = longest
        self.nodes: list[Node] = []
        self.leaves = 0

    @classmethod
    def build(cls, points: np.ndarray, longest: int, leaf_rows: int, degree: int = DEGREE):
        """The tree over lifted ``points``, and the rows of each of its leaves."""
        tree, members = cls(longest), []
        tree._grow(points, np.arange(len(points)), leaf_rows, degree, members)
        return tree, members

    def _grow(self, points, rows, leaf_rows, degree, members) -> int:
        centres = points[rows[:0]]
        if len(rows) > leaf_rows:
            centres = split_points(points[rows], degree, self.longest)
        if len(centres) < 2:
            members.append(rows)
            self.leaves += 1
            return -self.leaves
        number = len(self.nodes)
        count = len(centres)
        node = Node(centres, np.full((count, count), np.inf), np.full((count, count), -np.inf))
        self.nodes.append(node)
        child = self._children(node, points[rows])
        for j in range(count):
            node.children.append(self._grow(points, rows[child == j], leaf_rows, degree, members))
        return number

    def _children(self, node: Node, points: np.ndarray) -> np.ndarray:
        """The child of each point; the node's ranges are widened to hold the points."""
        products = points @ node.points.T
        child = products.argmax(axis=1)
        gaps = distances(products, float(self.longest), self.longest)
        for j in np.unique(child).tolist():
            own = gaps[child == j]
            node.low[:, j] = np.minimum(node.low[:, j], own.min(axis=0))
            node.high[:, j] = np.maximum(node.high[:, j], own.max(axis=0))
        return child

    def forget_ranges(self) -> None:
        for node in self.nodes:
            node.low[:], node.high[:] = np.inf, -np.inf

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each lifted point; ranges on its way are widened to hold it."""
        leaf = np.zeros(len(points), np.int64)
        waiting = [(0, np.arange(len(points)))] if self.nodes and len(points) else []
        while waiting:
            number, rows = waiting.pop()
            if number < 0:
                leaf[rows] = -1 - number
                continue
            node = self.nodes[number]
            child = self._children(node, points[rows])
            waiting += [(node.children[j], rows[child == j]) for j in np.unique(child).tolist()]
        return leaf

    def alive(self, node: Node, queries: np.ndarray, near: np.ndarray, far: np.ndarray):
        """(queries, children): may the child hold a vector of one of the query's windows?

        ``queries`` are plain vectors; ``near`` and ``far`` the annuli, (queries, windows).
        """
        out = np.zeros((len(queries), len(node.children)), bool)
        slack = SLACK * np.sqrt(self.longest)
        for start in range(0, len(queries), QUERY_BLOCK):
            part = slice(start, start + QUERY_BLOCK)
            plain = queries[part]
            lengths = np.einsum("ij,ij->i", plain, plain)[:, None]
            to = distances(plain @ node.points[:, :-1].T, lengths, self.longest)[:, :, None]
            least = np.maximum(to - node.high, node.low - to).max(axis=1)
            most = (to + node.high).min(axis=1)
            meets = (least[:, :, None] <= far[part, None, :] + slack) & (
                most[:, :, None] >= near[part, None, :] - slack
            )
            out[part] = meets.any(axis=2)
        return out

    def annuli(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Score windows (queries, windows) as distances; an empty window comes out as nowhere."""
        lengths = np.einsum("ij,ij->i", queries, queries)[:, None]
        near = distances(high.astype(np.float64), lengths, self.longest)
        far = distances(low.astype(np.float64), lengths, self.longest)
        return near, np.where(low > high, -np.inf, far)

    def leaves_of(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray):
        """(query, leaf) pairs that no distance range rules out."""
        everyone = np.flatnonzero((low <= high).any(axis=1))
        if not self.nodes:
            return everyone, np.zeros(len(everyone), np.int64)
        near, far = self.annuli(queries, low, high)
        found: list[tuple[np.ndarray, int]] = []
        waiting = [(0, everyone)]
        while waiting:
            number, rows = waiting.pop()
            if number < 0:
                found.append((rows, -1 - number))
                continue
            node = self.nodes[number]
            meets = self.alive(node, queries[rows], near[rows], far[rows])
            for j, child in enumerate(node.children):
                if meets[:, j].any():
                    waiting.append((child, rows[meets[:, j]]))
        sizes = [len(rows) for rows, _ in found]
        return (
            np.concatenate([rows for rows, _ in found] + [everyone[:0]]),
            np.repeat([leaf for _, leaf in found], sizes).astype(np.int64),
        )


def first_by_score(scores: np.ndarray, fits: np.ndarray, count: int, longest: int):
    """(scores, places) of the ``count`` best fitting entries of each row, best first.

    Among equal scores the earlier place is better. Missing ones have the score NOTHING.
    """
    width = scores.shape[1]
    count = min(count, width)
    place = np.arange(width)
    if longest * width < 2**61:
        key = np.where(fits, scores * width + (width - 1 - place), NOTHING)
        best = np.argpartition(-1 - key, count - 1, axis=1)[:, :count]
        order = np.argsort(-1 - np.take_along_axis(key, best, 1), axis=1)
        best = np.take_along_axis(best, order, 1)
    else:
        ranked = np.where(fits, scores, NOTHING)
        best = np.argsort(-1 - ranked, axis=1, kind="stable")[:, :count]
    kept = np.take_along_axis(np.where(fits, scores, NOTHING), best, 1)
    return kept, best


class Search:
    """The best rows of a set for many queries and score windows; rows come sorted by id."""

    def __init__(self, ids, labels, rows, longest: int, leaf_rows: int = LEAF_ROWS):
        self.ids, self.labels, self.longest = ids, labels, longest
        # Doubles multiply whole numbers exactly as long as no sum leaves 53 bits.
        self.rows = rows.astype(np.float64 if longest < 2**52 else np.int64)
        self.points = lift(rows, longest)
        self.tree, self.members = SplitTree.build(self.points, longest, leaf_rows)

    def best(self, ids, labels, queries, low, high, count: int, same_label: bool):
        """(scores, ids), each (queries, windows, count), of rows other than the query itself.

        ``low`` and ``high`` (queries, windows) are the least and the largest score wanted.
        """
        shape = (*low.shape, count)
        scores, found = np.full(shape, NOTHING, np.int64), np.full(shape, NOTHING, np.int64)
        plain = queries.astype(np.float64)
        low = low.copy()
        root = 0 if self.tree.nodes else -1
        waiting = [(root, np.flatnonzero((low <= high).any(axis=1)))]
        while waiting:
            number, rows = waiting.pop()
            if not len(rows):
                continue
            if number >= 0:
                node = self.tree.nodes[number]
                near, far = self.tree.annuli(plain[rows], low[rows], high[rows])
                meets = self.tree.alive(node, plain[rows], near, far)
                for j, child in enumerate(node.children):
                    waiting.append((child, rows[meets[:, j]]))
                continue
            members = self.members[-1 - number]
            for start in range(0, len(rows) if len(members) else 0, QUERY_BLOCK):
                part = rows[start : start + QUERY_BLOCK]
                product = queries[part].astype(self.rows.dtype) @ self.rows[members].T
                product = product.astype(np.int64)
                allowed = (labels[part][:, None] == self.labels[members]) == same_label
                allowed &= ids[part][:, None] != self.ids[members]
                for w in range(low.shape[1]):
                    fits = allowed & (product >= low[part, w, None])
                    fits &= product <= high[part, w, None]
                    some = np.flatnonzero(fits.any(axis=1))
                    if not len(some):
                        continue
                    mine = part[some]
                    kept, place = first_by_score(product[some], fits[some], count, self.longest)
                    kept = np.concatenate([scores[mine, w], kept], axis=1)
                    who = np.concatenate([found[mine, w], self.ids[members][place]], axis=1)
                    order = np.lexsort((who, -1 - kept), axis=1)[:, :count]
                    scores[mine, w] = np.take_along_axis(kept, order, 1)
                    found[mine, w] = np.take_along_axis(who, order, 1)
                    # A full list leaves only rows that reach its last score.
                    low[mine, w] = np.maximum(low[mine, w], scores[mine, w, -1])
        return scores, found
