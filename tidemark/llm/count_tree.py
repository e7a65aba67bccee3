"""An R-tree over group counts of sets, searched by how much two sets can overlap.

A set's hashes fall into 2^k groups by their leading bits; the counts are its point. Two sets share at
most sum(min(a_g, b_g)) members. A node of the tree keeps the largest count of each group and the sizes
below it, which bounds the overlap with every set below it in the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

LEAF = 48


def needed(a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Smallest intersection of sets of sizes a and b whose Jaccard similarity reaches ``percent``."""
    return -(-percent * (a + b) // (100 + percent))


def groups_for(n: int) -> int:
    """k such that 2^k groups hold one to two members each, 16 groups at least.

    With about one member to a group, members that the sets do not share seldom meet in a group, so
    the bound is close to the overlap itself.
    """
    return max(4, int(max(n, 1)).bit_length() - 1)


def counts(hashes: np.ndarray, k: int) -> np.ndarray:
    return np.bincount((hashes >> np.uint64(64 - k)).astype(np.int64), minlength=1 << k)


def packed(hashes: np.ndarray) -> bytes:
    """The point of a set, two counts to a byte; more groups where a count would not fit."""
    k = groups_for(len(hashes))
    while (c := counts(hashes, k)).max(initial=0) > 15:
        k += 1
    c = c.astype(np.uint8)
    return (c[0::2] << 4 | c[1::2]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    out = np.empty(2 * len(b), np.uint8)
    out[0::2], out[1::2] = b >> 4, b & 15
    return out


def overlap_bound(p: np.ndarray, q: np.ndarray) -> int:
    """Most members that two sets can share, whatever their numbers of groups."""
    width = min(len(p), len(q))
    p, q = (x.reshape(width, -1).sum(1, dtype=np.int64) for x in (p, q))
    return int(np.minimum(p, q).sum())


def folded(points: np.ndarray) -> np.ndarray:
    """Points over half as many groups."""
    return points[:, 0::2].astype(np.uint32) + points[:, 1::2]


class CountTree:
    """Points of one number of groups, packed by halving at the median of the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.root = self._pack(np.arange(len(points)))

    def _pack(self, rows: np.ndarray) -> tuple:
        p, n = self.points[rows], self.sizes[rows]
        corner, low, high = p.max(0), n.min(), n.max()
        if len(rows) <= LEAF:
            return corner, low, high, rows, None
        spread = corner.astype(np.int64) - p.min(0)
        at = int(spread.argmax())
        # Sizes split when they differ more than any coordinate does.
        order = np.argsort(n if high - low > spread[at] else p[:, at], kind="stable")
        half = len(rows) // 2
        return corner, low, high, None, (self._pack(rows[order[:half]]), self._pack(rows[order[half:]]))

    def search(self, point: np.ndarray, size: int, percent: int) -> Iterator[int]:
        """Rows whose set may reach ``percent`` similarity with the given one."""
        least, most = -(-percent * size // 100), 100 * size // percent
        stack = [self.root]
        while stack:
            corner, low, high, rows, children = stack.pop()
            if high < least or low > most or np.minimum(corner, point).sum(dtype=np.int64) < needed(size, max(low, least), percent):
                continue
            if children:
                stack += children
                continue
            n = self.sizes[rows]
            bound = np.minimum(self.points[rows], point).sum(1, dtype=np.int64)
            yield from rows[(n >= least) & (n <= most) & (bound >= needed(size, n, percent))]


def likely_pairs(
    left: list[tuple[np.ndarray, int]], right: list[tuple[np.ndarray, int]], percent: int, asks: Callable[[int], bool] = lambda r: True,
) -> Iterator[tuple[int, int]]:
    """Pairs (row of left, row of right) that may be similar, for the rows of left that ask.

    Points come as (counts, size). Numbers of groups differ by a halving or so; the points of a tree
    are folded to the number of the one that asks, or it is folded to theirs.
    """
    by_width: dict[int, list[int]] = {}
    for s, (p, _) in enumerate(right):
        by_width.setdefault(len(p), []).append(s)
    asking: dict[int, list[int]] = {}
    for r, (p, _) in enumerate(left):
        if asks(r):
            asking.setdefault(len(p), []).append(r)
    for width, some in by_width.items():
        rows, sizes = np.array(some), np.array([right[s][1] for s in some])
        points, trees = np.stack([right[s][0] for s in some]), {}
        for own, askers in asking.items():
            n = [left[r][1] for r in askers]
            if 100 * sizes.max() < percent * min(n) or 100 * max(n) < percent * sizes.min():
                continue
            at = min(own, width)
            if at not in trees:
                folds = points
                while folds.shape[1] > at:
                    folds = folded(folds)
                trees[at] = CountTree(folds, sizes)
            for r in askers:
                point = left[r][0].reshape(at, -1).sum(1, dtype=np.int64).astype(points.dtype if at == own else np.uint32)
                for s in rows[list(trees[at].search(point, left[r][1], percent))]:
                    yield int(r), int(s)
