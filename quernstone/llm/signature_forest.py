"""Signature trees over many small blocks of records, joined by dual traversal.

A record is a set of numbered words (see ``functions.textscan``), shown by a bitmap with one bit per
hashed word and by its size.  A node of a tree holds the OR of its records' bitmaps, the range of
their sizes, and the largest ``excess``: a record's size less its set bits.  For a record below node
A and one below node B, the words in common are at most

    min(largest size in A, in B, excess of A + common bits, excess of B + common bits),

and at least ``threshold`` times the larger of the two smallest sizes is needed.  Node pairs that
cannot reach this are dropped with everything below them; record pairs that can are candidates.
The bound never drops a pair that fulfils the threshold.
"""

from __future__ import annotations

import numpy as np

FANOUT = 8
#: So many node pairs are compared at once.
FRONTIER = 200_000
#: Rows and columns of a tile of record pairs.
TILE = (64, 4096)
#: Columns of 64 bits that ``every_pair`` looks at first; together they have less than 256 bits, so that a count fits a byte.
RARE = 3


def needed(size: np.ndarray, threshold: float) -> np.ndarray:
    """Words in common that a pair needs whose longer record has ``size`` words."""
    return np.ceil(threshold * size - 1e-9)


class Level:
    """The nodes of one level of all trees, side by side; a tree's nodes are contiguous."""

    def __init__(self, tree, bits, low, high, excess, first, last):
        self.tree, self.bits, self.low, self.high, self.excess, self.first, self.last = tree, bits, low, high, excess, first, last


def build(tree: np.ndarray, size: np.ndarray, bits: np.ndarray) -> list[Level]:
    """Levels from the records up to one root for each tree.  Rows come sorted by tree and size."""
    size = size.astype(np.int64)
    at = np.arange(len(tree))
    levels = [Level(tree, bits, size, size, size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64), at, at + 1)]
    while len(levels[-1].tree) and (levels[-1].tree[1:] == levels[-1].tree[:-1]).any():
        below = levels[-1]
        new = np.ones(len(below.tree), dtype=bool)
        new[1:] = below.tree[1:] != below.tree[:-1]
        starts = np.flatnonzero(new)
        place = np.arange(len(below.tree)) - np.repeat(starts, np.diff(np.append(starts, len(below.tree))))
        first = np.flatnonzero(place % FANOUT == 0)
        levels.append(
            Level(
                below.tree[first],
                np.bitwise_or.reduceat(below.bits, first, axis=0),
                np.minimum.reduceat(below.low, first),
                np.maximum.reduceat(below.high, first),
                np.maximum.reduceat(below.excess, first),
                first,
                np.append(first[1:], len(below.tree)),
            )
        )
    return levels


def possible(level: Level, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which node pairs may hold a record pair that reaches the threshold."""
    common = np.bitwise_count(level.bits[a] & level.bits[b]).sum(axis=1, dtype=np.int64)
    most = np.minimum(np.minimum(level.high[a], level.high[b]), np.minimum(level.excess[a], level.excess[b]) + common)
    return most >= needed(np.maximum(level.low[a], level.low[b]), threshold)


def children(level: Level, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a child of a and a child of b; within one node each pair once."""
    na, nb = level.last[a] - level.first[a], level.last[b] - level.first[b]
    each = na * nb
    pair = np.repeat(np.arange(len(a)), each)
    k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    x, y = level.first[a][pair] + k // nb[pair], level.first[b][pair] + k % nb[pair]
    keep = (a[pair] != b[pair]) | (x <= y)
    return x[keep], y[keep]


def candidates(tree: np.ndarray, size: np.ndarray, bits: np.ndarray, threshold: float):
    """Yields arrays (a, b) of row numbers, a < b, of record pairs that may reach the threshold."""
    levels = build(tree, size, bits)
    roots = np.arange(len(levels[-1].tree))
    stack = [(len(levels) - 1, roots, roots)]
    while stack:
        depth, a, b = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack += [(depth, a[half:], b[half:]), (depth, a[:half], b[:half])]
            continue
        if depth == 0:
            other = a != b
            a, b = a[other], b[other]
        if not len(a):
            continue
        keep = possible(levels[depth], a, b, threshold)
        a, b = a[keep], b[keep]
        if depth == 0:
            if len(a):
                yield np.minimum(a, b), np.maximum(a, b)
        elif len(a):
            # A node pair has at most FANOUT ** 2 pairs of children.
            step = max(1, FRONTIER // FANOUT)
            for i in range(0, len(a), step):
                stack.append((depth - 1, *children(levels[depth], a[i : i + step], b[i : i + step])))


def every_pair(size_a: np.ndarray, bits_a: np.ndarray, size_b: np.ndarray, bits_b: np.ndarray, threshold: float, same: bool = False):
    """Yields arrays (a, b) of row numbers of all record pairs that may reach the threshold.

    Both sides come sorted by size; ``same`` says that they are one side, whose pairs come once, a < b.  A row of
    bits has RARE columns with the record's rarer words, one column with a bit for each of the commonest words, and
    the rarer words once more, hashed otherwise.  Words in common are at most the commonest ones that both have,
    plus the bound above for the rarer ones, in either form.  The first look compares the RARE columns of a tile's
    pairs and takes all commonest words of a record for shared ones.
    """
    sides = []
    for size, bits in ((size_a.astype(np.int64), bits_a), (size_b.astype(np.int64), bits_b)):
        held = np.bitwise_count(bits)
        rare = size - held[:, RARE]
        excess, again = rare - held[:, :RARE].sum(axis=1, dtype=np.int64), rare - held[:, RARE + 1 :].sum(axis=1, dtype=np.int64)
        least = np.clip(needed(size, threshold).astype(np.int64) - held[:, RARE] - excess, 0, 255).astype(np.uint8)
        sides.append((size, bits, excess, again, np.ascontiguousarray(bits[:, :RARE].T), np.ascontiguousarray(bits[:, RARE]), least))
    (size_a, bits_a, excess_a, again_a, first_a, often_a, least_a), (size_b, bits_b, excess_b, again_b, first_b, often_b, least_b) = sides
    longest = needed(size_b, threshold)
    tile = min(TILE[0], len(size_a)) * min(TILE[1], len(size_b))
    held_both, counted, in_common, fits, fits_b = np.empty(tile, np.uint64), np.empty(tile, np.uint8), np.empty(tile, np.uint8), np.empty(tile, bool), np.empty(tile, bool)
    for i in range(0, len(size_a), TILE[0]):
        end = min(i + TILE[0], len(size_a))
        low = max(int(np.searchsorted(size_b, needed(size_a[i], threshold))), i if same else 0)
        high = int(np.searchsorted(longest, size_a[end - 1], side="right"))
        for j in range(low, high, TILE[1]):
            to = min(j + TILE[1], high)
            both, count, common, keep, keep_b = (x[: (end - i) * (to - j)].reshape(end - i, to - j) for x in (held_both, counted, in_common, fits, fits_b))
            for k in range(RARE):
                np.bitwise_and(first_a[k, i:end, None], first_b[k, None, j:to], out=both)
                if k:
                    np.add(common, np.bitwise_count(both, out=count), out=common)
                else:
                    np.bitwise_count(both, out=common)
            np.greater_equal(common, least_a[i:end, None], out=keep)
            np.logical_and(keep, np.greater_equal(common, least_b[None, j:to], out=keep_b), out=keep)
            found = np.flatnonzero(keep)
            rare = common.reshape(-1)[found].astype(np.int64)
            a, b = np.divmod(found, to - j)
            a, b = a + i, b + j
            if same:
                later = a < b
                a, b, rare = a[later], b[later], rare[later]
            # The commonest words, then the other form of the rarer ones, of the pairs that are left.
            left = needed(np.maximum(size_a[a], size_b[b]), threshold) - np.bitwise_count(often_a[a] & often_b[b])
            some = np.flatnonzero(rare + np.minimum(excess_a[a], excess_b[b]) >= left)
            a, b, left = a[some], b[some], left[some]
            keep = np.bitwise_count(bits_a[a, RARE + 1 :] & bits_b[b, RARE + 1 :]).sum(axis=1, dtype=np.int64) + np.minimum(again_a[a], again_b[b]) >= left
            if keep.any():
                yield a[keep], b[keep]
