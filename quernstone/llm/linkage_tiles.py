"""Comparing the candidates of a linkage where they meet, without moving a pair.

Candidates grow with the square of the tables when hub pages, months and names are as many in larger ones,
so pairs are never rows.  Each entity goes to the tiles in which its candidates can be: the months that its
date touches, and its hub pages.  A tile holds some left and some right entities; it joins their block keys,
compares each pair in numpy, and gives only how many pairs answered with each pattern and, for each right
entity and pattern, the left one that is best.  The rest of the order is by confidence, which goes by
pattern, so the best of all is among these.

Every pair belongs to one tile: pairs of another page than a hub to none (they are rows, in proportion to
the tables), pairs of a hub page to the least hub page that both cite, others to the first month that they
have in common.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quernstone.functions import textscan

MONTH, HUB = 0, 1
#: Tiles, beside the months, of left entities with an unknown date, and of right ones.
LEFT_UNKNOWN, RIGHT_UNKNOWN = -1, 0
#: Levels of the voters links, more, less, rare, dates and digits, whose answers make a pattern's number.
LEVELS = (4, 6, 5, 4, 6, 3)
PATTERNS = int(np.prod(LEVELS))
#: Pairs compared at a time, and cells of the table of a batch's left words.
PAIRS, CELLS = 1 << 18, 1 << 24
#: Left entities whose block keys are held at a time.
KEYED = 1 << 15
#: What a tile gives: the best left entity of each right one and pattern, all pairs of the wanted patterns.
BEST, ALL = "best", "all"

#: Where a word's weight, digit and places among the three rarest of its text stand in one number.
_DIGIT, _RIGHT_TOP, _LEFT_TOP = 36, 56, 58


def pattern_levels(patterns: np.ndarray) -> np.ndarray:
    """Rows of levels, in the order of LEVELS."""
    return np.stack(np.unravel_index(patterns, LEVELS), axis=1).astype(np.int64)


def unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit values of all rows of a binary column, and how many each row has."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return np.ascontiguousarray(data).view(np.uint64), np.diff(offsets) // 8


def _whole(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, … of each row, sizes[i] of them."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class _Lists:
    """Values of each row, one row after another."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values, self.sizes = values, sizes.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the given rows, and the place in ``rows`` that each belongs to."""
        sizes = self.sizes[rows]
        return self.values[_spread(self.starts[rows], sizes)], np.repeat(np.arange(len(rows)), sizes)

    def kept(self, keep: np.ndarray, values: np.ndarray | None = None) -> _Lists:
        return _Lists((self.values if values is None else values)[keep], np.bincount(self.rows()[keep], minlength=len(self.sizes)))


class _Side:
    def __init__(self, table: pa.Table) -> None:
        self.n = table.num_rows
        self.ids = _whole(table, "id")
        first = _whole(table, "first")
        self.known = np.asarray(first.is_valid())
        self.first, self.last = (np.asarray(pc.fill_null(c, 0)).astype(np.int64) for c in (first, _whole(table, "last")))
        self.plain, self.hubs = (self._list(_whole(table, c)) for c in ("plain", "hub"))
        self.words = _Lists(*unpack(_whole(table, "words")))
        both, sizes = unpack(_whole(table, "rarest"))
        self.rarest, self.uses = _Lists(both[0::2], sizes // 2), both[1::2].view(np.int64)
        weight = (self.words.values & np.uint64(0x7FFF)).astype(np.int64)
        rows = self.words.rows()
        self.total = np.maximum(np.bincount(rows, weight, self.n), 1e-9)
        order = np.lexsort((-weight, rows))
        self.top = np.zeros(len(rows), bool)
        self.top[order[np.arange(len(rows)) - np.repeat(self.words.starts, self.words.sizes) < 3]] = True
        self.digit = (self.words.values >> np.uint64(15)) & np.uint64(1) == 1
        self.numbers = np.bincount(rows[self.digit], minlength=self.n)
        self.weight = weight

    @staticmethod
    def _list(column: pa.Array) -> _Lists:
        return _Lists(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.asarray(pc.fill_null(pc.list_value_length(column), 0)))

    def rare_words(self, key_words: int) -> _Lists:
        """The rarest words of each text, whether counted or not."""
        at = np.arange(len(self.rarest.values)) - np.repeat(self.rarest.starts, self.rarest.sizes)
        return self.rarest.kept(at < key_words)


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is one of a sorted array."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def _months(days: np.ndarray) -> np.ndarray:
    return days.astype("datetime64[D]").astype("datetime64[M]").astype(np.int64) + 1970 * 12 + 1


class Tile:
    """The candidates of one tile's left and right entities."""

    def __init__(self, kind: int, tile: int, left: pa.Table, right: pa.Table, keys: Callable, key_words: int, margin: int, near: int, more: tuple, less: tuple) -> None:
        """``keys``: (row, key) of a side's word blocks, of the starts, sizes, words and their counts."""
        self.kind, self.tile, self.keys, self.key_words, self.margin, self.near, self.more, self.less = kind, tile, keys, key_words, margin, near, more, less
        self.left, self.right = _Side(left), _Side(right)
        ids = self.left.ids
        self.rank = np.empty(len(ids), np.int64)
        self.rank[np.asarray(pc.sort_indices(ids))] = np.arange(len(ids))
        # Words that one side alone has are never shared.
        a, b = (s.words.values >> np.uint64(16) for s in (self.left, self.right))
        shared = np.intersect1d(a, b)
        self.width = len(shared)
        in_a, in_b = _member(a, shared), _member(b, shared)
        self.left_words = self.left.words.kept(in_a, np.searchsorted(shared, a))
        self.left_marks = np.where(self.left.top[in_a], 2, 1).astype(np.uint8)
        self.right_words = self.right.words.kept(in_b, np.searchsorted(shared, b))
        one = np.int64(1)
        self.right_marks = (self.right.weight + (self.right.digit * (one << _DIGIT)) + (self.right.top * (one << _RIGHT_TOP)) + (one << _LEFT_TOP))[in_b]
        # Of a word that a left text lacks, that it has, and that is among its three rarest.
        self.masks = np.array([0, ~(np.int64(3) << _LEFT_TOP), -1], np.int64)
        self.pages = self._codes(*self._meet(self.left.plain, self.right.plain))
        hubs = np.unique(np.concatenate([self.left.hubs.values, self.right.hubs.values]))
        self.hub_numbers, self.hub_count = hubs, max(1, len(hubs))
        self.left_hubs, self.right_hubs = (_Lists(np.searchsorted(hubs, s.hubs.values), s.hubs.sizes) for s in (self.left, self.right))
        self.right_hub_set = np.sort(self.right_hubs.rows() * self.hub_count + self.right_hubs.values)
        self.left_rare, self.right_rare = (s.rare_words(key_words) for s in (self.left, self.right))
        words = np.unique(self.right_rare.values)
        self.rare_words, self.rare_count = words, max(1, len(words))
        self.right_rare_set = np.sort(self.right_rare.rows() * self.rare_count + np.searchsorted(words, self.right_rare.values))

    def _codes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left * self.right.n + right)

    @staticmethod
    def _meet(left: _Lists, right: _Lists) -> tuple[np.ndarray, np.ndarray]:
        """Rows that have a value in common, once for each."""
        order = np.argsort(right.values, kind="stable")
        values, rows = right.values[order], right.rows()[order]
        begin, end = (np.searchsorted(values, left.values, side=s) for s in ("left", "right"))
        return np.repeat(left.rows(), end - begin), rows[_spread(begin, end - begin)]

    def _batches(self, row: np.ndarray, begin: np.ndarray, end: np.ndarray, target: np.ndarray, once: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (left, right) of left rows, in their order, with ranges of ``target``; ``once``: repeated ones are dropped."""
        most_rows = max(1, CELLS // max(1, self.width))
        some = end > begin
        row, begin, sizes = row[some], begin[some], (end - begin)[some]
        total = np.append(0, np.cumsum(sizes))
        at = 0
        while at < len(row):
            to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, side="right")) - 1)
            to = min(to, int(np.searchsorted(row, row[at] + most_rows)))
            if to < len(row) and once:  # a left row's ranges stay together
                to = int(np.searchsorted(row, row[to])) if row[to] > row[at] else int(np.searchsorted(row, row[at], side="right"))
            pairs = np.repeat(row[at:to], sizes[at:to]), target[_spread(begin[at:to], sizes[at:to])]
            if once:
                code = np.unique(pairs[0] * self.right.n + pairs[1])
                pairs = np.divmod(code, self.right.n)
            for i in range(0, len(pairs[0]), 2 * PAIRS):
                yield pairs[0][i : i + 2 * PAIRS], pairs[1][i : i + 2 * PAIRS]
            at = to

    def _joined(self, parts: Iterator[tuple[np.ndarray, np.ndarray]], right: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs that share a key, once each.  Both sides: (row, key); a left row's keys are all in one part."""
        order = np.argsort(right[1], kind="stable")
        values, rows = right[1][order], right[0][order]
        for row, key in parts:
            order = np.argsort(row, kind="stable")
            row, key = row[order], key[order]
            yield from self._batches(row, *(np.searchsorted(values, key, side=s) for s in ("left", "right")), rows, True)

    def _keyed(self, side: _Side, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of the word blocks of a side's rows from low to high."""
        rarest = side.rarest
        begin, sizes = (int(rarest.starts[low]) if low < side.n else 0), rarest.sizes[low:high]
        some = slice(begin, begin + int(sizes.sum()))
        row, key = self.keys(rarest.starts[low:high] - begin, sizes, rarest.values[some], side.uses[some], self.key_words)
        return row + low, key

    def _near_pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs at most ``near`` days apart, or of an unknown date, once each."""
        a, b = self.left, self.right
        everyone = np.arange(a.n)
        length = np.where(b.known, b.last - b.first, -1)
        for span in np.unique(length):
            rows = np.flatnonzero(length == span)
            rows = rows[np.argsort(b.first[rows], kind="stable")]
            begin, end = np.zeros(a.n, np.int64), np.full(a.n, len(rows))
            if span >= 0:
                first = b.first[rows]
                begin = np.where(a.known, np.searchsorted(first, a.first - self.near - span), begin)
                end = np.where(a.known, np.searchsorted(first, a.last + self.near, side="right"), end)
            yield from self._batches(everyone, begin, end, rows, False)

    def _gap(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Days apart, as ``days_apart`` tells them: 0 too where a date is unknown."""
        a, b = self.left, self.right
        gap = np.maximum(np.maximum(b.first[right] - a.last[left], a.first[left] - b.last[right]), 0)
        return np.where(a.known[left] & b.known[right], gap, 0)

    def _common_hub(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of the least hub page that both cite, or hub_count."""
        values, pair = self.left_hubs.of(left)
        both = _member(right[pair] * self.hub_count + values, self.right_hub_set)
        least = np.full(len(left), self.hub_count)
        np.minimum.at(least, pair[both], values[both])
        return least

    def _share_rare(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        values, pair = self.left_rare.of(left)
        at = np.minimum(np.searchsorted(self.rare_words, values), self.rare_count - 1)
        known = self.rare_words[at] == values if len(self.rare_words) else np.zeros(len(values), bool)
        return np.bincount(pair[known & _member(right[pair] * self.rare_count + at, self.right_rare_set)], minlength=len(left)) > 0

    def _of_hub(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(left, right, links) of the pairs of the tile's hub page."""
        me = int(np.searchsorted(self.hub_numbers, self.tile))
        for far in (False, True):
            rare = [(lists.rows(), lists.values) for lists in (self.left_rare, self.right_rare)]
            for left, right in self._joined(iter(rare[:1]), rare[1]) if far else self._near_pairs():
                keep = np.ones(len(left), bool)
                if far:
                    keep = self._gap(left, right) > self.near
                several = np.flatnonzero(keep & (self.left_hubs.sizes[left] > 1) & (self.right_hubs.sizes[right] > 1))
                keep[several] = self._common_hub(left[several], right[several]) == me
                keep &= ~_member(left * self.right.n + right, self.pages) if len(self.pages) else True
                yield left[keep], right[keep], np.full(int(keep.sum()), 2)

    def _of_month(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(left, right, links) of the pairs of words whose first common month is the tile's."""
        a, b = self.left, self.right
        keyed = (self._keyed(a, low, min(a.n, low + KEYED)) for low in range(0, a.n, KEYED))
        first = _months(a.first), _months(b.first - self.margin)
        unlinked = [s.plain.sizes == 0 for s in (a, b)]
        for left, right in self._joined(keyed, self._keyed(b, 0, b.n)):
            keep = np.ones(len(left), bool)
            if self.tile not in (LEFT_UNKNOWN, RIGHT_UNKNOWN):
                keep = np.maximum(first[0][left], first[1][right]) == self.tile
            keep &= ~_member(left * b.n + right, self.pages) if len(self.pages) else True
            left, right = left[keep], right[keep]
            links = np.where(unlinked[0][left] | unlinked[1][right], 0, 1)
            hub = np.flatnonzero((self.left_hubs.sizes[left] > 0) & (self.right_hubs.sizes[right] > 0))
            hub = hub[self._common_hub(left[hub], right[hub]) < self.hub_count]
            if len(hub):
                links[hub] = 2
                keep = np.ones(len(left), bool)
                keep[hub] = (self._gap(left[hub], right[hub]) > self.near) & ~self._share_rare(left[hub], right[hub])
                left, right, links = left[keep], right[keep], links[keep]
            yield left, right, links

    def _answers(self, left: np.ndarray, right: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pattern, weight (the two shares' sum in millionths) and days apart of each pair."""
        a, b = self.left, self.right
        low, high = int(left.min()), int(left.max()) + 1
        table = np.zeros((high - low) * self.width, np.uint8)
        some = slice(self.left_words.starts[low], self.left_words.starts[high - 1] + self.left_words.sizes[high - 1])
        table[np.repeat(np.arange(high - low) * self.width, self.left_words.sizes[low:high]) + self.left_words.values[some]] = self.left_marks[some]
        sums = np.zeros(len(left), np.int64)
        sizes = self.right_words.sizes[right]
        with_words = np.flatnonzero(sizes)
        for part in np.split(with_words, np.flatnonzero(np.diff(np.cumsum(sizes[with_words]) // (16 * PAIRS))) + 1):
            if not len(part):
                continue
            each = sizes[part]
            at = _spread(self.right_words.starts[right[part]], each)
            cell = np.repeat((left[part] - low) * self.width, each)
            cell += self.right_words.values[at]
            marks = self.masks[table[cell]]
            marks &= self.right_marks[at]
            sums[part] = np.add.reduceat(marks, np.cumsum(each) - each)
        shared = (sums & ((1 << _DIGIT) - 1)).astype(np.float64)
        covered = shared / a.total[left], shared / b.total[right]
        larger, smaller = np.maximum(*covered), np.minimum(*covered)
        more, less = (sum((x >= edge).astype(np.int8) for edge in edges) for x, edges in ((larger, self.more), (smaller, self.less)))
        rare = np.maximum((sums >> _RIGHT_TOP) & 3, (sums >> _LEFT_TOP) & 3)
        found, numbers = (sums >> _DIGIT) & ((1 << (_RIGHT_TOP - _DIGIT)) - 1), b.numbers[right]
        digits = np.where(numbers == 0, 1, np.where(found == numbers, 2, 0))
        gap = self._gap(left, right)
        rough = (gap == 0) & ((a.first != a.last)[left] | (b.first != b.last)[right])
        dates = np.select([rough, gap <= 1, gap <= 7, gap <= 31], [3, 1, 2, 4], 5)
        pattern = links
        for level, n in zip((more, less, rare, dates, digits), LEVELS[1:]):
            pattern = pattern * n + level
        return pattern, np.round(1e6 * (covered[0] + covered[1])).astype(np.int64), gap

    def run(self, wanted: np.ndarray, give: str) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
        """Pairs of each pattern, and (left, right, pattern, weight, apart) of the best or of all pairs of the wanted ones."""
        counts, rows = np.zeros(PATTERNS, np.int64), []
        best = _Best(self.right.n, self.kind == HUB)
        for left, right, links in self._of_hub() if self.kind == HUB else self._of_month():
            if not len(left):
                continue
            pattern, weight, apart = self._answers(left, right, links)
            counts += np.bincount(pattern, minlength=PATTERNS)
            keep = np.flatnonzero(wanted[pattern])
            left, right, pattern, weight, apart = (x[keep] for x in (left, right, pattern, weight, apart))
            if give == ALL:
                rows.append((left, right, pattern, weight, apart))
            else:  # 21 bits of weight, 22 of days, 20 of the left entity's place among the tile's
                best.add(pattern, right, ((2_000_000 - weight) << 42) | (apart << 20) | self.rank[left])
        if give != ALL:
            pattern, right, score = best.rows()
            left = np.argsort(self.rank)[score & ((1 << 20) - 1)]
            rows.append((left, right, pattern, 2_000_000 - (score >> 42), (score >> 20) & ((1 << 22) - 1)))
        return counts, rows


class _Best:
    """The least score of each pattern and right row: in a table where most pairs count, else in a list."""

    def __init__(self, n: int, crowded: bool) -> None:
        self.n, self.crowded = n, crowded
        self.column, self.patterns = np.full(PATTERNS, -1), np.zeros(0, np.int64)
        self.none = np.iinfo(np.int64).max
        self.table = np.zeros((0, n), np.int64)
        self.parts, self.held = [], 0

    def add(self, pattern: np.ndarray, right: np.ndarray, score: np.ndarray) -> None:
        if self.crowded:
            new = np.unique(pattern[self.column[pattern] < 0])
            self.column[new] = len(self.patterns) + np.arange(len(new))
            self.patterns = np.append(self.patterns, new)
            if len(new):
                self.table = np.concatenate([self.table, np.full((len(new), self.n), self.none)])
            np.minimum.at(self.table.reshape(-1), self.column[pattern] * self.n + right, score)
            return
        self.parts.append((pattern * self.n + right, score))
        self.held += len(score)
        if self.held > 8 * PAIRS:
            self._reduce()

    def _reduce(self) -> None:
        if not self.parts:
            return
        group, score = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((score, group))
        group, score = group[order], score[order]
        first = np.ones(len(group), bool)
        first[1:] = group[1:] != group[:-1]
        self.parts, self.held = [(group[first], score[first])], 0

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pattern, right row and least score."""
        if self.crowded:
            at, right = np.nonzero(self.table != self.none)
            return self.patterns[at], right, self.table[at, right]
        self._reduce()
        group, score = self.parts[0] if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return *np.divmod(group, self.n), score


def answers_of(left: pa.Table, right: pa.Table, kind: int, tile: int, wanted: np.ndarray, give: str, schema: pa.Schema, **of) -> pa.Table:
    """Rows of a tile: the pairs that it gives, with n = 0, and a count of each pattern, without ids."""
    if not left.num_rows or not right.num_rows:
        return schema.empty_table()
    tile = Tile(kind, tile, left, right, **of)
    counts, found = tile.run(wanted, give)
    parts = []
    for rows in found:
        ids = [side.ids.take(pa.array(row)) for side, row in zip((tile.left, tile.right), rows)]
        parts.append(pa.table([*ids, *(pa.array(x.astype(np.int32)) for x in rows[2:]), pa.array(np.zeros(len(rows[0]), np.int64))], names=schema.names).cast(schema))
    at = np.flatnonzero(counts)
    nothing = pa.nulls(len(at))
    zero = pa.array(np.zeros(len(at), np.int32))
    parts.append(pa.table([nothing.cast(schema.field(0).type), nothing.cast(schema.field(1).type), pa.array(at.astype(np.int32)), zero, zero, pa.array(counts[at])], names=schema.names).cast(schema))
    return pa.concat_tables(parts)
