"""All pairs of texts that may be alike, by counting shared words of many pairs at once, a bit for each pair.

A text is the sorted list of its words' slots, the rarest first.  Of the texts of a tile, a row of bits for each slot
tells which have a word there.  Two texts that have ``needed`` words in common lack at most ``own = size - needed``
words of either, so of any ``own + n`` words of the one at least n have their slot set in the other.  The
rarest ones are taken, and the rows of bits of their slots are added up, column by column, with carry-save adders
on whole rows: an operation on 64 bits counts for 64 columns.

A column stands for GROUP texts that resemble each other, with the slots of all of them; of the columns that reach
the count the texts' own bitmaps are compared.  Both bounds hold whatever the slots and the order of texts, so no
pair that reaches the threshold is dropped; slots and order only tell how many others are looked at twice.
"""

from __future__ import annotations

import numpy as np

from quernstone.llm.signature_forest import needed

#: Slots of words, and those of them, the first ones, that are shared by hash among words that aren't common.
SLOTS, HASHED = 4096, 512
#: Texts of a column, of a tile, and rows that are added up at once.
GROUP, TILE, ROWS = 4, 8192, 512
#: Words that are counted beyond a text's own ones, at least, and largest count (a power of two, five adders).
BEYOND, COUNTED = 24, 32
#: Bits of a text's own bitmap.
BITS = 1024
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def slots_of(words: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Each word's slot; ``ranks`` has its place among the common ones, the commonest first, and -1 if it isn't common."""
    return np.where((ranks >= 0) & (ranks < SLOTS - HASHED), SLOTS - 1 - ranks, (words >> np.uint64(20)).astype(np.int64) % HASHED)


def packed(sizes: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all lists and where each begins and ends: steps between sorted slots, 255 for each full 255 of a step."""
    row = np.repeat(np.arange(len(sizes)), sizes) * SLOTS
    steps = np.sort(row + slots) - row
    first = np.cumsum(sizes) - sizes
    before = np.append(0, steps[:-1])
    before[first] = 0
    steps -= before
    ends = np.cumsum(steps // 255 + 1)
    out = np.full(ends[-1] if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = steps % 255
    return out, np.append(0, ends[first + sizes - 1])


def unpacked(sizes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Slots of the lists that follow each other in ``code``."""
    sums = np.cumsum(code, dtype=np.int64)[code != 255]
    last = np.cumsum(sizes) - 1
    return sums - np.repeat(np.append(0, sums[last[:-1]]), sizes)


def _bitmaps(sizes: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's bitmap, and its words less its set bits."""
    bits = np.zeros(len(sizes) * BITS, bool)
    bits[np.repeat(np.arange(len(sizes)) * BITS, sizes) + slots % BITS] = True
    bits = np.packbits(bits.reshape(len(sizes), BITS), axis=1, bitorder="little").view(np.uint64)
    return bits, sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


def _alike(sizes: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The texts in an order in which neighbours have many words in common: by the words that about half of them have."""
    half = np.argsort(abs(2 * np.bincount(slots, minlength=SLOTS) - len(sizes)), kind="stable")[:64]
    bit = np.zeros(SLOTS, np.uint64)
    bit[half] = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    return np.argsort(np.bitwise_or.reduceat(bit[slots], np.cumsum(sizes) - sizes), kind="stable")


def _table(sizes: np.ndarray, slots: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each slot the bits of the columns that have it; a last row has all bits."""
    columns = -(-len(sizes) // (64 * GROUP)) * 64
    column = np.empty(len(sizes), np.int64)
    column[order] = np.arange(len(sizes)) // GROUP
    bits = np.zeros((SLOTS + 1) * columns, bool)
    bits[slots * columns + np.repeat(column, sizes)] = True
    bits[SLOTS * columns :] = True
    return np.packbits(bits.reshape(SLOTS + 1, columns), axis=1, bitorder="little").view(np.uint64)


def _blocks(sizes: np.ndarray, code: np.ndarray, at: np.ndarray, threshold: float):
    """Of each ROWS texts, sorted by size: number of the first, sizes, bitmaps, words less bits, and rarest slots by place."""
    blocks = []
    for first in range(0, len(sizes), TILE):
        n = sizes[first : first + TILE]
        slots = unpacked(n, code[at[first] : at[first + len(n)]])
        bits, excess = _bitmaps(n, slots)
        starts = np.cumsum(n) - n
        for i in range(0, len(n), ROWS):
            s = slice(i, i + ROWS)
            place = np.arange(_words(n[s] - needed(n[s], threshold).astype(np.int64)))[:, None]
            # Where a text has no more words, one that all columns have takes their place.
            rarest = np.where(place < n[s], slots[np.minimum(starts[s] + place, len(slots) - 1)], SLOTS).astype(np.uint16)
            blocks.append((first + i, n[s], bits[s], excess[s], rarest))
    return blocks


def _words(own: np.ndarray) -> int:
    """Words to count: the adders take eight at once."""
    return -(-(int(own.max()) + BEYOND) // 8) * 8


class _Adders:
    """Counts bits by column of as many rows of bits as are added; made once, for its buffers."""

    def __init__(self, rows: int, width: int) -> None:
        self.buffers = [np.empty((rows, width), np.uint64) for _ in range(14)]

    @staticmethod
    def _add(low, a, b, high, spare) -> None:
        """low + a + b = low + 2 high; a is lost."""
        np.bitwise_xor(a, b, out=spare)
        np.bitwise_and(a, b, out=high)
        np.bitwise_and(spare, low, out=a)
        np.bitwise_or(high, a, out=high)
        np.bitwise_xor(low, spare, out=low)

    def reached(self, table: np.ndarray, rarest: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Bits of the columns that have at least ``least`` of a row's slots (1 to COUNTED)."""
        x, y, spare, two, too, four, fore, eight, ones, twos, fours, eights, sixteens, over = (b[: len(least)] for b in self.buffers)
        over[:] = 0
        # Counts start at what is missing from COUNTED to ``least``, and run over when that is reached.
        for k, counter in enumerate((ones, twos, fours, eights, sixteens)):
            counter[:] = np.where((COUNTED - least) >> k & 1, _ALL, np.uint64(0))[:, None]
        for r in range(0, len(rarest), 8):
            for half, quads in ((r, four), (r + 4, fore)):
                for k, pair in ((half, two), (half + 2, too)):
                    np.take(table, rarest[k], axis=0, out=x, mode="clip")
                    np.take(table, rarest[k + 1], axis=0, out=y, mode="clip")
                    self._add(ones, x, y, pair, spare)
                self._add(twos, two, too, quads, spare)
            self._add(fours, four, fore, eight, spare)
            np.bitwise_and(eights, eight, out=x)
            np.bitwise_xor(eights, eight, out=eights)
            np.bitwise_and(sixteens, x, out=y)
            np.bitwise_xor(sixteens, x, out=sixteens)
            np.bitwise_or(over, y, out=over)
        return over


def every_pair(size_a: np.ndarray, code_a: np.ndarray, at_a: np.ndarray, size_b: np.ndarray, code_b: np.ndarray, at_b: np.ndarray, threshold: float, same: bool = False):
    """Yields arrays (a, b) of row numbers of all pairs that may reach the threshold.

    Both sides come sorted by size, with their lists as ``packed`` gives them, no text without words; ``same`` says that
    they are one side, whose pairs come once, a < b.
    """
    size_a, size_b = size_a.astype(np.int64), size_b.astype(np.int64)
    blocks, adders = _blocks(size_a, code_a, at_a, threshold), None
    for j in range(0, len(size_b), TILE):
        n = size_b[j : j + TILE]
        slots = unpacked(n, code_b[at_b[j] : at_b[j + len(n)]])
        order = _alike(n, slots)
        table, (bits, excess) = _table(n, slots, order), _bitmaps(n, slots)
        if adders is None or adders.buffers[0].shape[1] != table.shape[1]:
            adders = _Adders(min(ROWS, len(size_a)), table.shape[1])
        for i, sizes, bits_a, excess_a, rarest in blocks:
            if sizes[-1] < needed(n[0], threshold) or needed(sizes[0], threshold) > n[-1] or same and i >= j + len(n):
                continue
            own = sizes - needed(np.maximum(sizes, n[0]), threshold).astype(np.int64)
            words = min(_words(own), len(rarest))
            over = adders.reached(table, rarest[:words], np.minimum(words - own, COUNTED)).reshape(-1)
            some = np.flatnonzero(over)
            at, bit = np.nonzero(np.unpackbits(over[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            a, column = np.divmod(some[at] * 64 + bit, table.shape[1] * 64)
            a, place = np.repeat(a, GROUP), (column[:, None] * GROUP + np.arange(GROUP)).reshape(-1)
            keep = place < len(n)
            a, b = a[keep], order[place[keep]]
            if same:
                later = a + i < b + j
                a, b = a[later], b[later]
            for k in range(0, len(a), 100_000):
                x, y = a[k : k + 100_000], b[k : k + 100_000]
                common = np.bitwise_count(bits_a[x] & bits[y]).sum(axis=1, dtype=np.int64) + np.minimum(excess_a[x], excess[y])
                keep = common >= needed(np.maximum(sizes[x], n[y]), threshold)
                if keep.any():
                    yield x[keep] + i, y[keep] + j
