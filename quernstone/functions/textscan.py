"""Vectorised scanning of text batches on code-point arrays.

Everything here works on a whole batch of strings at once: the batch is laid out as one array of
code points, classified through a lookup table, and cut into runs with array arithmetic.  No loop
runs over characters or words.
"""

from __future__ import annotations

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A chunk holds about this many code points, so that temporaries stay within a few dozen MB.
CHUNK_CODE_POINTS = 1_000_000
CHUNK_TEXTS = 8_192

_tables: dict[str, np.ndarray] = {}


def word_table() -> np.ndarray:
    """True for each code point that is a letter or a digit."""
    if "word" not in _tables:
        _tables["word"] = np.fromiter((chr(i).isalnum() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _tables["word"]


def _powers(base: np.uint64, n: int, name: str) -> np.ndarray:
    have = _tables.get(name)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _tables[name] = np.multiply.accumulate(steps)
    return have[:n]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts joined by line feeds, and where each text starts."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    joined = "\n".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, dtype=np.uint32), starts


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def run_hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of codes[begin:end] for every run, from prefix sums of a polynomial."""
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _powers(_MULTIPLIER, len(codes), "up"), out=sums[1:])
    return mix64((sums[end] - sums[begin]) * _powers(_INVERSE, len(codes) + 1, "down")[begin])


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word of the lower-cased texts, in order of appearance."""
    docs, hashes = [], []
    for first, part in chunks(texts):
        d, h = _word_hashes(part)
        docs.append(d + first)
        hashes.append(h)
    if not docs:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(docs), np.concatenate(hashes)


def word_bags(texts: list[str]):
    """For each chunk of the texts: first text's number, texts, and their numbered words."""
    for first, part in chunks(texts):
        yield first, len(part), *numbered_words(*_word_hashes(part))


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes, starts = code_points([t.lower() for t in texts])
    inside = np.zeros(len(codes) + 2, dtype=np.int8)
    inside[1:-1] = word_table()[codes]
    edge = np.diff(inside)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return np.searchsorted(starts, begin, side="right") - 1, run_hashes(codes, begin, end)


def chunks(texts: list[str]):
    """Slices of about CHUNK_CODE_POINTS each, with the number of their first text."""
    first, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t) + 1
        if total >= CHUNK_CODE_POINTS or i + 1 - first >= CHUNK_TEXTS:
            yield first, texts[first : i + 1]
            first, total = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def numbered_words(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words as set members: a word's second use in a text gets another hash than its first.

    The size of the intersection of two such sets is the number of words two texts have in common,
    counted with repetition.  Rows come back grouped by text.  Takes at most 8,192 texts, whose
    numbers fill the upper 13 bits of one sort key; 51 bits of each hash remain.
    """
    if not len(docs):
        return docs, hashes
    keys = np.sort((docs.astype(np.uint64) << np.uint64(51)) | (hashes >> np.uint64(13)))
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    nth = np.arange(len(keys)) - np.repeat(at, np.diff(np.append(at, len(keys))))
    words = keys & np.uint64((1 << 51) - 1)
    return (keys >> np.uint64(51)).astype(np.int64), mix64(words + nth.astype(np.uint64) * _MULTIPLIER)
