"""Near-duplicate records: a self-join on word overlap through signature trees.

Likeness of two records is the number of words they have in common, counted with repetition, divided
by the number of words of the longer one.  The join runs in stages, each a DataFrame:

1. *Bags.*  Each text becomes a set of numbered words; records with the same set form one class, and
   everything up to the last stage works on classes, so any number of exact copies costs one row.
2. *Pairs.*  Classes are dealt out to pieces by size, and each two pieces whose sizes can be alike meet in a
   task, which counts shared words of all their pairs (``bit_slices.every_pair``); the bound drops no
   pair that reaches the threshold.  Which words are counted depends on how common they are, for the commonest
   tell unrelated texts apart least; the result doesn't depend on it.  Counts of common words are broadcast.
3. *Check.*  The words of the surviving pairs are compared exactly.

Stage 2 grows with the square of the classes.  Without ``exact`` these take its place, which may miss pairs:

* *Blocks.*  Two records of the wanted likeness share one of the first ``size - needed + 1`` words of
  either, in the order of rarity.  Words used by fewer than ``block_rows`` records are rare: each rare word
  in that prefix names a block, so pairs that share a rare word are found whatever else they hold.  Pairs
  that share common words only are looked for in blocks named by several common words together, as many
  as make a block of unrelated records small at the corpus size at hand: by all choices among the words
  that must hold a shared one where a record can have few common words of its own, which finds all, and by
  neighbours among its rarest common words otherwise.  Counts of common words are broadcast; there are at
  most (words per record) / (least share) of them.
* *Signature trees.*  Within a block of two or more classes, a tree of OR-combined bitmaps and size
  ranges is joined with itself by dual traversal (``signature_forest``).
* *Families.*  After the check, classes tied by links, directly or not, form one more block each, so that
  within a family all pairs are found whatever words they share.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import textscan
from quernstone.llm import bit_slices, signature_forest
from quernstone.llm.components import connected_components
from quernstone.plans.lineage import Cut, cut
from quernstone.plans.reducer import Reducer

THRESHOLD = 0.75
#: Rarest common words of a record that name blocks: this many, or this share of its words if more.
COMMON_WORDS, COMMON_SHARE = 12, 0.1
#: Rows that a block of unrelated records may have, by its words' frequencies.
BLOCK_ROWS = 24
EXPECTED_ROWS = 0.5
#: Smallest share of all records from which a word's count is broadcast.
LEAST_SHARE = 2e-5
#: Bits dropped from a key; two blocks that share the other 40 are joined as one, which costs little.
KEY_SHIFT = np.uint64(24)
#: Steps between the common words that are taken together.
STEPS = ((1, 1), (1, 2), (2, 2))
#: Words in a key at most: more would lose edited copies where a large part of all rows resemble each other.
LONGEST_KEY = 4
#: Choices of common words up to which all of them name blocks.
CHOICES = 70
SIGNATURE_BITS = 512
#: A larger block is joined in pieces of this size, each pair of pieces a block of its own.
PIECE_ROWS = 2_000
#: Commonest words, with a bit each, and bits of all other words, in 64-bit columns, in ``ranked_signatures``.
COMMONEST, OTHER_COLUMNS = 64, 8
#: Classes are dealt out to about so many pieces when all meet, of so many rows at least and at most (some 400 bytes each
#: while they are compared, a third of it when they are sent).
#: A class is sent to all pieces of like sizes, so more pieces than keep the cores busy only move more.
PIECES, LEAST_ROWS, MOST_ROWS = 6, 1_000, 400_000
#: Keys of a record, and rows of blocks, by which the width of the shuffles is set, and rows of a task.
KEYS, SHARED, TASK_ROWS = 40, 12, 2_000_000


def _texts(batch: pa.RecordBatch, columns: range) -> list[str]:
    parts = [batch.column(i).to_pylist() for i in columns]
    return [" ".join("" if x is None else x for x in row) for row in zip(*parts)]


def _contents(texts: list[str]) -> np.ndarray:
    """A 64-bit hash of each text."""
    return np.array([int.from_bytes(hashlib.blake2b(t.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True) for t in texts], np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _class_of(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of a set of words, whatever their order."""
    return textscan.mix64(np.add.reduceat(textscan.mix64(words), starts) + np.uint64(1)) if len(starts) else np.zeros(0, np.uint64)


def _bags(texts: list[str]):
    """For each chunk: the numbers of the texts that have words, first word of each, sizes, words, classes."""
    for first, _, docs, words in textscan.word_bags(texts):
        if not len(docs):
            continue
        new = np.ones(len(docs), dtype=bool)
        new[1:] = docs[1:] != docs[:-1]
        starts = np.flatnonzero(new)
        yield docs[starts] + first, starts, np.diff(np.append(starts, len(docs))), words, _class_of(words, starts)


PREPARED = ["id", "ord", "usable", "class", "content", "size", "signature", "word", "records"]


def _prepare(sign: bool):
    """Rows (id, ord, usable, class, content, size, signature) of the records, and of each task rows (word, records)."""

    def run(batches):
        have, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            pending = []
            texts = _texts(batch, range(3, batch.num_columns))
            for rows, _, sizes, words, classes in _bags(texts):
                content = pa.array(_contents([texts[i] for i in rows.tolist()]))
                at, none = pa.array(rows), pa.nulls(len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(at) for i in range(3)), pa.array(_signed(classes)), content, pa.array(sizes.astype(np.int32)), _fixed(_signatures(sizes, words)) if sign else pa.nulls(len(rows), pa.binary()), none, none], names=PREPARED)
                # A class counts once in a task, so that a hot group of copies doesn't make its words common.
                once = np.zeros(len(classes), bool)
                once[np.unique(classes, return_index=True)[1]] = True
                once &= ~np.isin(classes, seen)
                seen = np.concatenate([seen, classes[once]])
                pending.append(np.unique(words[np.repeat(once, sizes)], return_counts=True))
            if pending:
                have, back = np.unique(np.concatenate([have, *(w for w, _ in pending)]), return_inverse=True)
                counts = np.bincount(back, weights=np.concatenate([counts, *(n for _, n in pending)])).astype(np.int64)
            if len(have) > 2_000_000:
                yield _counts(have, counts, batch.schema)
                have, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(have):
            yield _counts(have, counts, batch.schema)

    return run


def _counts(words: np.ndarray, records: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    n = len(words)
    return pa.RecordBatch.from_arrays(
        [*(pa.nulls(n, schema.field(i).type) for i in range(3)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(_signed(words)), pa.array(records)],
        names=PREPARED,
    )


def _at_most(choices: int, longest: int = 64) -> int:
    """Largest number of words of its own for which a record's choices of LONGEST_KEY words stay few."""
    return max((x for x in range(longest) if math.comb(x + LONGEST_KEY, LONGEST_KEY) <= choices), default=-1)


class _Keys:
    """Rows and keys gathered while several common words are put together."""

    def __init__(self, words: np.ndarray, records: np.ndarray, row: np.ndarray, n: int) -> None:
        self.words, self.records, self.row, self.n = words, records, row, n
        self.rows: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []

    def add(self, at: np.ndarray, key: np.ndarray) -> None:
        self.rows.append(self.row[at])
        self.keys.append(key)

    def longer(self, key: np.ndarray, expected: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and expected rows with one more word each."""
        return textscan.mix64(self.words[at] + textscan.mix64(key)), expected * self.records[at] / self.n

    def choices(self, at: np.ndarray, end: np.ndarray, least: np.ndarray) -> None:
        """All choices of words, in order, that are expected to meet in few rows or have LONGEST_KEY words;
        also shorter ones of ``least`` words, as much as the shortest records have in common."""
        key, expected, length = self.words[at], self.records[at].astype(float), 1
        while len(at):
            done = (expected <= EXPECTED_ROWS) | (length == LONGEST_KEY)
            out = done | (length >= least)
            self.add(at[out], key[out])
            more = np.where(done, 0, end - at - 1)
            source = np.repeat(np.arange(len(at)), more)
            at = at[source] + 1 + np.arange(len(source)) - np.repeat(np.cumsum(more) - more, more)
            key, expected = self.longer(key[source], expected[source], at)
            end, least, length = end[source], least[source], length + 1

    def neighbours(self, at: np.ndarray, end: np.ndarray) -> None:
        """Words a few steps apart, until they are expected to meet in few rows or make LONGEST_KEY."""
        for one, two in STEPS:
            last, to, key, expected, length = at, end, self.words[at], self.records[at].astype(float), 1
            while len(last):
                step = one if length == 1 else two
                # Words that run out make a key as they are, unless it is one word only.
                done = (expected <= EXPECTED_ROWS) | (length == LONGEST_KEY) | (last + step >= to)
                if length > 1:
                    self.add(last[done], key[done])
                last, to, key, expected = last[~done] + step, to[~done], key[~done], expected[~done]
                key, expected = self.longer(key, expected, last)
                length += 1


def block_keys(starts: np.ndarray, sizes: np.ndarray, words: np.ndarray, records: np.ndarray, n: int, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Row number and block key; ``records`` has each word's count, 0 if it is below the broadcast ones."""
    row = np.repeat(np.arange(len(starts)), sizes)
    order = np.lexsort((words, records, row))
    words, records = words[order], records[order]
    place = np.arange(len(words)) - np.repeat(starts, sizes)
    needed = signature_forest.needed(sizes, threshold).astype(np.int64)
    own = sizes - needed
    single = np.flatnonzero((place <= own[row]) & (records == 0))
    keys = _Keys(words, records, row, n)
    keys.add(single, textscan.mix64(words[single]))
    rare = np.bincount(row, records == 0, len(starts)).astype(np.int64)
    # Common words that only this record may have, if it shares no rare word with its partner.
    left = own - rare
    whole = (left >= 0) & (left <= _at_most(CHOICES))
    width = np.minimum(np.where(whole, left + LONGEST_KEY, np.maximum(COMMON_WORDS, np.ceil(COMMON_SHARE * sizes).astype(np.int64))), sizes - rare)
    end = starts + rare + np.where(left >= 0, width, 0)
    common = (records > 0) & (np.arange(len(words)) < end[row])
    some, others = np.flatnonzero(common & whole[row]), np.flatnonzero(common & ~whole[row])
    keys.choices(some, end[row[some]], needed[row[some]])
    keys.neighbours(others, end[row[others]])
    return np.concatenate(keys.rows), np.concatenate(keys.keys) >> KEY_SHIFT


def _keys(common, n: int, threshold: float):
    def run(batches):
        words_of, counts_of = common.value
        for batch in batches:
            for _, starts, sizes, words, classes in _bags(_texts(batch, range(batch.num_columns))):
                at = np.minimum(np.searchsorted(words_of, words), max(0, len(words_of) - 1))
                records = np.where(words_of[at] == words, counts_of[at], 0) if len(words_of) else np.zeros(len(words), np.int64)
                row, keys = block_keys(starts, sizes, words, records, n, threshold)
                pairs = np.unique(np.stack([_signed(keys), _signed(classes)[row]], axis=1), axis=0) if len(row) else np.zeros((0, 2), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["key", "class"])

    return run


def _shared_blocks(batches):
    """Of all (key, class) of a partition, those of keys that two or more classes have; big blocks in pieces."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not parts:
        return
    key, cls = (np.concatenate(x) for x in zip(*parts))
    del parts
    order = np.lexsort((cls, key))
    key, cls = key[order], cls[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
    key, cls = key[new], cls[new]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    rows = np.repeat(np.diff(np.append(starts, len(key))), np.diff(np.append(starts, len(key))))
    place = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
    keep = rows > 1
    key, cls, rows, place = key[keep], cls[keep], rows[keep], place[keep]
    pieces = -(-rows // PIECE_ROWS)
    for i in range(0, len(key), 100_000):
        s = slice(i, i + 100_000)
        yield pa.RecordBatch.from_arrays([pa.array(key[s]), pa.array(cls[s]), pa.array((place[s] % pieces[s]).astype(np.int32)), pa.array(pieces[s].astype(np.int32))], names=["key", "class", "piece", "pieces"])


def _signatures(sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A bitmap for each record, with one bit per hashed word."""
    bits = np.zeros((len(sizes), SIGNATURE_BITS // 8), np.uint8)
    slot = (words >> np.uint64(40)).astype(np.int64) % SIGNATURE_BITS
    flat = np.repeat(np.arange(len(sizes)), sizes) * SIGNATURE_BITS + slot
    set_bits = np.zeros(len(sizes) * SIGNATURE_BITS, np.uint8)
    set_bits[flat] = 1
    bits[:] = np.packbits(set_bits.reshape(len(sizes), SIGNATURE_BITS), axis=1, bitorder="little")
    return bits


def ranked_signatures(sizes: np.ndarray, words: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Bitmaps for ``signature_forest.every_pair``; ``ranks`` has each word's place among the common ones, the commonest
    first, and -1 for words that aren't common.  The join counts with ``bit_slices``; this is the plain form to hold it against.

    Common words are dealt to the first columns' bits in turn, so that all bits are set about equally often.
    """
    rare, others = signature_forest.RARE * 64, OTHER_COLUMNS * 64
    width = rare + COMMONEST + others
    row = np.repeat(np.arange(len(sizes)) * width, sizes)
    hashed = (words >> np.uint64(20)).astype(np.int64)
    commonest = (ranks >= 0) & (ranks < COMMONEST)
    first = np.where(commonest, rare + ranks, np.where(ranks < 0, hashed, ranks) % rare)
    set_bits = np.zeros(len(sizes) * width, np.uint8)
    set_bits[row + first] = 1
    set_bits[(row + rare + COMMONEST + (hashed // rare) % others)[~commonest]] = 1
    return np.packbits(set_bits.reshape(len(sizes), width), axis=1, bitorder="little")


def _ranked(common):
    """(class, size, signature) of the texts, with lists of slots by the words' ranks."""

    def run(batches):
        words_of, ranks_of = common.value
        for batch in batches:
            for _, _, sizes, words, classes in _bags(_texts(batch, range(batch.num_columns))):
                at = np.minimum(np.searchsorted(words_of, words), max(0, len(words_of) - 1))
                ranks = np.where(words_of[at] == words, ranks_of[at], -1) if len(words_of) else np.full(len(words), -1)
                code, ends = bit_slices.packed(sizes, bit_slices.slots_of(words, ranks))
                lists = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(code)])
                yield pa.RecordBatch.from_arrays([pa.array(_signed(classes)), pa.array(sizes.astype(np.int32)), lists], names=["class", "size", "signature"])

    return run


def _fixed(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _buffer(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column in one array, and where each begins and ends, in items."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return np.ascontiguousarray(data).view(dtype), (offsets - offsets[0]) // np.dtype(dtype).itemsize


def _join_blocks(threshold: float):
    """Candidate pairs of a partition's blocks.  Rows: key, i, j, piece, class, size, signature."""

    def run(batches):
        parts = [tuple(b.column(i).to_numpy() for i in range(6)) + (_buffer(b.column(6), np.uint64)[0].reshape(-1, SIGNATURE_BITS // 64),) for b in batches if b.num_rows]
        if not parts:
            return
        key, i, j, piece, cls, size, bits = (np.concatenate(x) for x in zip(*parts))
        del parts
        order = np.lexsort((cls, size, j, i, key))
        key, i, j, piece, cls, size, bits = key[order], i[order], j[order], piece[order], cls[order], size[order], bits[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        tree = np.cumsum(new)
        seen = np.zeros((0, 2), np.int64)
        for a, b in signature_forest.candidates(tree, size, bits, threshold):
            across = (i[a] == j[a]) | (piece[a] != piece[b])
            a, b = cls[a[across]], cls[b[across]]
            seen = np.unique(np.concatenate([seen, np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)]), axis=0)
            if len(seen) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(seen[:, 0]), pa.array(seen[:, 1])], names=["a", "b"])
                seen = seen[:0]
        yield pa.RecordBatch.from_arrays([pa.array(seen[:, 0]), pa.array(seen[:, 1])], names=["a", "b"])

    return run


def _word_lists(wanted):
    """(class, words) of the texts whose content may be wanted: 32 bits of each numbered word, sorted."""

    def run(batches):
        for batch in batches:
            texts = _texts(batch, range(batch.num_columns))
            # Texts are told apart before their words are looked for, which costs far more.
            texts = [texts[i] for i in np.flatnonzero(wanted.value.may_hold(_contents(texts))).tolist()]
            for _, _, sizes, words, classes in _bags(texts):
                row = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes) << np.uint64(32)
                short = (np.sort(row | (words >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                ends = (np.append(0, np.cumsum(sizes)) * 4).astype(np.int32)
                lists = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(short.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(_signed(classes)), lists], names=["class", "words"])

    return run


def common_words(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: words in common, words of the longer list."""
    (x, xs), (y, ys) = _buffer(left, np.uint32), _buffer(right, np.uint32)
    nx, ny = np.diff(xs), np.diff(ys)
    row = lambda n: np.repeat(np.arange(len(n), dtype=np.uint64), n) << np.uint64(32)
    both = np.concatenate([row(nx) | x, row(ny) | y])
    both.sort()
    twice = np.flatnonzero(both[1:] == both[:-1])
    return np.bincount((both[twice] >> np.uint64(32)).astype(np.int64), minlength=len(nx)), np.maximum(nx, ny)


def _check(threshold: float):
    def run(batches):
        for whole in batches:
            for first in range(0, whole.num_rows, 2_000):
                batch = whole.slice(first, 2_000)
                common, longer = common_words(batch.column(2), batch.column(3))
                keep = pa.array(np.flatnonzero(common >= signature_forest.needed(longer, threshold)))
                likeness = pa.array(common / np.maximum(longer, 1)).take(keep)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep), likeness], names=["a", "b", "likeness"])

    return run


class NearDuplicates:
    """The join's result: ``members`` (id, class, content, size) and ``classes`` pairs (a, b, likeness)."""

    def __init__(self, members: DataFrame, links: DataFrame) -> None:
        self.members, self.links = members, links

    def pairs(self) -> DataFrame:
        """(id_a, id_b, likeness): pairs of ids, the smaller first.

        Of records with exactly the same text only the first stands in pairs with others, and each of the
        other ones is paired with it; ``copies`` tells which record is the first of each.
        """
        heads = self.members.groupBy("class", "content").agg(F.min("id").alias("head"), F.count("*").alias("texts"))
        star = self.members.join(heads.where("texts > 1"), ["class", "content"]).where("id <> head").select(F.col("head").alias("id_a"), F.col("id").alias("id_b"))
        several = heads.join(heads.groupBy("class").count().where("count > 1").select("class"), "class", "left_semi")
        inside = several.select("class", F.col("head").alias("id_a")).join(several.select("class", F.col("head").alias("id_b")), "class").where("id_a < id_b").select("id_a", "id_b")
        across = (
            self.links.join(heads.select(F.col("class").alias("a"), F.col("head").alias("x")), "a")
            .join(heads.select(F.col("class").alias("b"), F.col("head").alias("y")), "b")
            .select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "likeness")
        )
        return across.unionByName(inside.unionByName(star).withColumn("likeness", F.lit(1.0)))

    def copies(self) -> DataFrame:
        """(id, copy_of, copies): of each record, the first one of exactly its text and how many have it."""
        per_text = self.members.groupBy("class", "content").agg(F.min("id").alias("copy_of"), F.count("*").alias("copies"))
        return self.members.join(per_text, ["class", "content"]).select("id", "copy_of", "copies")

    def edges(self) -> DataFrame:
        """(id_a, id_b) that tie all copies and classes together, at most one row for each record and link."""
        per_class = self.members.groupBy("class").agg(F.min("id").alias("head"), F.count("*").alias("copies"))
        star = self.members.join(per_class.where("copies > 1"), "class").where("id <> head").select(F.col("head").alias("id_a"), F.col("id").alias("id_b"))
        heads = per_class.select("class", "head")
        across = self.links.join(heads.select(F.col("class").alias("a"), F.col("head").alias("x")), "a").join(heads.select(F.col("class").alias("b"), F.col("head").alias("y")), "b")
        return star.union(across.select(F.least("x", "y"), F.greatest("x", "y")))


def _joined_blocks(members_of: DataFrame, signed: DataFrame, threshold: float, width: int) -> DataFrame:
    """Candidate pairs (a, b) of classes that share a block; big blocks are spread over pairs of their pieces."""
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    blocks = (
        members_of.select("key", "class", "piece", other.alias("other"))
        .select("key", "class", "piece", F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j"))
        .join(signed, "class")
        .select("key", "i", "j", "piece", "class", "size", "signature")
    )
    return blocks.repartition(width, "key", "i", "j").mapInArrow(_join_blocks(threshold), "a bigint, b bigint").distinct()


def _pieces(sizes: list[tuple[int, int]], rows: int, threshold: float) -> tuple[list, list]:
    """Of (size, classes) in order: rows (size, first piece, pieces), and rows (piece, [(task, alone)]).

    Neighbouring sizes share a piece of about ``rows`` classes, a frequent one has several.  Each two pieces whose
    sizes can be alike have a task, and each piece has one of its own.
    """
    dealt, ranges, filled = [], [], rows
    for size, classes in sizes:
        several = max(1, -(-classes // rows))
        if several > 1 or filled + classes > rows:
            first, filled = len(ranges), rows if several > 1 else 0
            ranges += [[size, size] for _ in range(several)]
        filled += classes
        ranges[-1][1] = size
        dealt.append((size, first, several))
    low, high = np.array(ranges, np.int64).reshape(-1, 2).T
    meets, task = [[] for _ in ranges], 0
    for i in range(len(ranges)):
        for j in i + np.flatnonzero(high[i] >= signature_forest.needed(np.maximum(low[i], low[i:]), threshold)):
            for piece in {i, int(j)}:
                meets[piece].append((task, i == int(j)))
            task += 1
    return dealt, list(enumerate(meets))


def _meet(threshold: float):
    """Candidate pairs of a partition's tasks.  Rows: task, alone, piece, class, size, signature."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        task, alone, piece, cls, size = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(5))
        order = np.lexsort((size, piece, task))
        task, alone, piece, cls, size = task[order], alone[order], piece[order], cls[order], size[order]
        lists = pa.concat_arrays([b.column(5) for b in held]).take(pa.array(order))
        del held
        code, at = _buffer(lists, np.uint8)
        edges = np.flatnonzero(np.diff(task, prepend=-1, append=-1))
        for first, end in zip(edges[:-1], edges[1:]):
            to = end if alone[first] else first + int(np.searchsorted(piece[first:end], piece[end - 1]))
            start = first if alone[first] else to
            for a, b in bit_slices.every_pair(size[first:to], code, at[first : to + 1], size[start:end], code, at[start : end + 1], threshold, bool(alone[first])):
                a, b = cls[first + a], cls[start + b]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return run


def _every_pair(signed: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """All candidate pairs (a, b) of classes, each once; ``signed`` and ``classes`` hold the same ones."""
    spark = signed.sparkSession
    # One row for each size that a text has.
    sizes = [tuple(r) for r in classes.groupBy("size").count().orderBy("size").collect()]
    rows = min(MOST_ROWS, max(LEAST_ROWS, -(-sum(n for _, n in sizes) // PIECES)))
    dealt, meets = _pieces(sizes, rows, threshold)
    tasks = 1 + max((task for _, m in meets for task, _ in m), default=0)
    dealt = spark.createDataFrame(dealt, "size int, first int, several int")
    meets = spark.createDataFrame(meets, "piece int, meets array<struct<task int, alone boolean>>")
    placed = signed.join(F.broadcast(dealt), "size").withColumn("piece", (F.col("first") + F.pmod(F.xxhash64("class"), F.col("several"))).cast("int"))
    return (
        placed.join(F.broadcast(meets), "piece")
        .select(F.explode("meets").alias("m"), "piece", "class", "size", "signature")
        .select("m.task", "m.alone", "piece", "class", "size", "signature")
        .repartitionById(tasks, "task")
        .mapInArrow(_meet(threshold), "a bigint, b bigint")
    )


def _checked(candidates: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """The candidates that reach the threshold, by their words, with their likeness."""
    both = candidates.join(lists.select(F.col("class").alias("a"), F.col("words").alias("words_a")), "a").join(lists.select(F.col("class").alias("b"), F.col("words").alias("words_b")), "b")
    return cut(both.select("a", "b", "words_a", "words_b").mapInArrow(_check(threshold), "a bigint, b bigint, likeness double"), "links")


def near_duplicates(
    df: DataFrame,
    id_column: str,
    text_columns: list[str],
    order_column: str | None = None,
    usable: Column | None = None,
    threshold: float = THRESHOLD,
    block_rows: int = BLOCK_ROWS,
    complete: bool = True,
    exact: bool = True,
) -> NearDuplicates:
    """Finds pairs of different ids whose likeness is at least ``threshold`` (0.5 to 1).

    A null text counts as empty.  Several rows of one id count once, the one with the greatest
    ``order_column`` (null is least; a tie goes to the larger class hash).  Rows that have a null id or no
    word take no part, nor do ids whose row is not ``usable``.  Columns other than those named are ignored,
    whatever their names.  An empty table gives empty results.

    All pairs are found, at a cost that grows with the square of the different texts; the README gives figures.
    Without ``exact`` pairs that share only common words, and of which each side can have more than a few
    common words that the other lacks, are found if they share neighbouring ones among their rarest; then
    ``complete`` adds a last round within families, which isn't needed where only the groups matter.
    """
    spark = df.sparkSession
    df = df.where(F.col(id_column).isNotNull())
    order = F.col(order_column) if order_column else F.lit(None).cast("int")
    text = df.select(*(F.col(c).cast("string").alias(f"text_{i}") for i, c in enumerate(text_columns)))
    use = F.lit(True) if usable is None else F.coalesce(usable, F.lit(False))
    kept = df.select(F.col(id_column).alias("id"), order.alias("ord"), use.alias("usable"), *(F.col(c).cast("string").alias(f"text_{i}") for i, c in enumerate(text_columns)))
    types = {f.name: f.dataType.simpleString() for f in kept.schema}

    prepared = Cut(kept.mapInArrow(_prepare(not exact), f"id {types['id']}, ord {types['ord']}, usable boolean, class bigint, content bigint, size int, signature binary, word bigint, records bigint"), "bags").read()
    records = prepared.where("class IS NOT NULL")
    members = records.groupBy("id").agg(F.max_by(F.struct("class", "content", "size", "usable"), F.struct("ord", "class", "content")).alias("m")).where("m.usable").select("id", "m.class", "m.content", "m.size")
    members = cut(members, "members")

    n = records.count()
    least = max(block_rows, math.ceil(LEAST_SHARE * n))
    often = prepared.where("word IS NOT NULL").groupBy("word").agg(F.sum("records").alias("records")).where(F.col("records") >= least).toPandas()
    words, counts = often["word"].to_numpy(np.int64).view(np.uint64), often["records"].to_numpy(np.int64)
    order_of = np.argsort(words)
    words, counts = words[order_of], counts[order_of]
    wanted_classes = members.select("class", "size").distinct()
    if exact:
        ranks = np.empty(len(words), np.int64)
        ranks[np.argsort(-counts, kind="stable")] = np.arange(len(words))
        ranked = text.mapInArrow(_ranked(spark.sparkContext.broadcast((words, ranks))), "class bigint, size int, signature binary")
        signed = ranked.join(wanted_classes.select("class"), "class", "left_semi").groupBy("class").agg(F.first("size").alias("size"), F.first("signature").alias("signature"))
        candidates = Cut(_every_pair(signed, wanted_classes, threshold), "candidates").read()
    else:
        signed = records.join(wanted_classes.select("class"), "class", "left_semi").groupBy("class").agg(F.first("size").alias("size"), F.first("signature").alias("signature"))
        common = spark.sparkContext.broadcast((words, counts))
        keys = text.mapInArrow(_keys(common, max(n, 1), threshold), "key bigint, class bigint")
        at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        width = lambda rows: max(at_least, math.ceil(rows / TASK_ROWS))
        shared = keys.repartition(width(n * KEYS), "key").mapInArrow(_shared_blocks, "key bigint, class bigint, piece int, pieces int")
        joined = lambda members_of: _joined_blocks(members_of, signed, threshold, width(n * SHARED * 4))
        candidates = Cut(joined(shared), "candidates").read()

    ends = candidates.select(F.col("a").alias("class")).union(candidates.select(F.col("b").alias("class"))).distinct()
    wanted = spark.sparkContext.broadcast(Reducer(members.join(ends, "class", "left_semi").select("content"), F.col("content"), n))
    lists = text.mapInArrow(_word_lists(wanted), "class bigint, words binary").dropDuplicates(["class"]).join(ends, "class", "left_semi")
    lists = cut(lists, "words")
    links = _checked(candidates, lists, threshold)
    if exact or not complete:
        return NearDuplicates(members, links)
    # Families: classes tied by links meet once more as a block of their own, so that no pair in a family
    # depends on which rare words it shares.
    family = connected_components(links)
    sizes = family.groupBy("group_id").count().where("count > 2").withColumn("pieces", F.ceil(F.col("count") / PIECE_ROWS).cast("int"))
    again = family.join(sizes, "group_id").select(F.col("group_id").alias("key"), F.col("id").alias("class"), F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int").alias("piece"), "pieces")
    more = joined(again).join(candidates, ["a", "b"], "left_anti")
    return NearDuplicates(members, links.unionByName(_checked(more, lists, threshold)))
