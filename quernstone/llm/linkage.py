"""Matching entities across two tables without a common key.

Candidates come from blocks: a link that both cite (a page that very many cite together with compatible
days, or with one of the rarest words), or a few rare words that both use within compatible months.  Voters look at links, words, rare words, numbers and dates of each candidate; the
label model turns their answers into a posterior, and each entity of the right table goes to its most
probable partner.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quernstone.functions import textscan
from quernstone.functions.dates import day_range, days_apart
from quernstone.functions.urls import normalize_url
from quernstone.llm import linkage_tiles as tiles
from quernstone.llm.label_model import LabelModel, State
from quernstone.llm.near_duplicates import LEAST_SHARE
from quernstone.plans.lineage import Cut, cut
from quernstone.plans.reducer import Reducer

#: A page that this many records cite, or this share of them if more, says little by itself.
HUB_RECORDS, HUB_SHARE = 12, 2e-5
WORD_RECORDS = 12
#: Rarest counted words of a text that make blocks, two or three together; uncounted ones all make blocks alone.
KEY_WORDS = 6
#: Rows that two words alone may be expected to meet in before a third joins them.
EXPECTED_ROWS = 0.5
#: Days by which a partner's date may lie outside the months of the other one.
MARGIN_DAYS = 16
#: Days apart up to which a shared hub page alone makes a candidate.
HUB_DAYS = 31
#: Records of a hub page that are brought together with its reports at a time.
PIECE = 2_000
#: Entities of each side that a tile of a hub page or of a month holds, roughly.
TILE = {tiles.HUB: 16_000, tiles.MONTH: 200_000}
CONFIDENT = 0.5
#: Steps of a word's weight, a natural logarithm; 15 bits hold weights below 32.
WEIGHT_STEPS = 1 << 10

#: Edges of the levels of the larger and of the smaller share of words found on the other side.
MORE, LESS = (0.4, 0.6, 0.75, 0.85, 0.93), (0.2, 0.35, 0.55, 0.75)
VOTERS = ["links", "more", "less", "rare", "dates", "digits"]
#: Where learning starts: levels of links are none to compare, none shared, a hub shared, another page
#: shared; of rare, how many of three rarest words the other side has; of dates, unknown, a day apart, a
#: week, rough but compatible, a month, more; of digits, some numbers on the right not on the left, no
#: numbers, all on the left.
#: The states are: retouched text, text told anew with a shared page, other text of the same pattern,
#: unrelated text, an unrelated case's page (whose day then has no reason to agree), unrelated text with the
#: same hub page.  A level that starts at 0 in a state is impossible there.
STATES = [
    State(True, 0.02, [[0.3, 0.2, 0.1, 0.4], [0, 0, 0, 0.1, 0.25, 0.65], [0.02, 0.08, 0.2, 0.3, 0.4], [0.02, 0.1, 0.28, 0.6], [0.1, 0.45, 0.25, 0.15, 0.04, 0.01], [0.1, 0.4, 0.5]]),
    State(True, 0.01, [[0, 0, 0.05, 0.95], [0.3, 0.35, 0.2, 0.1, 0.03, 0.02], [0.4, 0.4, 0.15, 0.04, 0.01], [0.1, 0.5, 0.3, 0.1], [0.1, 0.5, 0.25, 0.14, 0.01, 0], [0.02, 0.88, 0.1]]),
    State(False, 0.1, [[0.4, 0.55, 0.045, 0.005], [0.1, 0.4, 0.4, 0.095, 0.004, 0.001], [0.02, 0.2, 0.55, 0.22, 0.01], [0.3, 0.4, 0.25, 0.05], [0.1, 0.03, 0.17, 0.2, 0.4, 0.1], [0.4, 0.58, 0.02]]),
    State(False, 0.8, [[0.4, 0.6, 0, 0], [0.95, 0.05, 0, 0, 0, 0], [0.7, 0.28, 0.02, 0, 0], [0.8, 0.18, 0.02, 0], [0.1, 0.03, 0.17, 0.2, 0.4, 0.1], [0.55, 0.43, 0.02]]),
    State(False, 0.01, [[0, 0, 0.5, 0.5], [0.8, 0.14, 0.05, 0.01, 0, 0], [0.8, 0.15, 0.04, 0.01, 0], [0.7, 0.24, 0.05, 0.01], [0.15, 0, 0, 0.15, 0.2, 0.5], [0.4, 0.55, 0.05]]),
    State(False, 0.5, [[0, 0, 1, 0], [0.9, 0.08, 0.02, 0, 0, 0], [0.7, 0.28, 0.02, 0, 0], [0.8, 0.18, 0.02, 0], [0.1, 0.03, 0.17, 0.2, 0.4, 0.1], [0.55, 0.43, 0.02]]),
]


def possible_matches() -> np.ndarray:
    """For each pattern whether a match may answer so, by the levels that are impossible in the states."""
    levels = tiles.pattern_levels(np.arange(tiles.PATTERNS))
    return np.any([np.all([np.array(s.tables[v])[levels[:, v]] > 0 for v in range(len(VOTERS))], axis=0) for s in STATES if s.match], axis=0)


def entities(df: DataFrame, id_column: str, text_column: str, date_column: str, urls: Column, order_column: str) -> DataFrame:
    """(id, text, day, urls): one row per id, the one with the greatest order; links normalised."""
    clean = F.array_sort(F.array_distinct(F.filter(F.transform(urls, lambda u: normalize_url(u, keep_value_case=False)), lambda u: u.isNotNull())))
    rows = df.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"),
        F.col(order_column).alias("ord"),
        F.struct(F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"), F.col(date_column).cast("string").alias("written"), F.coalesce(clean, F.array().cast("array<string>")).alias("urls")).alias("v"),
    )
    return rows.groupBy("id").agg(F.max_by("v", F.struct("ord", "v")).alias("v")).select("id", "v.text", day_range(F.col("v.written")).alias("day"), "v.urls")


def _months(side: str, margin: int = MARGIN_DAYS) -> Column:
    """Numbers of the months that an entity's date touches; the right side's with a margin.

    Both sides add 0 where their date is unknown; an entity with a date also answers to 0 of the others.
    """
    number = lambda d: F.year(d) * 12 + F.month(d)
    first, last = F.col("day.first"), F.col("day.last")
    if side == "right":
        first, last = F.date_sub(first, margin), F.date_add(last, margin)
    spans = F.sequence(number(first), number(last))
    return F.when(F.col("day").isNotNull(), F.array_append(spans, F.lit(0) if side == "left" else F.lit(-1))).otherwise(F.array(F.lit(-1), F.lit(0))).alias("months")


def word_keys(starts: np.ndarray, sizes: np.ndarray, words: np.ndarray, records: np.ndarray, n: int, key_words: int = KEY_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Row number and key: each uncounted word alone, and every two of a row's rarest counted words together,
    with a third where the two alone are expected to meet in more than EXPECTED_ROWS of n rows."""
    row = np.repeat(np.arange(len(starts)), sizes)
    order = np.lexsort((words, records, row))
    words, records = words[order], records[order]
    single = records == 0
    rows, keys = [row[single]], [textscan.mix64(words[single])]
    # Uncounted words come first; they take no place from the counted ones.
    place = np.arange(len(words)) - np.repeat(starts + np.bincount(row, single, len(starts)).astype(np.int64), sizes)
    word = np.zeros((len(starts), key_words), np.uint64)
    count = np.full((len(starts), key_words), -1, np.int64)
    top = ~single & (place < key_words)
    word[row[top], place[top]], count[row[top], place[top]] = words[top], records[top]
    who = np.arange(len(starts))
    for i in range(key_words):
        for j in range(i + 1, key_words):
            both = count[:, j] > 0
            key = textscan.mix64(word[:, i] + textscan.mix64(word[:, j]))
            expected = count[:, i] / n * count[:, j]
            fine = both & (expected <= EXPECTED_ROWS)
            rows.append(who[fine])
            keys.append(key[fine])
            for k in range(j + 1, key_words):
                more = both & ~fine & (count[:, k] > 0)
                rows.append(who[more])
                keys.append(textscan.mix64(word[more, k] + textscan.mix64(key[more])))
    return np.concatenate(rows), np.concatenate(keys)


def _count_words(batches):
    for batch in batches:
        found = [np.zeros(0, np.uint64)]
        for first, _, docs, words in textscan.word_bags(batch.column(0).to_pylist()):
            found.append(words)
        words, n = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "records"])


class Words:
    """Counts of the words that many records have; all others count as one."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, records: int) -> None:
        order = np.argsort(words)
        self.words, self.counts, self.records = words[order], counts[order], max(records, 1)

    def look_up(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.counts[at], 0)

    def weights(self, words: np.ndarray) -> np.ndarray:
        return np.log((self.records + 1) / np.maximum(1, self.look_up(words)))


def _salted(keys: np.ndarray, salt: np.ndarray) -> np.ndarray:
    return textscan.mix64(keys + textscan.mix64(salt.astype(np.int64).view(np.uint64)))


def _expand(keys: np.ndarray, rows: np.ndarray, lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Each key once for each number in its row's list."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((x for v in lists for x in v), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    each = sizes[rows]
    at = np.repeat(starts[rows], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    return _salted(np.repeat(keys, each), flat[at]), np.repeat(rows, each)


def _block_rows(common, wanted=None, key_words: int = KEY_WORDS):
    """(key, id) of an entity's blocks.  Rows in: id, text, hashes of plain links, hashes of hub links, months."""

    def run(batches):
        words_of = common.value
        for batch in batches:
            for first in range(0, batch.num_rows, 4_000):
                part = batch.slice(first, 4_000)
                texts, plain, hubs, months = (part.column(i).to_pylist() for i in range(1, 5))
                keys, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for begin, _, docs, words in textscan.word_bags(texts):
                    if not len(docs):
                        continue
                    new = np.ones(len(docs), dtype=bool)
                    new[1:] = docs[1:] != docs[:-1]
                    starts = np.flatnonzero(new)
                    sizes = np.diff(np.append(starts, len(docs)))
                    who = docs[starts] + begin
                    records = words_of.look_up(words)
                    row, key = word_keys(starts, sizes, words, records, words_of.records, key_words)
                    key, row = _expand(key, who[row], months)
                    keys.append(key)
                    rows.append(row)
                    if any(hubs[i] for i in who):
                        order = np.lexsort((words, records, np.repeat(np.arange(len(starts)), sizes)))
                        rare = np.flatnonzero(np.arange(len(words)) - np.repeat(starts, sizes) < key_words)
                        key, row = _expand(words[order][rare], np.repeat(who, sizes)[rare], hubs)
                        keys.append(key)
                        rows.append(row)
                links = np.fromiter((x for v in plain for x in v), np.int64)
                keys.append(textscan.mix64(links.view(np.uint64)))
                rows.append(np.repeat(np.arange(len(plain)), [len(v) for v in plain]).astype(np.int64))
                key, row = np.concatenate(keys), np.concatenate(rows)
                if wanted is not None:
                    keep = wanted.value.may_hold(key)
                    key, row = key[keep], row[keep]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), part.column(0).take(pa.array(row))], names=["key", "id"])

    return run


def rarest_words(texts: list[str], words_of: Words, key_words: int = KEY_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Words and their counts in turn, of each text's uncounted words and rarest counted ones, in the order of word_keys, and how many numbers each text has."""
    docs, words = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for begin, _, d, w in textscan.word_bags(texts):
        docs.append(d + begin)
        words.append(w)
    docs, words = np.concatenate(docs), np.concatenate(words)
    records = words_of.look_up(words)
    order = np.lexsort((words, records, docs))
    docs, words, records = docs[order], words[order], records[order]
    sizes, single = np.bincount(docs, minlength=len(texts)), np.bincount(docs[records == 0], minlength=len(texts))
    keep = np.arange(len(docs)) - np.repeat(np.cumsum(sizes) - sizes + single, sizes) < key_words
    return np.stack([words[keep], records[keep].view(np.uint64)], axis=1).ravel(), 2 * np.bincount(docs[keep], minlength=len(texts))


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((np.append(0, np.cumsum(sizes)) * 8).astype(np.int32)), pa.py_buffer(values.tobytes())])


def _split_links(hubs, common, key_words: int = KEY_WORDS):
    """Rows in: id, text, day, links.  The links apart by whether they are hubs, the text's weighed words, and its rarest ones with their counts."""

    def run(batches):
        pages = hubs.value
        for batch in (whole.slice(i, 4_000) for whole in batches for i in range(0, whole.num_rows, 4_000)):
            links = batch.column(3)
            sizes = np.diff(np.frombuffer(links.buffers()[1], np.int32)[links.offset : links.offset + len(links) + 1])
            flat = links.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(links)), sizes)
            at = np.minimum(np.searchsorted(pages, flat), max(0, len(pages) - 1))
            hub = pages[at] == flat if len(pages) else np.zeros(len(flat), bool)
            lists = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(row[m], minlength=len(links)))).astype(np.int32)), pa.array(flat[m], pa.int64())) for m in (~hub, hub)]
            texts = batch.column(1).to_pylist()
            words = [_binary(*weighed_words(texts, common.value)), _binary(*rarest_words(texts, common.value, key_words))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists, *words], names=["id", "text", "day", "plain", "hub", "words", "rarest"])

    return run


def _hub_pairs(left: DataFrame, right: DataFrame, hubs: DataFrame) -> DataFrame:
    """(right_id, left_id) of all that share a hub page and lie at most HUB_DAYS apart or have an unknown date.

    ``hubs`` is (page, pieces): a page's left entities are dealt out to its pieces, its right ones go to each.
    """
    at = lambda df, side: df.select(F.col("id").alias(f"{side}_id"), F.col("day").alias(f"{side}_day"), _months(side, HUB_DAYS), F.explode("hub").alias("page")).join(F.broadcast(hubs), "page").withColumn("month", F.explode("months"))
    a = at(left, "left").withColumn("piece", F.pmod(F.xxhash64("left_id"), F.col("pieces")).cast("int")).drop("months", "pieces")
    b = at(right, "right").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("months", "pieces")
    gap = days_apart(F.col("left_day"), F.col("right_day"))
    return b.join(a, ["page", "month", "piece"]).where(gap.isNull() | (gap <= HUB_DAYS)).select("right_id", "left_id")


def _has_digit(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the texts, in the order of word_hashes: its text's number and whether it has a digit."""
    codes, starts = textscan.code_points([t.lower() for t in texts])
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = textscan.word_table()[codes]
    edge = np.diff(inside)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    digits = np.concatenate([[0], np.cumsum((codes >= 48) & (codes <= 57))])
    return np.searchsorted(starts, begin, side="right") - 1, digits[end] > digits[begin]


def weighed_words(texts: list[str], words_of: Words) -> tuple[np.ndarray, np.ndarray]:
    """The different words of each text, sorted, as 64-bit values, and how many each text has.

    A value's upper 48 bits are the word's hash, the next tells whether it has a digit, the last 15 are its
    weight in steps of 1 / WEIGHT_STEPS.
    """
    docs, hashes = textscan.word_hashes(texts)
    _, digit = _has_digit(texts)
    # Counts are kept for numbered words; a word's first use has the hash of its upper 51 bits.
    weight = words_of.weights(textscan.mix64(hashes >> np.uint64(13)))
    # A word that the right side uses more often than there are left entities weighs nothing.
    steps = np.clip(np.round(weight * WEIGHT_STEPS), 0, (1 << 15) - 1).astype(np.uint64)
    packed = (hashes & ~np.uint64(0xFFFF)) | (digit.astype(np.uint64) << np.uint64(15)) | steps
    order = np.lexsort((packed, docs))
    docs, packed = docs[order], packed[order]
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (docs[1:] != docs[:-1]) | (packed[1:] != packed[:-1])
    return packed[new], np.bincount(docs[new], minlength=len(texts))


def word_answers(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Columns: levels of the voters more, less, rare and digits, and the two shares' sum in millionths.

    Each side has the weighed words of its texts, one after another, and how many each text has.
    """
    n = len(left[1])
    docs = [np.repeat(np.arange(n), sizes) for _, sizes in (left, right)]
    # Of a pair's words in one row, equal neighbours stand on both sides.
    key = np.concatenate([(d.astype(np.uint64) << np.uint64(48)) | (w >> np.uint64(16)) for d, (w, _) in zip(docs, (left, right))])
    order = np.argsort(key, kind="stable")
    twice = np.flatnonzero(key[order][1:] == key[order][:-1])
    shared = np.zeros(len(key), bool)
    shared[order[twice]] = shared[order[twice + 1]] = True
    both = shared[: len(docs[0])], shared[len(docs[0]) :]
    covered, rare = [], []
    for (words, sizes), doc, here in zip((left, right), docs, both):
        weight = (words & np.uint64(0x7FFF)).astype(np.float64)
        total = np.bincount(doc, weight, n)
        covered.append(np.bincount(doc, weight * here, n) / np.maximum(total, 1e-9))
        order = np.lexsort((-weight, doc))
        place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        top = order[place < 3]
        rare.append(np.bincount(doc[top], here[top], n).astype(np.int64))
    digit = (right[0] >> np.uint64(15)) & np.uint64(1) == 1
    numbers, known = np.bincount(docs[1], digit, n), np.bincount(docs[1], digit & both[1], n)
    levels = [np.digitize(np.maximum(*covered), MORE), np.digitize(np.minimum(*covered), LESS)]
    digits = np.where(numbers == 0, 1, np.where(known == numbers, 2, 0))
    return np.stack([*levels, np.maximum(*rare), digits, np.round(1e6 * sum(covered)).astype(np.int64)], axis=1)


def _answer(batches):
    for batch in batches:
        for first in range(0, batch.num_rows, 8_000):
            part = batch.slice(first, 8_000)
            if part.num_rows:
                found = word_answers(tiles.unpack(part.column(2)), tiles.unpack(part.column(3)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(4), *(pa.array(found[:, i].astype(np.int32)) for i in range(4)), part.column(5), pa.array(found[:, 4].astype(np.int32)), part.column(6)],
                    names=["left_id", "right_id", "links", "more", "less", "rare", "digits", "dates", "weight", "apart"],
                )


class _Prepared:
    """Both sides with their links apart, the counts of common words, and the candidate pairs."""

    def __init__(self, left: DataFrame, right: DataFrame, key_words: int) -> None:
        spark = left.sparkSession
        left, right = cut(left, "left"), cut(right, "right")
        n = left.count()
        text = left.select("text").union(right.select("text"))
        least = max(WORD_RECORDS, int(np.ceil(LEAST_SHARE * n)))
        often = text.mapInArrow(_count_words, "word bigint, records bigint").groupBy("word").agg(F.sum("records").alias("records")).where(F.col("records") >= least).toPandas()
        common = spark.sparkContext.broadcast(Words(often["word"].to_numpy(np.int64).view(np.uint64), often["records"].to_numpy(np.int64), n))

        cited = left.select(F.explode("urls").alias("url")).groupBy("url").count()
        # At most (links per record) / HUB_SHARE pages.
        often_cited = cited.where(F.col("count") >= max(HUB_RECORDS, int(np.ceil(HUB_SHARE * n))))
        pages = Cut(often_cited.select(F.xxhash64("url").alias("page"), F.ceil(F.col("count") / PIECE).cast("int").alias("pieces")), "pages").read()
        # At eight bytes a page they are a broadcast of about a megabyte at most.
        hubs = spark.sparkContext.broadcast(np.sort(pages.toPandas()["page"].to_numpy(np.int64)))

        def hashed(df: DataFrame) -> DataFrame:
            kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select("id", "text", "day").schema)
            return df.select("id", "text", "day", F.transform("urls", lambda u: F.xxhash64(u)).alias("links")).mapInArrow(_split_links(hubs, common, key_words), f"{kinds}, plain array<bigint>, hub array<bigint>, words binary, rarest binary")

        self.left, self.right = Cut(hashed(left), "left").read(), Cut(hashed(right), "right").read()
        self.kinds = {side: df.schema["id"].dataType.simpleString() for side, df in (("left", left), ("right", right))}
        self.key_words, self.pages, self.common, self.records = key_words, pages, common, max(n, 1)

    def pairs(self) -> DataFrame:
        """(left_id, right_id) of all candidates, as rows."""
        left, right, common, kinds, key_words = self.left, self.right, self.common, self.kinds, self.key_words
        of_right = right.select("id", "text", "plain", "hub", _months("right")).mapInArrow(_block_rows(common, None, key_words), f"key bigint, id {kinds['right']}").distinct()
        of_right = Cut(of_right, "blocks").read()
        wanted = left.sparkSession.sparkContext.broadcast(Reducer(of_right, F.col("key"), of_right.count()))
        of_left = left.select("id", "text", "plain", "hub", _months("left")).mapInArrow(_block_rows(common, wanted, key_words), f"key bigint, id {kinds['left']}")
        pairs = of_right.withColumnRenamed("id", "right_id").join(of_left.withColumnRenamed("id", "left_id"), "key").select("left_id", "right_id")
        return pairs.unionByName(_hub_pairs(left, right, self.pages).select("left_id", "right_id")).distinct()

    def page_pairs(self) -> DataFrame:
        """(left_id, right_id) of those that share another page than a hub, which no tile has."""
        sides = [df.select(F.col("id").alias(f"{side}_id"), F.explode("plain").alias("page")) for side, df in (("left", self.left), ("right", self.right))]
        return sides[0].join(sides[1], "page").select("left_id", "right_id").distinct()

    def tiled(self) -> list[DataFrame]:
        """Each side's rows, once for each of its tiles."""
        sides = []
        for side, df in (("left", self.left), ("right", self.right)):
            of_months = F.transform(_tile_months(side), lambda m: F.struct(F.lit(tiles.MONTH).alias("kind"), m.cast("bigint").alias("tile")))
            of_hubs = F.transform("hub", lambda h: F.struct(F.lit(tiles.HUB).alias("kind"), h.alias("tile")))
            rows = df.select("id", F.unix_date("day.first").alias("first"), F.unix_date("day.last").alias("last"), "plain", "hub", "words", "rarest", F.concat(of_months, of_hubs).alias("at"))
            sides.append(rows)
        count = lambda df, name: df.select(F.explode("at").alias("at")).groupBy("at").count().withColumnRenamed("count", name)
        # A row for each month and hub page that both sides have.
        pieces = lambda name: F.ceil(F.col(name) / F.when(F.col("at.kind") == tiles.HUB, TILE[tiles.HUB]).otherwise(TILE[tiles.MONTH])).cast("int").alias(name)
        both = Cut(count(sides[0], "l").join(count(sides[1], "r"), "at").select("at", pieces("l"), pieces("r")), "tiles").read()

        def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
            rows = df.withColumn("at", F.explode("at")).join(F.broadcast(both), "at")
            mine, all_of = F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
            return rows.select("id", "first", "last", "plain", "hub", "words", "rarest", "at.kind", "at.tile", mine, all_of)

        return [dealt(sides[0], "l", "r"), dealt(sides[1], "r", "l")]

    def answers(self, wanted: np.ndarray, give: str = tiles.BEST) -> DataFrame:
        """(left_id, right_id, pattern, weight, apart, n): how many candidates answered with each pattern, where n > 0, and
        where a row has ids, the best left entity of a right one and wanted pattern, or with ``tiles.ALL`` every pair of a wanted one."""
        kinds = self.kinds
        schema = f"left_id {kinds['left']}, right_id {kinds['right']}, pattern int, weight int, apart int, n bigint"
        arrow = to_arrow_schema(StructType.fromDDL(schema))
        of = {"keys": _keys_of(self.records), "key_words": self.key_words, "margin": MARGIN_DAYS, "near": HUB_DAYS, "more": MORE, "less": LESS}

        def compare(key, left, right):
            return tiles.answers_of(left, right, key[0].as_py(), key[1].as_py(), wanted, give, arrow, **of)

        at = ["kind", "tile", "l", "r"]
        left, right = self.tiled()
        in_tiles = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(compare, schema)
        a = self.left.select(F.col("id").alias("left_id"), F.col("words").alias("left_words"), F.col("day").alias("left_day"))
        b = self.right.select(F.col("id").alias("right_id"), F.col("words").alias("right_words"), F.col("day").alias("right_day"))
        gap = days_apart(F.col("left_day"), F.col("right_day"))
        exact = (F.col("left_day.first") == F.col("left_day.last")) & (F.col("right_day.first") == F.col("right_day.last"))
        dates = F.when(gap.isNull(), 0).when(~exact & (gap == 0), 3).when(gap <= 1, 1).when(gap <= 7, 2).when(gap <= 31, 4).otherwise(5)
        joined = self.page_pairs().join(b, "right_id").join(a, "left_id").select("left_id", "right_id", "left_words", "right_words", F.lit(3).alias("links"), dates.alias("dates"), F.coalesce(gap, F.lit(99_999)).alias("apart"))
        of_pages = joined.mapInArrow(_answer, f"left_id {kinds['left']}, right_id {kinds['right']}, links int, more int, less int, rare int, digits int, dates int, weight int, apart int")
        number = F.lit(0)
        for voter, levels in zip(VOTERS, tiles.LEVELS):
            number = number * levels + F.col(voter)
        return in_tiles.unionByName(of_pages.select("left_id", "right_id", number.cast("int").alias("pattern"), "weight", "apart", F.lit(1).cast("bigint").alias("n")))


def _tile_months(side: str) -> Column:
    """The months of an entity's date; the right side's with a margin.  Unknown dates have tiles of their own, to which all of the other side go."""
    unknown = F.array(F.lit(tiles.LEFT_UNKNOWN), F.lit(tiles.RIGHT_UNKNOWN)) if side == "left" else F.array(F.lit(tiles.RIGHT_UNKNOWN))
    months = F.filter(_months(side), lambda m: m > 0)
    return F.when(F.col("day").isNotNull(), F.array_append(months, F.lit(tiles.RIGHT_UNKNOWN if side == "left" else tiles.LEFT_UNKNOWN))).otherwise(unknown)


def _keys_of(records: int):
    return lambda starts, sizes, words, uses, key_words: word_keys(starts, sizes, words, uses, records, key_words)


def candidates(left: DataFrame, right: DataFrame, key_words: int = KEY_WORDS) -> DataFrame:
    """(left_id, right_id) of the pairs that the voters look at."""
    return _Prepared(left, right, key_words).pairs()


def link_entities(left: DataFrame, right: DataFrame, key_words: int = KEY_WORDS, every: bool = False) -> DataFrame:
    """(left_id, right_id, confidence): for each right entity its most probable left one, if confident.

    With ``every`` all confident left ones come, with their ``rank`` from 1 in the order that decides otherwise.
    ``key_words`` is the number of rarest counted words that make blocks; more find pairs whose sides have more
    counted words of their own, at the cost of its cube.  Both sides come from ``entities``.  Equal
    confidence goes to the larger share of words in common, the nearer date, then the smaller id.  Empty texts, unknown dates and missing links leave their voters
    undecided; an empty side gives no rows.
    """
    spark = left.sparkSession
    ready = _Prepared(left, right, key_words)
    # Pairs of patterns that no match can have need not be named; should the model hold one for a match after all, the tiles run again.
    wanted = possible_matches()
    while True:
        answers = Cut(ready.answers(wanted, tiles.ALL if every else tiles.BEST), "answers").read()
        patterns = answers.where("n > 0").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toPandas()
        levels = tiles.pattern_levels(patterns["pattern"].to_numpy(np.int64))
        sure = LabelModel(STATES).fit(levels, patterns["n"].to_numpy(float)).posterior(levels)
        confident = [(int(p), float(c)) for p, c in zip(patterns["pattern"], sure) if c >= CONFIDENT]
        if all(wanted[p] for p, _ in confident):
            break
        wanted[[p for p, _ in confident]] = True
    known = spark.createDataFrame(confident, "pattern int, confidence double")
    likely = answers.where(F.col("right_id").isNotNull()).join(F.broadcast(known), "pattern")
    if every:
        order = Window.partitionBy("right_id").orderBy(F.desc("confidence"), F.desc("weight"), "apart", "left_id")
        return likely.select("left_id", "right_id", "confidence", F.row_number().over(order).alias("rank"))
    best = likely.groupBy("right_id").agg(F.min_by(F.struct("left_id", "confidence"), F.struct(-F.col("confidence"), -F.col("weight"), "apart", "left_id")).alias("best"))
    return best.select("best.left_id", "right_id", "best.confidence")
