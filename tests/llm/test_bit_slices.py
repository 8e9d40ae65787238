import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.functions import textscan
from quernstone.llm import bit_slices
from quernstone.llm.components import ties_of_values


def _listed(sets: list[set], ranked: int):
    """Sizes and packed lists of sets of numbers, of which those below ``ranked`` are common words' ranks."""
    size = np.array([len(s) for s in sets])
    words = np.concatenate([sorted(s) for s in sets])
    return size, *bit_slices.packed(size, bit_slices.slots_of(textscan.mix64(words.astype(np.uint64)), np.where(words < ranked, words, -1)))


def test_lists_are_packed_and_unpacked():
    size, slots = np.array([4, 1, 3, 2]), np.array([4095, 0, 255, 254, 4095, 510, 510, 3, 0, 0])
    code, at = bit_slices.packed(size, slots)
    assert bit_slices.unpacked(size, code).tolist() == [0, 254, 255, 4095, 4095, 3, 510, 510, 0, 0]
    assert bit_slices.unpacked(size[1:3], code[at[1] : at[3]]).tolist() == [4095, 3, 510, 510]


@pytest.mark.parametrize(("least", "most", "vocabulary", "ranked"), [(40, 200, 3_000, 2_500), (1, 12, 60, 40), (60, 90, 400, 0), (100, 400, 9_000, 9_000)])
def test_no_pair_is_left_out(monkeypatch, least, most, vocabulary, ranked):
    """Small tiles, so that pairs lie within and across columns, blocks and tiles; few words, hashed words, long texts."""
    for name, value in (("TILE", 64), ("ROWS", 16)):
        monkeypatch.setattr(bit_slices, name, value)
    rng = random.Random(least)
    sets = []
    for _ in range(130):
        base = {min(int(rng.expovariate(8 / vocabulary)), vocabulary - 1) for _ in range(rng.randint(least, most))}
        sets.append(base)
        for share in rng.sample((0.1, 0.2, 0.24, 0.26, 0.3), 2):
            kept = {x for x in base if rng.random() > share}
            sets.append(kept | {rng.randrange(vocabulary) for _ in range(rng.randint(0, len(base) // 4))} or {0})
    sets.sort(key=len)
    size, code, at = _listed(sets, ranked)
    want = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if len(sets[i] & sets[j]) >= 0.75 * max(len(sets[i]), len(sets[j]))}
    pairs = [(int(x), int(y)) for a, b in bit_slices.every_pair(size, code, at, size, code, at, 0.75, True) for x, y in zip(a, b)]
    assert len(want) >= 20 and want <= set(pairs) and len(set(pairs)) == len(pairs)
    half = len(sets) // 2
    across = [(int(x), int(y) + half) for a, b in bit_slices.every_pair(size[:half], code, at[: half + 1], size[half:], code, at[half:], 0.75) for x, y in zip(a, b)]
    assert sorted(across) == sorted((x, y) for x, y in pairs if x < half <= y)


def test_columns_count_exactly():
    rng = np.random.default_rng(3)
    table = np.concatenate([rng.integers(0, 2**63, (60, 2)).astype(np.uint64), np.full((1, 2), 2**64 - 1, np.uint64)])
    rarest, least = rng.integers(0, 61, (40, 30)).astype(np.uint16), rng.integers(1, 33, 30)
    got = np.unpackbits(bit_slices._Adders(32, 2).reached(table, rarest, least).view(np.uint8), axis=1, bitorder="little")
    bits = np.unpackbits(table.view(np.uint8), axis=1, bitorder="little").astype(int)
    assert (got == (bits[rarest].sum(axis=0) >= least[:, None])).all() and 0 < got.mean() < 1


def test_values_are_taken_from_the_records_once(spark):
    df = spark.createDataFrame([("a", ["x", "x", None]), ("b", ["x", "y"]), ("c", ["y"]), ("d", None), (None, ["x"])], "id string, of array<string>")
    ties = ties_of_values(df, "id", F.col("of"))
    assert "Generate" not in ties._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in ties.collect()} == {("b", "a"), ("c", "b")} and ties.count() == 2
