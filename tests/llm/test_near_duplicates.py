"""The near-duplicate join against all pairs, and the signature trees' bound."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.functions import textscan
from quernstone.llm import near_duplicates as nd
from quernstone.llm import signature_forest

WORD = re.compile(r"[^\W_]+")


def bag(text):
    return Counter(WORD.findall(text.lower()))


def likeness(a, b):
    return sum((a & b).values()) / max(sum(a.values()), sum(b.values()), 1)


def all_pairs(texts, least):
    bags = {i: bag(t) for i, t in texts.items() if bag(t)}
    ids = sorted(bags)
    return {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if likeness(bags[a], bags[b]) >= least - 1e-9}


def corpus(rng, n, words=400):
    """Texts over a skewed vocabulary, about half of them edited copies of others."""
    vocabulary = [f"w{i}" for i in range(words)] + ["Ärger", "日本語", "naïve", "x_y", "it's", "3.14"]
    pick = lambda k: [vocabulary[min(int(rng.expovariate(1) * words / 5), len(vocabulary) - 1)] for _ in range(k)]
    out = {}
    for i in range(n):
        if out and rng.random() < 0.5:
            text = rng.choice(list(out.values())).split()
            for _ in range(rng.randint(0, max(1, len(text) // 5))):
                at = rng.randrange(len(text) + 1) if text else 0
                text[at : at + rng.randint(0, 1)] = pick(rng.randint(0, 1))
            if rng.random() < 0.3:
                rng.shuffle(text)
            out[f"d{i:04}"] = " ".join(text)
        else:
            out[f"d{i:04}"] = " ".join(pick(rng.choice([1, 2, 3, 5, 8, 30, 80])))
    return out


def found(spark, texts, **options):
    df = spark.createDataFrame([(i, None, t, 1) for i, t in texts.items()], "id string, title string, description string, at int")
    return {(r["id_a"], r["id_b"]) for r in nd.near_duplicates(df, "id", ["title", "description"], "at", **options).pairs().collect()}


def test_words_and_repetitions():
    texts = ["A a B-b_c 1.5 é É", "", "  ", "日本 x² ½"]
    docs, hashes = textscan.word_hashes(texts)
    want = [w for t in texts for w in WORD.findall(t.lower())]
    assert len(hashes) == len(want) and len(set(hashes.tolist())) == len(set(want))
    _, numbered = textscan.numbered_words(docs, hashes)
    assert len(set(zip(docs.tolist(), numbered.tolist()))) == len(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    texts = corpus(random.Random(seed), 400)
    # Exact copies are written as pairs with their first record only.
    texts = {i: t for t, i in sorted({t: i for i, t in sorted(texts.items(), reverse=True)}.items())}
    want, got = all_pairs(texts, 0.75), found(spark, texts)
    assert got <= want
    assert len(want) > 100 and len(want - got) <= 0.01 * len(want), sorted(want - got)[:5]


def test_long_texts(spark):
    rng = random.Random(8)
    base = [f"v{rng.randint(0, 3000)}" for _ in range(30_000)]
    near = base[:]
    for i in rng.sample(range(len(near)), 6_000):
        near[i] = f"u{i}"
    far = base[:15_000] + [f"q{i}" for i in range(15_000)]
    texts = {"a": " ".join(base), "b": " ".join(near), "c": " ".join(far), "d": "short"}
    assert found(spark, texts) == all_pairs(texts, 0.75) == {("a", "b")}


def test_defined_cases(spark):
    rows = [
        ("x", "t", "one two three four", 1, "c"), ("x", "t", "one two three four", 1, "c"), ("x", "t", "other words here now", 0, "c"),
        ("y", "T", "four three two one", None, "c"), ("z", None, None, 1, "c"), ("w", "t", "  \t", 1, "c"), (None, "t", "one two three four", 1, "c"), ("v", None, "!!!", 1, "c"),
    ]
    df = spark.createDataFrame(rows, "id string, title string, description string, at int, class string")
    join = nd.near_duplicates(df, "id", ["title", "description"], "at", F.col("description").rlike(r"\S"))
    assert [(r.id_a, r.id_b, r.likeness) for r in join.pairs().collect()] == [("x", "y", 1.0)]
    assert [tuple(r) for r in join.edges().collect()] == [("x", "y")]
    assert nd.near_duplicates(df.limit(0), "id", ["title"]).pairs().count() == 0


@pytest.mark.parametrize("copies", [2, 3, 33, 200])
def test_copies_are_a_star_at_every_size(spark, copies):
    texts = {f"k{i:03}": "same words in every one of these copies" for i in range(copies)} | {"near": "same words in every one of those copies"}
    assert found(spark, texts) == {("k000", k) for k in texts if k != "k000"}


def pairs_with_own_words(own, kind, pairs=50, base=180, words=600, fillers=300):
    """Pairs that share ``base`` words while each record has ``own`` words that the other lacks."""
    rng = random.Random(own)
    pick = lambda k: [f"w{rng.randrange(words)}" for _ in range(k)]
    texts = {f"f{i:03}": " ".join(pick(base)) for i in range(fillers)}
    for i in range(pairs):
        shared = pick(base)
        for side in "ab":
            extra = [f"{side}{i}x{j}" for j in range(own)] if kind == "unique" else [f"m{rng.randrange(60)}" for _ in range(own)]
            both = shared + extra
            rng.shuffle(both)
            texts[f"p{i:02}{side}"] = " ".join(both)
    return texts, {(f"p{i:02}a", f"p{i:02}b") for i in range(pairs)}


@pytest.mark.parametrize("own", [5, 12, 20, 45])
def test_own_rare_words_hide_no_pair(spark, own):
    texts, want = pairs_with_own_words(own, "unique")
    assert found(spark, texts) == want


def test_exact_finds_pairs_whose_own_words_are_common(spark):
    texts, want = pairs_with_own_words(40, "common")
    got = found(spark, texts)
    assert got <= found(spark, texts, exact=True) == want == all_pairs(texts, 0.75)


def test_pairs_whose_rarest_common_words_all_differ(spark):
    rng = random.Random(9)
    pick = lambda: [f"w{j}" for j in rng.sample(range(600), 180)]
    texts, want = {f"f{i:03}": " ".join(pick()) for i in range(100)}, set()
    for i in range(50):
        shared = pick()
        texts |= {f"p{i:02}{side}": " ".join(shared + [f"{side}m{j}" for j in rng.sample(range(50), 40)]) for side in "ab"}
        want.add((f"p{i:02}a", f"p{i:02}b"))
    assert not want & found(spark, texts, exact=False)
    assert found(spark, texts) == want


@pytest.mark.parametrize("pieces", [None, 90])
def test_all_pairs_are_found_without_asking(spark, monkeypatch, pieces):
    if pieces:
        monkeypatch.setattr(nd, "LEAST_ROWS", pieces)
        monkeypatch.setattr(nd, "PIECES", 100)
    for own in (40, 55):
        texts, want = pairs_with_own_words(own, "common")
        assert found(spark, texts) == want == all_pairs(texts, 0.75)
    texts = corpus(random.Random(8), 500)
    texts = {i: t for t, i in {t: i for i, t in texts.items()}.items()}
    assert found(spark, texts) == all_pairs(texts, 0.75)


def test_every_two_pieces_of_like_sizes_meet_once():
    sizes = [(3, 5), (4, 50), (5, 4), (6, 7), (7, 1), (9, 30), (40, 2)]
    dealt, meets = nd._pieces(sizes, 10, 0.75)
    of = dict(meets)
    for (x, i, m), (y, j, n) in itertools.product(dealt, dealt):
        for p, q in itertools.product(range(i, i + m), range(j, j + n)):
            both = {t for t, alone in of[p] if alone == (p == q)} & {t for t, alone in of[q] if alone == (p == q)}
            assert len(both) == 1 if min(x, y) >= 0.75 * max(x, y) else len(both) <= 1
    assert nd._pieces([], 10, 0.75) == ([], [])


@pytest.mark.parametrize("ranked", [0, 40, 300])
def test_bits_by_rank_drop_no_pair_and_tell_others_apart(ranked):
    rng = np.random.default_rng(5)
    # Words of falling frequency; 30 of the 400 records are edited copies.
    chance = 1 / np.arange(1, 1501)
    sets = [set(rng.choice(1500, rng.integers(3, 200), replace=False, p=chance / chance.sum()).tolist()) for _ in range(370)]
    sets += [set(rng.permutation(sorted(s))[: max(1, int(len(s) * rng.uniform(0.75, 1)))].tolist()) | {2000 + i} for i, s in enumerate(sets[:30])]
    sets.sort(key=len)
    size = np.array([len(s) for s in sets])
    words = np.concatenate([sorted(s) for s in sets])
    bits = nd.ranked_signatures(size, textscan.mix64(words.astype(np.uint64)), np.where(words < ranked, words, -1)).view(np.uint64)
    want = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if len(sets[i] & sets[j]) >= 0.75 * max(len(sets[i]), len(sets[j]))}
    pairs = [(int(x), int(y)) for a, b in signature_forest.every_pair(size, bits, size, bits, 0.75, True) for x, y in zip(a, b)]
    assert len(want) >= 20 and want <= set(pairs) and len(set(pairs)) == len(pairs) < 3 * len(want)
    half = len(sets) // 2
    across = {(int(x), int(y) + half) for a, b in signature_forest.every_pair(size[:half], bits[:half], size[half:], bits[half:], 0.75) for x, y in zip(a, b)}
    assert across == {(x, y) for x, y in pairs if x < half <= y}


@pytest.mark.parametrize("each", [50, 2_000, 20_000])
def test_a_class_is_sent_to_few_pieces_at_every_size(each):
    sizes = [(s, each) for s in range(100, 160)]
    dealt, meets = nd._pieces(sizes, max(nd.LEAST_ROWS, -(-60 * each // nd.PIECES)), 0.75)
    assert np.mean([len(m) for _, m in meets]) <= 6.5


def test_as_many_rows_move_for_each_class_in_tables_of_any_size():
    def sent(each):
        sizes = [(s, each) for s in range(100, 160)]
        return np.mean([len(m) for _, m in nd._pieces(sizes, min(nd.MOST_ROWS, max(nd.LEAST_ROWS, -(-60 * each // nd.PIECES))), 0.75)[1]])

    assert sent(320) == pytest.approx(sent(3_200), rel=0.1) and sent(320) == pytest.approx(sent(32_000), rel=0.1)


def test_words_are_looked_for_in_wanted_texts_only(monkeypatch):
    import pyarrow as pa

    texts = ["one two", "two three", "", "one two", "four"]

    class Wanted:
        value = type("Two", (), {"may_hold": staticmethod(lambda contents: np.isin(contents, nd._contents(["two three", "four"])))})

    seen, bags = [], nd._bags
    monkeypatch.setattr(nd, "_bags", lambda t: seen.extend(t) or bags(t))
    rows = [b for b in nd._word_lists(Wanted)([pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])])]
    assert seen == ["two three", "four"] and sum(b.num_rows for b in rows) == 2


def test_all_choices_find_all_pairs_of_short_records(spark):
    rng = random.Random(3)
    texts = {f"s{i:04}": " ".join(f"w{min(int(rng.expovariate(0.12)), 40)}" for _ in range(rng.randint(3, 14))) for i in range(500)}
    texts = {i: t for t, i in {t: i for i, t in texts.items()}.items()}
    want = all_pairs(texts, 0.75)
    assert len(want) > 50 and found(spark, texts, complete=False) == want


def test_a_version_that_is_not_usable_replaces_older_ones(spark):
    rows = [("a", "t", "one two three four", 1), ("b", "t", "one two three four", 1), ("b", "t", None, 2), ("c", "t", "one two three four", 3)]
    df = spark.createDataFrame(rows, "id string, title string, description string, at int")
    join = nd.near_duplicates(df, "id", ["title", "description"], "at", F.col("description").rlike(r"\S"))
    assert [(r.id_a, r.id_b) for r in join.pairs().collect()] == [("a", "c")]


def test_bound_never_drops_a_pair():
    rng = np.random.default_rng(4)
    n, width = 300, nd.SIGNATURE_BITS // 64
    sets = [frozenset(rng.integers(0, 400, rng.integers(1, 120)).tolist()) for _ in range(n)]
    sets += [frozenset(list(s)[: max(1, int(len(s) * 0.9))]) for s in sets]
    size = np.array([len(s) for s in sets])
    bits = np.zeros((len(sets), width), np.uint64)
    for i, s in enumerate(sets):
        for w in s:
            slot = (w * 2654435761) % nd.SIGNATURE_BITS
            bits[i, slot // 64] |= np.uint64(1) << np.uint64(slot % 64)
    tree = rng.integers(0, 3, len(sets))
    order = np.lexsort((size, tree))
    tree, size, bits, sets = tree[order], size[order], bits[order], [sets[i] for i in order]
    got = {(int(x), int(y)) for a, b in signature_forest.candidates(tree, size, bits, 0.75) for x, y in zip(a, b)}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if tree[i] == tree[j] and len(sets[i] & sets[j]) >= 0.75 * max(len(sets[i]), len(sets[j]))}
    assert want and want <= got
    assert len(got) < 0.5 * len(sets) * (len(sets) - 1) / 2


def test_pieces_of_a_big_block(spark, monkeypatch):
    monkeypatch.setattr(nd, "PIECE_ROWS", 10)
    texts = {f"d{i:03}": " ".join(["alpha beta gamma delta"] * 3 + [f"n{i}"]) for i in range(60)}
    rows = [(int(i), int(j)) for i in range(60) for j in range(i + 1, 60)]
    assert len(found(spark, texts)) == len(rows)


def test_different_texts_of_equal_words_are_written_out(spark):
    words = "same words in every one of these texts".split()
    order = list(itertools.islice(itertools.permutations(words), 40))
    texts = {f"k{i:03}": " ".join(p) for i, p in enumerate(order)} | {"near": "same words in every one of those texts"}
    assert found(spark, texts) == set(itertools.combinations(sorted(texts), 2))
    copies = {f"c{i:03}": " ".join(words) for i in range(34)}
    df = spark.createDataFrame(sorted({**copies, "x": "same words in every one of these texts!", "y": "another text"}.items()), "id string, t string")
    join = nd.near_duplicates(df, "id", ["t"])
    assert {(r.id_a, r.id_b) for r in join.pairs().collect()} == {("c000", c) for c in copies if c != "c000"} | {("c000", "x")}
    assert {(r.id, r.copy_of, r.copies) for r in join.copies().collect()} == {(c, "c000", len(copies)) for c in copies} | {("x", "x", 1), ("y", "y", 1)}


def test_a_full_reducer_drops_nothing(spark, monkeypatch):
    from quernstone.plans import reducer

    monkeypatch.setattr(reducer, "MOST_BITS", 16)
    keys = spark.range(400_000).select(F.xxhash64("id").alias("k"))
    held = reducer.Reducer(keys, F.col("k"), 400_000)
    assert held.slots == 1 << 16
    assert held.keep(spark.range(1000), F.xxhash64("id")).count() == 1000
    few = reducer.Reducer(keys.limit(10), F.col("k"), 10)
    assert few.keep(spark.range(100_000), F.xxhash64("id")).count() < 1000
