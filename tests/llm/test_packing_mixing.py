import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quernstone.llm import mixing
from quernstone.llm.packing import best_fit, fill_rates, pack_texts
from quernstone.llm.tokens import VOCABULARY, encoder, token_counts

SCHEMA = "doc_id bigint, text string, source string, tokens int, container string"


def texts(rng, n):
    return [(i, " ".join(rng.choice(["alpha", "beta", "gamma delta", "日本語", "\n"]) for _ in range(int(rng.expovariate(1 / 60)))), rng.choice(["s1", "s2", "s3", None]), 0, "x") for i in range(n)]


def test_best_fit_takes_the_tightest_compatible_container():
    assert best_fit([(6, 1, 0), (5, 1, 0), (4, 1, 0), (5, 1, 0)], 10, {}) == [0, 1, 0, 1]
    assert best_fit([(5, 1, 1), (5, 1, 1), (5, 1, 0)], 10, {}) == [0, 1, 0]
    assert best_fit([(5, 1, 0), (5, 2, 0), (4, 1, 0)], 10, {1: 2, 2: 1}) == [0, 1, 0]
    assert best_fit([(0, 1, 0), (10, 1, 0)], 10, {}) == [0, 0]


def test_nothing_is_lost_or_split_without_need(spark):
    rows = texts(random.Random(4), 600) + [(1000, "word " * 3000, "s1", 0, "x"), (1001, None, None, 0, "x"), (1002, "", "s1", 0, "x"), (1003, "Copy of it", "s1", 0, "x"), (1004, " copy of IT ", "s2", 0, "x"), (1003, "Copy of it", "s1", 0, "x"), (None, "lost id", "s1", 0, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    limits = spark.createDataFrame([("a", 128), ("b", 700), ("none", None), ("zero", 0)], "limit_name string, capacity_tokens int")
    packed = pack_texts(df, limits, "doc_id", "text", "source", {"s1": ["s3"]}, group_texts=150)
    out = packed.collect()
    encode = encoder(VOCABULARY).encode_ordinary
    size = {r[0]: len(encode(r[1] or "")) for r in rows}
    source = {r[0]: r[2] for r in rows}
    for name, capacity in (("a", 128), ("b", 700)):
        own = [r for r in out if r.limit_name == name]
        room, pieces, held = Counter(), defaultdict(list), defaultdict(list)
        for r in own:
            room[r.container] += r.tokens
            held[r.container].append(r.id)
            pieces[r.id].append((r.first_token, r.tokens))
        assert max(room.values()) <= capacity
        assert set(pieces) == set(size)
        for i, n in size.items():
            copies = sum(r[0] == i for r in rows)
            assert sum(t for _, t in pieces[i]) == copies * n
            assert len(pieces[i]) == copies * max(1, -(-n // capacity))
        for ids in held.values():
            assert len({i for i in ids if i in (1003, 1004)}) <= 1 and ids.count(1003) <= 1
            assert not ({source[i] for i in ids} >= {"s1", "s3"})
    rates = {r.limit_name: r.fill for r in fill_rates(pack_texts(df, limits, "doc_id", "text", "source")).collect()}
    assert set(rates) == {"a", "b"} and rates["a"] > 0.98 and rates["b"] > 0.95
    assert pack_texts(df.limit(0), limits, "doc_id", "text", "source").count() == 0
    assert pack_texts(df, limits.limit(0), "doc_id", "text", "source").count() == 0


def test_clusters_of_the_caller_keep_apart(spark):
    df = spark.createDataFrame([(i, f"text number {i} of them", "s1", 0, "x") for i in range(40)] + [(None, "no id", "s1", 0, "x")], SCHEMA)
    limits = spark.createDataFrame([("a", 200)], "limit_name string, capacity_tokens int")
    clusters = spark.createDataFrame([(i, i % 4) for i in range(20)] + [(3, 1)], "id bigint, group_id int")
    out = pack_texts(df, limits, "doc_id", "text", "source", clusters=clusters).collect()
    held = defaultdict(list)
    for r in out:
        held[r.container].append(r.id)
    assert sorted(i for v in held.values() for i in v if i is not None) == list(range(40)) and len(out) == 41
    for ids in held.values():
        own = [i % 4 for i in ids if i is not None and i < 20]
        assert len(own) == len(set(own))


def test_rates_beyond_the_range_of_exp():
    assert mixing.capped_mean(5000.0, 3) == 3 and abs(mixing.capped_mean(900.0, 2000) - 900) < 1e-6
    assert abs(sum(u >= t for t in mixing.thresholds(900.0, 2000) for u in (0.5,)) - 900) < 5


@pytest.mark.parametrize("mean, most", [(0.3, 1), (0.9, 1), (1.7, 4), (3.9, 4), (4, 4), (9, 4), (0, 3), (2.5, 12)])
def test_thresholds_have_the_wanted_mean(mean, most):
    steps = mixing.thresholds(mean, most)
    draws = 200_000
    got = sum(sum(u >= t for t in steps) for u in ((i + 0.5) / draws for i in range(draws))) / draws
    assert abs(got - min(mean, most)) < 1e-3 and len(steps) <= most


def test_shares_and_caps(spark):
    rng = random.Random(7)
    rows = [(i, "word " * rng.randint(20, 60), rng.choice(["s1"] * 6 + ["s2"] * 3 + ["s3"]), 0, "x") for i in range(6000)] + [(9000, None, "s1", 0, "x"), (9001, "", "s2", 0, "x"), (9002, "w", None, 0, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    targets = spark.createDataFrame([("m", "s1", 0.4, 1), ("m", "s2", 0.35, 2), ("m", "s3", 0.2, 4), ("m", "gone", 0.05, 4), ("n", "s1", 1.0, 3), ("o", "gone", 1.0, 3), ("p", "s3", None, 3)], "mix_name string, source string, target_share double, max_repeats int")
    mix = mixing.mix_sources(df, targets, "doc_id", "text", "source")
    shares = {(r.mix_name, r.source): r for r in mix.shares.collect()}
    for s, w in (("s1", 0.4), ("s2", 0.35), ("s3", 0.2)):
        assert abs(shares["m", s].actual_share - w / 0.95) < 0.025
        assert shares["m", s].most_repeats <= shares["m", s].max_repeats
    assert shares["m", "gone"].actual_share == 0 and shares["o", "gone"].tokens == 0 and shares["n", "s1"].actual_share == 1
    draws = mix.draws.collect()
    per = Counter((r.mix_name, r.id) for r in draws)
    assert max(n for (m, _), n in per.items() if m == "m") <= 4
    # The binding source is drawn too: copies of its texts follow a Poisson distribution up to the cap.
    own = [r[0] for r in rows if r[2] == "s1" and r[1]]
    spread = Counter(per.get(("n", i), 0) for i in own)
    want = [math.exp(-3), 3 * math.exp(-3), 4.5 * math.exp(-3)]
    assert set(spread) == {0, 1, 2, 3} and all(abs(spread[k] / len(own) - p) < 0.02 for k, p in enumerate(want))
    # As many tokens as all texts have: a source that can't reach its share is used up to its cap.
    full = {(r.mix_name, r.source): r for r in mixing.mix_sources(df, targets, "doc_id", "text", "source", total_tokens="all").shares.collect()}
    assert full["m", "s3"].actual_share > 0.15 and full["m", "s3"].most_repeats <= 4 and full["m", "s1"].most_repeats == 1
    total = sum(len(encoder(VOCABULARY).encode_ordinary(r[1])) for r in rows if r[1] and r[2])
    assert abs(sum(r.tokens for (m, _), r in full.items() if m == "n") - total) < 0.05 * total
    assert [(r.mix_name, r.place) for r in draws] == sorted((r.mix_name, r.place) for r in draws)
    assert not {r.id for r in draws} & {9000, 9001, 9002}
    again = mixing.mix_sources(df.repartition(7), targets, "doc_id", "text", "source").draws.collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in draws]
    assert mixing.mix_sources(df.limit(0), targets, "doc_id", "text", "source").draws.count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "It's <|endoftext|> 日本", "s", 0, "x"), (2, None, "s", 0, "x")], SCHEMA)
    got = {r.id: r.tokens for r in token_counts(df, [F.col("doc_id").alias("id")], "text").collect()}
    assert got == {1: len(encoder(VOCABULARY).encode_ordinary("It's <|endoftext|> 日本")), 2: 0}
