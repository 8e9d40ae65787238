"""Linkage on made-up happenings with known partners, and the label model on known generators."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.functions.dates import day_range, days_apart
from quernstone.llm import linkage, linkage_tiles
from quernstone.llm.label_model import LabelModel, State
from quernstone.llm.linkage import _hub_pairs, candidates, entities, link_entities

LEFT = "id string, title string, date string, urls array<string>, at int, text string"


def world(rng, n):
    names = [f"{a}{b}" for a in ("dra", "vel", "kor", "tas", "mun", "ilo", "zer", "quo") for b in ("mere", "lin", "bar", "vik", "soth", "dane", "pell", "rusk")]
    kinds, places = ["path traversal", "request forgery", "data exposure", "weak default", "open redirect"], ["Hollis", "Wend", "Corrin", "Dray", "Mereside", "Gorse"]
    left, right, truth = [], [], set()
    for i in range(n):
        name, kind, place, number = rng.choice(names).title(), rng.choice(kinds), rng.choice(places), rng.randint(100, 9999)
        title = f"{name} Agent {number}: {kind} found in the office of {place} by unit {rng.randint(10, 99)}"
        day = f"{rng.randint(2019, 2025)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
        urls = [f"https://news.example/item?id={i}"]
        left.append((f"i{i:05}", title, day, urls, 1, "x"))
        if i % 3 == 0:
            told = title.replace("found", "seen") if i % 2 else title.upper() + " | Daily"
            if i % 9 == 0:
                told = f"What we know about {name} Agent so far"
            right.append((f"r{i:05}", told, day if i % 4 else day[:7], [urls[0].replace("https://", "HTTP://www.") + "&utm_source=x"] if i % 9 == 0 or i % 5 else None, 1, "x"))
            truth.add((f"i{i:05}", f"r{i:05}"))
        elif i % 3 == 1:
            right.append((f"r{i:05}", f"{rng.choice(names).title()} Agent {rng.randint(100, 9999)}: {kind} found in the office of {place} by unit {rng.randint(10, 99)}", day, ["https://news.example/other?id=%d" % (10**6 + i)], 1, "x"))
    return left, right, truth


def link(spark, left, right):
    sides = [entities(spark.createDataFrame(rows, LEFT), "id", "title", "date", F.col("urls"), "at") for rows in (left, right)]
    return link_entities(*sides)


def test_known_partners(spark):
    left, right, truth = world(random.Random(1), 900)
    out = link(spark, left, right).collect()
    got = {(r.left_id, r.right_id) for r in out}
    assert len(got & truth) >= 0.95 * len(truth), len(got & truth)
    assert len(got & truth) >= 0.97 * len(got), sorted(got - truth)[:5]
    assert len({r.right_id for r in out}) == len(out) and all(0.5 <= r.confidence <= 1 for r in out)


def test_defined_cases(spark):
    left, right, truth = world(random.Random(2), 60)
    odd = [("n1", None, None, None, 1, "x"), ("n2", "", "soon", [None, ""], None, "x"), (None, "t", "2024", [], 1, "x"), left[0], (*left[0][:1], "older text", *left[0][2:4], 0, "x"), ("long", "word " * 50_000, "2024-01-01", [], 1, "x")]
    assert link(spark, left + odd, right + [("q1", None, None, None, 1, "x"), ("q2", "", "", [], None, "x")] + right[:3]).count() > 0
    assert link(spark, [], right).count() == 0 and link(spark, left, []).count() == 0


def test_model_learns_accuracies():
    rng = np.random.default_rng(3)
    y = rng.random(40_000) < 0.15
    accuracy = [0.95, 0.8, 0.7, 0.65]
    votes = np.stack([np.where(rng.random(len(y)) < a, y, ~y) for a in accuracy], axis=1).astype(np.int64)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    states = [State(True, 0.3, [[0.35, 0.65]] * 4), State(False, 0.7, [[0.65, 0.35]] * 4)]
    model = LabelModel(states).fit(patterns, counts.astype(float))
    learnt = [model.tables[v][0][1] for v in range(4)]
    assert np.allclose(learnt, accuracy, atol=0.04) and abs(model.shares[0] - 0.15) < 0.02
    right = ((model.posterior(votes) > 0.5) == y).mean()
    assert right > 0.94


def test_impossible_levels_stay_impossible():
    states = [State(True, 0.5, [[0, 1], [0.5, 0.5]]), State(False, 0.5, [[0.5, 0.5], [0.5, 0.5]])]
    model = LabelModel(states).fit(np.array([[0, 0], [0, 1], [1, 1]]), np.array([1000.0, 1000.0, 10.0]))
    assert model.posterior(np.array([[0, 1]]))[0] < 1e-9
    assert len(LabelModel(states).fit(np.zeros((0, 2), np.int64), np.zeros(0)).posterior(np.zeros((0, 2), np.int64))) == 0


def test_day_ranges(spark):
    cases = {"2024-03-05": ("2024-03-05",) * 2, "2024/03/05": ("2024-03-05",) * 2, "05.03.2024": ("2024-03-05",) * 2, "5 March 2024": ("2024-03-05",) * 2, "Mar 5, 2024": ("2024-03-05",) * 2, "March 2024": ("2024-03-01", "2024-03-31"), "2024-02": ("2024-02-01", "2024-02-29"), "2024": ("2024-01-01", "2024-12-31"), "2024-03-05T10:00:00Z": ("2024-03-05",) * 2, "2024-13-45": None, "soon": None, "": None}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", day_range(F.col("t")).alias("d"), days_apart(day_range(F.col("t")), day_range(F.lit("2024-03-09"))).alias("n")).collect()
    for r in rows:
        assert (r.d and (str(r.d["first"]), str(r.d["last"]))) == cases[r.t], r
    assert {r.t: r.n for r in rows}["2024-03-05"] == 4 and {r.t: r.n for r in rows}["2024"] == 0


def with_own_words(rng, pairs, own, fillers=400):
    """Pairs on one day that share 14 words and no page, while each side has words that nothing else has."""
    words = [f"{a}{b}" for a in ("al", "be", "co", "du", "em", "fo", "gi", "hu") for b in ("ran", "tel", "mos", "pid", "kul", "ver", "zon", "bix", "dax", "nor")]
    rows = lambda: rng.sample(words, 14)
    day = lambda: f"{rng.randint(2019, 2025)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
    left, right, truth = [], [], set()
    for i in range(fillers):
        left.append((f"f{i:03}", " ".join(rows()), day(), None, 1, "x"))
        right.append((f"g{i:03}", " ".join(rows()), day(), None, 1, "x"))
    for i in range(pairs):
        shared, at = rows(), day()
        for side, table in (("a", left), ("b", right)):
            mixed = shared + [f"{side}{i}q{j}" for j in range(own)]
            rng.shuffle(mixed)
            table.append((f"{side}{i:02}", " ".join(mixed), at, None, 1, "x"))
        truth.add((f"a{i:02}", f"b{i:02}"))
    return left, right, truth


@pytest.mark.parametrize("own", [0, 6])
def test_own_words_hide_no_candidate(spark, own):
    left, right, truth = with_own_words(random.Random(own), 50, own)
    sides = [entities(spark.createDataFrame(rows, LEFT), "id", "title", "date", F.col("urls"), "at") for rows in (left, right)]
    got = {(r.left_id, r.right_id) for r in candidates(*sides).collect()}
    assert truth <= got


def test_every_confident_partner_has_its_rank(spark):
    left, right, truth = world(random.Random(6), 300)
    again = [(f"z{i[1:]}", *rest) for i, *rest in left if (i, f"r{i[1:]}") in truth]
    sides = [entities(spark.createDataFrame(rows, LEFT), "id", "title", "date", F.col("urls"), "at") for rows in (left + again, right)]
    out = link_entities(*sides, every=True).collect()
    ranks = {}
    for r in out:
        ranks.setdefault(r.right_id, []).append(r.rank)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in ranks.values())
    both = {a for a, b in truth if {(a, b), (f"z{a[1:]}", b)} <= {(r.left_id, r.right_id) for r in out}}
    assert len(both) >= 0.9 * len(truth)
    best = {(r.left_id, r.right_id) for r in link_entities(*sides).collect()}
    assert best == {(r.left_id, r.right_id) for r in out if r["rank"] == 1}


def test_hub_pages_make_candidates(spark):
    rng = random.Random(4)
    left, right, truth = world(rng, 300)
    hub = "https://news.example/weekly/round-up"
    for i in range(40):  # all cite one page, hence a hub; words that only the reports have are their rarest ones
        at = f"{2019 + i % 6}-{1 + i * 7 % 12:02}-{1 + i * 11 % 28:02}"
        title = f"Orvane Desk {5000 + i}: open redirect found in the office of Dray by unit {i}"
        left.append((f"h{i:03}", title, at, [hub], 1, "x"))
        right.append((f"k{i:03}", title + "".join(f" {rng.choice('bdfgk')}{rng.choice('aeiou')}{rng.getrandbits(30):x}x" for _ in range(25)), at, [hub], 1, "x"))
        truth.add((f"h{i:03}", f"k{i:03}"))
    # Far apart in time: a hub page with one rare word brings these together too.
    left.append(("far", "Quillmark Agent 77123: weak default found in the office of Gorse by unit 88", "2019-03-04", [hub], 1, "x"))
    right.append(("far", "Quillmark Agent 77123: weak default found in the office of Gorse by unit 88", "2024-09-09", [hub], 1, "x"))
    out = {(r.left_id, r.right_id) for r in link(spark, left, right).collect()}
    hubs = {p for p in truth if p[0][0] == "h"}
    assert len(out & hubs) >= 0.9 * len(hubs), len(out & hubs)
    assert len({p for p in out if p[1][0] == "k"} - hubs) <= 2
    assert ("far", "far") in out


def test_hub_pairs_are_all_pairs_of_compatible_days(spark):
    rng = random.Random(5)
    day = lambda: rng.choice([None, "2023", "2023-04", *(f"2023-{m:02}-{d:02}" for m in (3, 4, 5, 6) for d in (1, 9, 30))])
    rows = {side: [(f"{side}{i}", day()) for i in range(120)] for side in ("l", "r")}
    frames = [spark.createDataFrame(v, "id string, written string").select("id", day_range(F.col("written")).alias("day"), F.array(F.lit(5).cast("bigint")).alias("hub")) for v in rows.values()]
    got = {(r.left_id, r.right_id) for r in _hub_pairs(*frames, spark.createDataFrame([(5, 3)], "page bigint, pieces int")).collect()}
    gap = days_apart(F.col("a.day"), F.col("b.day"))
    want = {(x, y) for x, y in frames[0].alias("a").crossJoin(frames[1].alias("b")).where(gap.isNull() | (gap <= 31)).select("a.id", "b.id").collect()}
    assert 0 < len(want) < 120 * 120 and got == want


def crowded(rng, n):
    """Happenings with hub pages, several links, copies of texts, and dates that are rough, far or unknown."""
    left, right, _ = world(rng, n)
    hubs = [f"https://news.example/weekly/round-up-{i}" for i in range(3)]
    day = lambda at: rng.choice([at, at, at[:7], at[:4], None, "soon", "2019-01-15", "31 January 2024"])
    urls = lambda links: rng.choice([links, None, [rng.choice(hubs)], [*(links or []), *rng.sample(hubs, 2)], hubs])
    mixed = [[(i, rng.choice([title, title, "", f"{title} {title}", None]), day(at), urls(links), 1, "x") for i, title, at, links, _, _ in rows] for rows in (left, right)]
    return [[*rows, ("same", "Quillmark Agent 77123 found", None, hubs, 1, "x")] for rows in mixed]


@pytest.mark.parametrize("tile", [16_000, 40])
def test_tiles_hold_every_candidate_once(spark, monkeypatch, tile):
    monkeypatch.setattr(linkage, "TILE", dict.fromkeys(linkage.TILE, tile))
    sides = [entities(spark.createDataFrame(rows, LEFT), "id", "title", "date", F.col("urls"), "at") for rows in crowded(random.Random(7), 240)]
    want = {(r.left_id, r.right_id) for r in candidates(*sides).collect()}
    ready = linkage._Prepared(*sides, linkage.KEY_WORDS)
    every = np.ones(linkage_tiles.PATTERNS, bool)
    rows = ready.answers(every, linkage_tiles.ALL).collect()
    pairs = [r for r in rows if r.left_id is not None]
    assert len(pairs) == len({(r.left_id, r.right_id) for r in pairs}) and {(r.left_id, r.right_id) for r in pairs} == want
    assert sum(r.n for r in rows) == len(want) > 1_000

    # The answers of whole pairs, as rows, are those of the tiles.
    a, b = (df.select(F.col("id").alias(f"{side}_id"), F.col("words").alias(f"{side}_words"), F.col("day").alias(f"{side}_day"), F.col("plain").alias(f"{side}_plain"), F.col("hub").alias(f"{side}_hub")) for side, df in (("left", ready.left), ("right", ready.right)))
    gap = F.greatest(F.lit(0), F.datediff("left_day.first", "right_day.last"), F.datediff("right_day.first", "left_day.last"))
    links = F.when(F.arrays_overlap("left_plain", "right_plain"), 3).when(F.arrays_overlap("left_hub", "right_hub"), 2).when((F.size("right_plain") == 0) | (F.size("left_plain") == 0), 0).otherwise(1)
    rough = (F.col("left_day.first") != F.col("left_day.last")) | (F.col("right_day.first") != F.col("right_day.last"))
    dates = F.when(rough & (gap == 0), 3).when(gap <= 1, 1).when(gap <= 7, 2).when(gap <= 31, 4).otherwise(5)
    joined = ready.pairs().join(a, "left_id").join(b, "right_id").select("left_id", "right_id", "left_words", "right_words", links.alias("links"), dates.alias("dates"), gap.alias("apart"))
    schema = "left_id string, right_id string, links int, more int, less int, rare int, digits int, dates int, weight int, apart int"
    whole = {(r.left_id, r.right_id): r for r in joined.mapInArrow(linkage._answer, schema).collect()}
    for r in pairs:
        w = whole[r.left_id, r.right_id]
        assert tuple(linkage_tiles.pattern_levels(np.array([r.pattern]))[0]) == tuple(w[v] for v in linkage.VOTERS), (r, w)
        assert (r.weight, r.apart) == (w.weight, w.apart)

    # Of each right entity and pattern the tiles give the best.
    order = lambda r: (-r.weight, r.apart, r.left_id)
    best = lambda rows: {(r.right_id, r.pattern): order(r) for r in sorted((r for r in rows if r.left_id is not None), key=order, reverse=True)}
    assert best(ready.answers(every).collect()) == best(pairs)


def test_crowded_pages_do_not_fill_the_disk(spark, monkeypatch):
    """Pairs of a hub page grow with the square of its citers; what is written must not."""
    written = []

    class Counted(linkage.Cut):
        def __init__(self, df, name):
            super().__init__(df, name)
            written.append(self.read().count())

    monkeypatch.setattr(linkage, "Cut", Counted)
    hub = ["https://news.example/weekly/round-up"]
    rows = [[(f"{side}{i:04}", f"Corrin Agent {side}{i}: path traversal", f"2024-03-{1 + i % 28:02}", hub, 1, "x") for i in range(600)] for side in ("a", "b")]
    link(spark, *rows).count()
    assert max(written) < 600 * 600 / 10, written
