"""Ordered merging against the same rules run over all rows at once, and the other identity operators."""

import random

import pandas as pd

from quernstone.operators import identity, redirects


def test_ordered_merge_equals_one_global_replay(spark):
    rng = random.Random(3)
    for trial in range(3):
        pick = lambda p, n: [f"{p}{rng.randint(0, 40)}" for _ in range(rng.randint(0, n))]
        rows = [(i, pick("c", 2), pick("s", 1), pick("u", 2), rng.choice(["", *(f"t{k}" for k in range(25))]), rng.choice([None, 2020.0, 2021.0, 2023.0])) for i in range(150)]
        frame = pd.DataFrame(rows, columns=["seq", "cve", "source", "url", "title", "year"])
        want = dict(identity._fold(frame).itertuples(index=False))
        df = spark.createDataFrame(rows, "seq bigint, cve array<string>, source array<string>, url array<string>, title string, year double")
        got = dict(map(tuple, identity.ordered_merge(df).collect()))
        assert got == want, trial


def test_merge_rules():
    frame = pd.DataFrame(
        [(0, ["c1"], [], ["u"], "t", 2020.0), (1, ["c2"], [], ["u"], "", 2020.0), (2, [], [], ["u"], "", 2020.0), (3, [], [], [], "t", 2021.0), (4, [], [], [], "t", 2023.0), (5, ["c1", "c2"], [], [], "", None)],
        columns=["seq", "cve", "source", "url", "title", "year"],
    )
    assert dict(identity._fold(frame).itertuples(index=False)) == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4, 5: 0}


def plain_merge(rows):
    """The rules once more, on whole records with sets of rows: no indexes, every record is looked through."""
    records = []  # [first seq, rows' seqs, cve, source, url, titles, year, prior], the earliest first

    def weak(a, b, wide):
        return bool(a[7] & b[7]) or not (wide or (a[2] and b[2] and not a[2] & b[2]))

    def first(kind, key):
        return next((r for r in records if key in r[8 + kind]), None)

    for seq, cve, source, url, title, year, wide, prior in sorted(rows, key=lambda r: r[0]):
        new = [seq, {seq}, set(cve), set(source), list(url), title, year, set(prior), set(), set(), set(), set()]
        hit = next((r for k in cve if (r := first(0, k))), None) or next((r for k in source if (r := first(1, k))), None)
        hit = hit or next((r for k in url if (r := first(2, k)) and weak(r, new, k in wide)), None)
        if not hit and title and (r := first(3, title)) and None not in (r[6], year) and abs(r[6] - year) <= 1 and weak(r, new, False):
            hit = r
        if hit:
            take(hit, new)
        else:
            records.append(hit := new)
            if title and not first(3, title):
                hit[11].add(title)
        changed = True
        while changed:
            changed = False
            for kind, keys in ((0, hit[2]), (1, hit[3]), (2, hit[4])):
                for k in sorted(keys) if kind < 2 else list(keys):
                    other = first(kind, k)
                    if other is None:
                        hit[8 + kind].add(k)
                    elif other is not hit and (kind < 2 or weak(hit, other, any(k in w[6] for w in rows))):
                        take(hit, other)
                        records.remove(other)
                        changed = True
    return {s: r[0] for r in records for s in r[1]}


def take(a, b):
    for i in (1, 2, 3, 7, 8, 9, 10, 11):
        a[i] |= b[i]
    a[4] += [u for u in b[4] if u not in a[4]]
    a[6] = b[6] if a[6] is None else a[6]


def test_fold_against_a_plain_merge():
    rng = random.Random(12)
    for trial in range(1000):
        pick = lambda p, m, n: [f"{p}{x}" for x in rng.sample(range(m), rng.randint(0, n))]
        rows = []
        for i in range(rng.randint(2, 14)):
            url = pick("u", 5, 2)
            rows.append((i, pick("c", 6, 2) if rng.random() < 0.6 else [], pick("s", 6, 1), url, rng.choice(["", "t1", "t2", "t3"]), rng.choice([None, 2020.0, 2021.0, 2023.0]), [u for u in url if u == "u0"], pick("p", 3, 1) if rng.random() < 0.3 else []))
        frame = pd.DataFrame(rows, columns=["seq", "cve", "source", "url", "title", "year", "wide", "prior"])
        assert dict(identity._fold(frame).itertuples(index=False)) == plain_merge(rows), (trial, rows)


def test_round_ups_and_published_records(spark):
    rows = [(0, [], ["a"], ["w/1"], "", None), (1, [], ["b"], ["w/1"], "", None), (2, ["CVE-1"], ["c"], ["x"], "", None), (3, ["CVE-2"], ["d"], ["x"], "", None), (4, [], ["e"], ["w/1"], "", None)]
    df = spark.createDataFrame(rows, "seq bigint, cve array<string>, source array<string>, url array<string>, title string, year double")
    assert dict(map(tuple, identity.ordered_merge(df, "^w/").collect())) == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4}
    prior = spark.createDataFrame([("a", "P1"), ("e", "P1"), ("c", "P2"), ("CVE-2", "P2")], "key string, id string")
    assert dict(map(tuple, identity.ordered_merge(df, "^w/", prior).collect())) == {0: 0, 1: 1, 2: 2, 3: 2, 4: 0}
    assert identity.largest_linked_set(df, "^w/") == 2 and identity.largest_linked_set(df) == 3 and identity.largest_linked_set(df.limit(0)) == 0


def test_ranks_and_empty(spark):
    df = spark.createDataFrame([(x,) for x in (5, 3, 9, 7)], "x bigint")
    assert sorted(map(tuple, identity.ranked(df, "x").collect())) == [(3, 0), (5, 1), (7, 2), (9, 3)]
    assert identity.ranked(df.limit(0), "x").count() == 0


def test_redirects_follow_last_record(spark):
    log = spark.createDataFrame([(1, "a", ["b"]), (2, "b", ["c"]), (3, "a", []), (4, "d", ["e", "f"]), (5, "e", ["c"]), (6, "f", ["x"]), (7, "g", ["h"]), (8, "h", ["g"]), (9, "i", None)], "seq int, from string, into array<string>")
    live = spark.createDataFrame([("c",), ("x",)], "id string")
    ids = spark.createDataFrame([(x,) for x in "abcdefghiz"], "id string")
    got = {r["id"]: (r["kind"], r["targets"]) for r in redirects.answer(ids, log, live).collect()}
    assert got == {"a": ("withdrawn", []), "b": ("successor", ["c"]), "c": ("live", ["c"]), "d": ("group", ["c", "x"]), "e": ("successor", ["c"]), "f": ("successor", ["x"]), "g": ("withdrawn", []), "h": ("withdrawn", []), "i": ("withdrawn", []), "z": ("unknown", [])}
    skip = {r["from"]: r["into"] for r in redirects.last_records(log, skip_empty=True).collect()}
    assert skip["a"] == ["b"]
    assert {r[0] for r in redirects.dangling(log, live).collect()} == {"g", "h"}
