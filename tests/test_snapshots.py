import random

import pytest
from pyspark.sql import functions as F

from quernstone.operators.snapshots import day, snapshot_changes

SCHEMA = "snapshot_on string, id string, status string, received int, key string, at int"


def changes(df):
    out = snapshot_changes(df, "snapshot_on", F.upper(F.trim("id")), {"status": F.expr("nullif(lower(trim(status)), '')")}, "received")
    return sorted((r["snapshot_on"], r["key"], r["change_kind"], r["before"] and r["before"]["status"], r["after"] and r["after"]["status"]) for r in out.collect())


def test_cases(spark):
    rows = [
        ("2026-01-01", "a", "x", 1), ("2026-01-01", "b", None, 1), ("2026-01-01", "c", "y", 1), ("2026-01-01", "d", "s", 1),
        ("2026-02-01", " A", "X ", 1), ("2026-02-01", "b", "", 1), ("2026-02-01", "d", "t", 2), ("2026-02-01", "d", "s", 1), ("2026-02-01", "e", "n", None),
        ("2026-03-01", "a", None, 1), ("2026-03-01", None, "z", 1), (None, "q", "z", 1), ("2026-03-01", "a", None, 1),
    ]
    df = spark.createDataFrame([(*r, "k", 9) for r in rows], SCHEMA)
    assert changes(df) == [
        ("2026-02-01", "C", "removed", "y", None), ("2026-02-01", "D", "changed", "s", "t"), ("2026-02-01", "E", "added", None, "n"),
        ("2026-03-01", "A", "changed", "x", None), ("2026-03-01", "B", "removed", None, None), ("2026-03-01", "D", "removed", "t", None), ("2026-03-01", "E", "removed", "n", None),
    ]
    assert changes(df.limit(0)) == []
    assert changes(df.where("snapshot_on = '2026-01-01'")) == []


def test_against_plain_comparison(spark):
    rng = random.Random(2)
    rows = [(f"2026-0{s}-01", f"k{rng.randint(0, 60)}", rng.choice(["a", "b", None]), rng.randint(0, 3), "", 0) for s in range(1, 6) for _ in range(80)]
    rows += [("2026-03-01", "hot", rng.choice("ab"), i, "", 0) for i in range(300)]
    states = {}
    for s, k, v, r, *_ in sorted(rows, key=lambda r: (r[3], r[2] is not None, r[2] or "")):
        states.setdefault(s, {})[k.upper()] = v
    want, names = [], sorted(states)
    for old, new in zip(names, names[1:]):
        a, b = states[old], states[new]
        want += [(new, k, "added", None, b[k]) for k in b.keys() - a.keys()] + [(new, k, "removed", a[k], None) for k in a.keys() - b.keys()] + [(new, k, "changed", a[k], b[k]) for k in a.keys() & b.keys() if a[k] != b[k]]
    assert changes(spark.createDataFrame(rows, SCHEMA)) == sorted(want, key=lambda r: r[:3])


def test_equally_late_rows_that_differ(spark):
    # The greater values hold, whatever their hashes, also when a version comes several times.
    rows = [(day, f"k{i}", v, 1, "", 0) for i in range(40) for day in ("2026-01-01", "2026-02-01") for v in ("a", "b", "b", f"c{i}") if not (v == "a" and i % 2)]
    assert changes(spark.createDataFrame(rows, SCHEMA).repartition(3)) == []
    more = rows + [("2026-02-01", "k7", "d", 1, "", 0)]
    assert changes(spark.createDataFrame(more, SCHEMA)) == [("2026-02-01", "K7", "changed", "c7", "d")]


def test_orders(spark):
    df = spark.createDataFrame([("2026-01-01", "a", "x", "late")], "snapshot_on string, id string, status string, received string")
    with pytest.raises(TypeError, match="whole numbers"):
        changes(df)


def test_days(spark):
    texts = ["2024-10-21", "2024/10/21", "20241021", "2024-10-21T00:00:00Z", " 2024-10-21 ", "2024.10.21", "", " ", None, "Soon", "202410210"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(day("t")).collect()]
    assert got == ["2024-10-21"] * 6 + [None, None, None, "soon", "202410210"]
