import random

from pyspark.sql import functions as F

from quernstone.functions.identifiers import identifiers
from quernstone.llm.components import connected_components, ties_of_values


def plain(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {x: root(x) for x in parent}


def test_random_graphs_chains_and_stars(spark):
    rng = random.Random(6)
    chain = [(f"c{i:04}", f"c{i + 1:04}") for i in range(300)]
    rng.shuffle(chain)
    star = [("s5000", f"s{i:04}") for i in range(400)]
    mess = [(f"m{rng.randint(0, 150)}", f"m{rng.randint(0, 150)}") for _ in range(110)] + [(None, "m1"), ("m2", None), ("m3", "m3")]
    edges = chain + star + mess + mess[:20]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a string, b string")).collect()))
    assert got == plain(edges)
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_ties_of_values(spark):
    rows = [
        ("r1", ["CVE-2024-10001 "], None), ("r2", ["cve‑2024‑10001"], ["n/a"]), ("r3", ["CVE-2024-0000", "CVE-2025-XXXX", "CVE-24-10001"], ["N/A", "unknown", " TBD "]), ("r4", ["CVE-2024-0000", "CVE-2025-XXXX", "CVE-24-10001"], ["n/a", "Unknown", "tbd", "none", ""]),
        ("r5", [None], ["SRC-1"]), ("r6", [], ["src–1"]), ("r1", ["other-9"], None), ("r7", None, ["OTHER-9"]), (None, ["SRC-1"], None), ("r8", None, None),
    ]
    df = spark.createDataFrame(rows, "id string, cve_ids array<string>, source_ids array<string>").withColumn("value", F.lit(1))
    got = {tuple(sorted(r)) for r in ties_of_values(df, "id", identifiers("cve_ids", "source_ids")).collect()}
    assert got == {("r1", "r2"), ("r5", "r6"), ("r1", "r7")}
