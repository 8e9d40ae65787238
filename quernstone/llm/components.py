"""Groups from pairwise matches: connected components by hash-to-min.

A vertex's cluster set is kept as rows (vertex, member), never as one value, so a component of any size
is spread over the cluster.  In each round every vertex sends its set to the set's minimum and the minimum
to all others; rounds go on until nothing changes.  Then each vertex holds its component's minimum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.plans.lineage import Cut, cut

#: Hash-to-min needs about log2 of the longest path; more rounds than this mean a fault.
MOST_ROUNDS = 200


def ties_of_values(df: DataFrame, id_column: str, values: Column) -> DataFrame:
    """(a, b): each record tied to the smallest record that shares a value with it.

    One row per record and value, however many records share the value; null ids and values tie nothing.
    The values are taken from the records once and written to a table, which costs less than to take them twice.
    """
    held = cut(df.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), F.explode(values).alias("value")).where("value IS NOT NULL"), "values")
    heads = held.groupBy("value").agg(F.min("id").alias("head"), F.max("id").alias("last")).where("head <> last").select("value", "head")
    return held.join(heads, "value").where("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()


def _state(rows: DataFrame) -> tuple:
    return tuple(rows.agg(F.count("*"), F.expr("bit_xor(xxhash64(vertex, member))")).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, group_id) of every vertex that an edge joins to another one; group_id is the smallest id.

    Edges may be repeated, reversed or loops; those with a null end are left out.  No edges, no rows.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("vertex"), F.col("b").alias("member")), F.struct(F.col("b").alias("vertex"), F.col("a").alias("member")), F.struct(F.col("a").alias("vertex"), F.col("a").alias("member")), F.struct(F.col("b").alias("vertex"), F.col("b").alias("member")))).alias("x")).select("x.*")
    now = Cut(both.distinct(), "clusters")
    state = _state(now.read())
    for _ in range(MOST_ROUNDS):
        rows = now.read()
        # A vertex that is its set's minimum may hold a whole component: it is left out of the
        # aggregation and of the join's right side, and its rows are spread by adaptive skew handling.
        lower = rows.where("member < vertex").groupBy("vertex").agg(F.min("member").alias("low"))
        sent = rows.join(lower, "vertex", "left").select("member", F.coalesce("low", "vertex").alias("low"))
        step = sent.select(F.explode(F.array(F.struct(F.col("member").alias("vertex"), F.col("low").alias("member")), F.struct(F.col("low").alias("vertex"), F.col("member").alias("member")))).alias("x")).select("x.*").distinct()
        after = Cut(step, "clusters")
        new = _state(after.read())
        now.drop()
        now = after
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("the groups did not become stable")
    return now.read().groupBy("vertex").agg(F.min("member").alias("group_id")).select(F.col("vertex").alias("id"), "group_id")
