"""Filling containers of fixed capacity with texts.

Texts go, largest first, each into the fullest container that it still fits and that holds nothing it
conflicts with.  Containers are kept in the order of their free space and carry bitmaps of the sources
and duplicate clusters in them; from the tightest container on, the search goes to the next roomier one
until a compatible one is found.  The table is cut by hash into groups of a bounded number of texts that
are packed independently; a group leaves at most a few containers part empty out of thousands.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.tokens import VOCABULARY, token_counts
from quernstone.plans.lineage import cut

#: Texts in a group on average; 3,000 containers of 2,048 tokens at 600 tokens a text.
GROUP_TEXTS = 10_000


def best_fit(items: list[tuple[int, int, int]], capacity: int, conflicts: dict[int, int]) -> list[int]:
    """The container of each item (size, source bit, cluster bit); sizes are at most the capacity.

    ``conflicts`` maps a source bit to the bits of sources that may not share a container with it.
    """
    place = [0] * len(items)
    free: list[tuple[int, int]] = []  # (free space, container), in order
    sources: list[int] = []
    clusters: list[int] = []
    for at in sorted(range(len(items)), key=lambda i: (-items[i][0], i)):
        size, source, cluster = items[at]
        barred = conflicts.get(source, 0)
        k = bisect_left(free, (size, -1))
        while k < len(free) and (sources[free[k][1]] & barred or clusters[free[k][1]] & cluster):
            k += 1
        if k < len(free):
            room, container = free.pop(k)
        else:
            room, container = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[container] |= source
        clusters[container] |= cluster
        place[at] = container
        insort(free, (room - size, container))
    return place


def _pack(conflicts: dict[str, list[str]], kind: pa.DataType):
    """Packs a group.  Columns in: limit_name, capacity, group, id, source, cluster, tokens."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("cluster", "ascending")])
        names, capacities, groups, ids, sources, clusters, tokens = (table.column(i).to_pylist() for i in range(7))
        capacity = capacities[0]
        bit = {s: 1 << i for i, s in enumerate(sorted({*(s or "" for s in sources), *conflicts, *(x for v in conflicts.values() for x in v)}))}
        barred = {bit[s]: sum(bit[x] for x in others) for s, others in conflicts.items()}
        for s, others in conflicts.items():
            for x in others:
                barred[bit[x]] = barred.get(bit[x], 0) | bit[s]
        several = [c for c, n in Counter(clusters).items() if n > 1]
        cluster_bit = {c: 1 << i for i, c in enumerate(several)}
        full, rows, items = 0, [], []
        for i, size in enumerate(tokens):
            start = 0
            while size - start > capacity:  # a text beyond the capacity fills containers of its own
                rows.append((ids[i], start // capacity, start, capacity, full))
                start, full = start + capacity, full + 1
            items.append((size - start, bit[sources[i] or ""], cluster_bit.get(clusters[i], 0)))
            rows.append((ids[i], start // capacity, start, size - start, None))
        places = iter(best_fit(items, capacity, barred))
        rows = [(*r[:4], full + next(places) if r[4] is None else r[4]) for r in rows]
        n = len(rows)
        container = [f"{names[0]}-{groups[0]}-{r[4]}" for r in rows]
        return pa.table(
            {
                "limit_name": pa.array([names[0]] * n, pa.string()),
                "capacity_tokens": pa.array([capacity] * n, pa.int32()),
                "container": pa.array(container, pa.string()),
                "id": pa.array([r[0] for r in rows], kind),
                "piece": pa.array([r[1] for r in rows], pa.int32()),
                "first_token": pa.array([r[2] for r in rows], pa.int32()),
                "tokens": pa.array([r[3] for r in rows], pa.int32()),
            }
        )

    return run


def pack_texts(
    df: DataFrame,
    limits: DataFrame,
    id_column: str,
    text_column: str,
    source_column: str,
    conflicts: dict[str, list[str]] | None = None,
    group_texts: int = GROUP_TEXTS,
    vocabulary: str = VOCABULARY,
    clusters: DataFrame | None = None,
) -> DataFrame:
    """(limit_name, capacity_tokens, container, id, piece, first_token, tokens): where each text lies.

    Every row of the table lies once in each limit's containers, a text beyond the capacity in pieces of
    which only the last shares a container.  Texts that are equal but for case and outer blanks are one
    duplicate cluster and never share a container; neither do sources named in ``conflicts``.  ``clusters``
    (id, group_id) names wider ones, such as groups of near-duplicates; ids in none go by their text.  Texts of
    no tokens take no room.  Null ids and sources are allowed; limits that are null or below 1 give no
    rows; other columns are ignored, whatever their names.
    """
    spark = df.sparkSession
    sized = cut(token_counts(df, [F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"), F.xxhash64(F.lower(F.trim(F.coalesce(F.col(text_column), F.lit(""))))).alias("cluster")], text_column, vocabulary), "tokens")
    if clusters is not None:
        wider = clusters.select("id", F.xxhash64(F.lit("group"), "group_id").alias("wider")).dropDuplicates(["id"])
        sized = cut(sized.join(wider, "id", "left").withColumn("cluster", F.coalesce("wider", "cluster")).drop("wider"), "tokens")
    groups = max(1, round(sized.count() / group_texts))
    kind = sized.schema["id"].dataType.simpleString()
    # Limits are a configuration of a few rows.
    few = [(str(r[0]), int(r[1])) for r in limits.select("limit_name", "capacity_tokens").where("limit_name IS NOT NULL AND capacity_tokens >= 1").distinct().collect()]
    if not few:
        few = [("", 0)]
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("limit_name"), F.lit(c).alias("capacity")) for n, c in few)))
    rows = sized.select(each.alias("limit"), F.pmod(F.xxhash64("id", "cluster"), F.lit(groups)).cast("int").alias("group"), "id", "source", "cluster", "tokens").select("limit.*", "group", "id", "source", "cluster", "tokens").where("capacity >= 1")
    from pyspark.sql.pandas.types import to_arrow_type

    packed = rows.groupBy("limit_name", "group").applyInArrow(_pack(conflicts or {}, to_arrow_type(sized.schema["id"].dataType)), f"limit_name string, capacity_tokens int, container string, id {kind}, piece int, first_token int, tokens int")
    return packed


def fill_rates(packed: DataFrame) -> DataFrame:
    """(limit_name, capacity_tokens, containers, tokens, fill): how much of the containers' room is used."""
    sums = packed.groupBy("limit_name", "capacity_tokens").agg(F.count_distinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    return sums.withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
