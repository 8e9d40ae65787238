"""Joins on the elements of array columns against side tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best_of_elements(df: DataFrame, key: str, array: str, side: DataFrame, side_key: str, aggregates: dict[str, Column]) -> DataFrame:
    """The rows with aggregates over the side table's rows for any of their elements; null where none is found.

    Only key and element travel; the aggregation runs before the join back.
    """
    pairs = df.select(key, F.explode(F.array_distinct(F.array_compact(F.col(array)))).alias(side_key))
    found = pairs.join(side, side_key).groupBy(key).agg(*(c.alias(n) for n, c in aggregates.items()))
    return df.join(found, key, "left")


def first_hit(df: DataFrame, key: str, array: str, side: DataFrame, side_key: str, fields: list[str]) -> DataFrame:
    """The rows with the side table's fields for their first element that has any, where the field isn't null.

    Fields of the same name are overridden by non-null values.
    """
    pairs = df.select(key, F.posexplode(F.col(array)).alias("_pos", side_key)).where(F.col(side_key).isNotNull())
    hit = pairs.join(side, side_key).groupBy(key).agg(F.min_by(F.struct(*fields), "_pos").alias("_hit"))
    joined = df.join(hit, key, "left")
    for f in fields:
        joined = joined.withColumn(f, F.coalesce(F.col(f"_hit.{f}"), F.col(f)) if f in df.columns else F.col(f"_hit.{f}"))
    return joined.drop("_hit")


def subset_state(df: DataFrame, key: str, array: str, marked: DataFrame, marked_key: str) -> DataFrame:
    """The rows with ``marked`` (their marked elements, sorted) and ``all_marked``, false for rows without elements."""
    pairs = df.select(key, F.explode(F.array_distinct(F.array_compact(F.col(array)))).alias(marked_key))
    hits = pairs.join(marked.select(marked_key).distinct(), marked_key, "left_semi").groupBy(key).agg(F.array_sort(F.collect_set(marked_key)).alias("marked"))
    size = F.size(F.array_distinct(F.array_compact(F.coalesce(F.col(array), F.array().cast("array<string>")))))
    joined = df.join(hits, key, "left").withColumn("marked", F.coalesce("marked", F.array().cast("array<string>")))
    return joined.withColumn("all_marked", (size > 0) & (F.size("marked") == size))


def without_any(df: DataFrame, key: str, array: str, denied: DataFrame, denied_key: str) -> DataFrame:
    """The rows none of whose elements is denied."""
    pairs = df.select(key, F.explode(F.array_compact(F.col(array))).alias(denied_key))
    bad = pairs.join(denied.select(denied_key).distinct(), denied_key, "left_semi").select(key).distinct()
    return df.join(bad, key, "left_anti")


def by_priority(rows: DataFrame, key: str, probes: list[tuple[str, DataFrame, str]], id_column: str) -> DataFrame:
    """(key, kind, id): for each row the first kind of probe that finds something, and the smallest id found.

    A probe is (kind, table of probe key and id, column of ``rows`` with the probe key or an array of them).
    """
    found = None
    for rank, (kind, table, column) in enumerate(probes):
        is_array = rows.schema[column].dataType.simpleString().startswith("array")
        probe = rows.select(key, F.explode(F.col(column)).alias("_k") if is_array else F.col(column).alias("_k")).where(F.col("_k").isNotNull())
        # The two smallest ids of a probe key, by partial aggregation: one of them is the smallest other id.
        ids = table.toDF("_k", "_id").where("_k IS NOT NULL").groupBy("_k").agg(F.min("_id").alias("_least"), F.max("_id").alias("_most"))
        next_ids = table.toDF("_k", "_id").join(ids.where("_least <> _most").select("_k", "_least"), "_k").where("_id <> _least").groupBy("_k").agg(F.min("_id").alias("_second"))
        known = ids.join(next_ids, "_k", "left")
        other = F.when(F.col("_least") != F.col(key), F.col("_least")).otherwise(F.col("_second"))
        hits = probe.join(known, "_k").select(key, F.lit(rank).alias("_rank"), F.lit(kind).alias("kind"), other.alias("_id")).where(F.col("_id").isNotNull())
        found = hits if found is None else found.unionByName(hits)
    best = found.groupBy(key).agg(F.min(F.struct("_rank", "kind", "_id")).alias("_b"))
    return best.select(key, "_b.kind", F.col("_b._id").alias(id_column))


def with_parent_fallback(codes: Column, mapping: Column) -> Column:
    """Values mapped from codes such as X.12.3, by the code itself or else by its parent X.12; sorted, each once."""
    empty = F.array().cast("array<string>")
    parent = lambda c: F.regexp_replace(c, r"\.[^.]*$", "")
    found = F.transform(F.coalesce(codes, empty), lambda c: F.coalesce(F.try_element_at(mapping, c), F.try_element_at(mapping, parent(c)), empty))
    return F.array_sort(F.array_distinct(F.flatten(found)))
