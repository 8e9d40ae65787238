"""Differences between two states of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, change): added, removed or changed, by a hash of all common columns; arrays as sets don't differ by order."""
    shared = [c for c in before.columns if c in after.columns and c != key]

    def hashed(df: DataFrame, name: str) -> DataFrame:
        cells = [F.to_json(F.array_sort(F.col(c))) if df.schema[c].dataType.typeName() == "array" and df.schema[c].dataType.elementType.typeName() == "string" else F.to_json(F.struct(c)) for c in shared]
        return df.select(key, F.sha2(F.concat_ws("\x1f", *(F.coalesce(c, F.lit("\0")) for c in cells)), 256).alias(name))

    both = hashed(before, "_b").join(hashed(after, "_a"), key, "full_outer")
    kind = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    return both.select(key, kind.alias("change")).where("change IS NOT NULL")


def changed_fields(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, old, new): each differing field of keys on both sides, values as JSON text."""
    text = lambda side, f: F.to_json(F.struct(F.col(f"{side}.{f}").alias("v")))
    both = before.select(key, *fields).alias("b").join(after.select(key, *fields).alias("a"), key)
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), text("b", f).alias("old"), text("a", f).alias("new")) for f in fields))).alias("d")
    value = lambda c: F.regexp_extract(c, r"(?s)^\{\"v\":(.*)\}$", 1)
    return both.select(key, each).where(F.col("d.old") != F.col("d.new")).select(key, "d.field", F.nullif(value(F.col("d.old")), F.lit("")).alias("old"), F.nullif(value(F.col("d.new")), F.lit("")).alias("new"))


def field_counts(changes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many keys differ in each field, most first."""
    return changes.groupBy("field", *(by or [])).agg(F.count("*").alias("n"))


def set_difference(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """(value, side): values on one side only."""
    a, b = before.select(column).distinct(), after.select(column).distinct()
    return a.join(b, column, "left_anti").select(F.col(column).alias("value"), F.lit("removed").alias("side")).union(b.join(a, column, "left_anti").select(F.col(column), F.lit("added")))


def code_census(df: DataFrame, array: str) -> DataFrame:
    """(code, n): the multiset of codes in an array column."""
    return df.select(F.explode(F.array_compact(F.col(array))).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


def same_multiset(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows equally often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def is_prefix(old: DataFrame, new: DataFrame, seq: str) -> DataFrame:
    """Rows of an append-only log that are missing or different in its later version, by seq."""
    rest = [c for c in old.columns if c != seq]
    row = lambda df, n: df.select(seq, F.to_json(F.struct(*rest)).alias(n))
    return row(old, "old").join(row(new, "new"), seq, "left").where(~F.col("old").eqNullSafe(F.col("new")))
