"""Checks whose findings are rows: (rule, subject, detail).  An empty result is a pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, subject: str, rules: dict[str, Column]) -> DataFrame:
    """A row for each rule that a row breaks; a rule is a condition that must hold, null counts as broken."""
    found = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return df.select(F.explode(found).alias("rule"), F.col(subject).cast("string").alias("subject"), F.lit(None).cast("string").alias("detail"))


def repeated_keys(df: DataFrame, subject: str, arrays: list[str]) -> DataFrame:
    """Keys of the array columns that several rows hold."""
    parts = None
    for a in arrays:
        part = df.select(F.lit(a).alias("kind"), F.explode(F.array_distinct(F.array_compact(F.col(a)))).alias("key"), F.col(subject).alias("holder"))
        parts = part if parts is None else parts.union(part)
    held = parts.groupBy("kind", "key").agg(F.count_distinct("holder").alias("n")).where("n > 1")
    return held.select(F.concat(F.lit("key held by several rows: "), F.col("kind")).alias("rule"), F.col("key").alias("subject"), F.col("n").cast("string").alias("detail"))


def missing_references(df: DataFrame, subject: str, column: str, target: DataFrame, target_key: str) -> DataFrame:
    """Rows whose non-null reference has no target."""
    lost = df.where(F.col(column).isNotNull()).join(target.select(F.col(target_key).alias(column)).distinct(), column, "left_anti")
    return lost.select(F.lit(f"{column} refers to nothing").alias("rule"), F.col(subject).cast("string").alias("subject"), F.col(column).cast("string").alias("detail"))


def counts_agree(rows: DataFrame, expected: dict[str, tuple[Column, int]]) -> DataFrame:
    """Expected counts that the rows don't have; all are taken in one pass."""
    got = rows.agg(*(F.count_if(c).alias(n) for n, (c, _) in expected.items()))
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("subject"), F.col(n).alias("got"), F.lit(e).alias("want")) for n, (_, e) in expected.items()))).alias("x")
    return got.select(each).where("x.got <> x.want").select(F.lit("count differs").alias("rule"), "x.subject", F.concat(F.col("x.got").cast("string"), F.lit(" instead of "), F.col("x.want").cast("string")).alias("detail"))


def coverage(retired: DataFrame, key: str, keys: str, holders: DataFrame, least: float = 0.9) -> DataFrame:
    """(key, held, all, share) of retired rows less than ``least`` of whose keys current rows hold."""
    pairs = retired.select(key, F.explode(F.array_distinct(F.array_compact(F.col(keys)))).alias("_k"))
    current = holders.select(F.explode(F.array_compact(F.col(keys))).alias("_k")).distinct().withColumn("_held", F.lit(1))
    rates = pairs.join(current, "_k", "left").groupBy(key).agg(F.count("_held").alias("held"), F.count("*").alias("all"))
    return rates.withColumn("share", F.col("held") / F.col("all")).where(F.col("share") < least)


def split_keys(before: DataFrame, after: DataFrame) -> DataFrame:
    """(old_id, new_ids): old ids whose keys now belong to several new ids; both sides are (key, id)."""
    both = before.select("key", F.col("id").alias("old_id")).join(after.select("key", F.col("id").alias("new_id")), "key")
    return both.groupBy("old_id").agg(F.array_sort(F.collect_set("new_id")).alias("new_ids")).where("size(new_ids) > 1")


def yield_kept(new: DataFrame, old: DataFrame, by: str, least: float = 0.9) -> DataFrame:
    """(by, old, new): groups that shrank below ``least`` of their former size."""
    a = old.groupBy(by).agg(F.count("*").alias("old"))
    b = new.groupBy(by).agg(F.count("*").alias("new"))
    return a.join(b, by, "left").select(by, "old", F.coalesce("new", F.lit(0)).alias("new")).where(F.col("new") < least * F.col("old"))
