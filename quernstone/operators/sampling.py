"""Stratified frames, proportional allocation, systematic draws, rotating samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.operators.identity import ranked

#: A family with less than this share of its tier is pooled.
POOLED = 0.02


def frame(df: DataFrame, tier: Column, family: Column, pooled: float = POOLED, other: str = "other") -> DataFrame:
    """The rows with tier and family, small families of a tier pooled as ``other``, and stratum tier/family."""
    rows = df.withColumn("tier", tier).withColumn("family", family)
    per = rows.groupBy("tier", "family").agg(F.count("*").alias("n"))
    whole = per.groupBy("tier").agg(F.sum("n").alias("all"))
    named = per.join(whole, "tier").select("tier", "family", F.when(F.col("n") < pooled * F.col("all"), other).otherwise(F.col("family")).alias("pooled"))
    # One row per family of a tier: a dimension, so the frame itself is not shuffled where it is small.
    joined = rows.join(named.withColumnsRenamed({"tier": "_t", "family": "_f"}), F.col("tier").eqNullSafe(F.col("_t")) & F.col("family").eqNullSafe(F.col("_f"))).drop("_t", "_f", "family").withColumnRenamed("pooled", "family")
    return joined.withColumn("stratum", F.concat_ws("/", "tier", "family"))


def allocate(strata: DataFrame, total: int) -> DataFrame:
    """(stratum, size, quota): ``total`` split in proportion to size by largest remainders.

    Ties go to the larger stratum, then to the smaller name.  ``strata`` has a row per stratum.
    """
    exact = F.lit(total) * F.col("size") / strata.agg(F.sum("size")).scalar()
    parts = strata.select("stratum", "size", exact.alias("exact")).withColumn("floor", F.floor("exact"))
    left = F.lit(total) - parts.agg(F.sum("floor")).scalar()
    order = Window.orderBy(F.desc(F.round(F.col("exact") - F.col("floor"), 9)), F.desc("size"), "stratum")
    rank = F.row_number().over(order)
    return parts.withColumn("rank", rank).select("stratum", "size", (F.col("floor") + (F.col("rank") <= left).cast("int")).cast("bigint").alias("quota"))


def systematic(rows: DataFrame, quotas: DataFrame, order: list[str], seed: int) -> DataFrame:
    """In each stratum every size/quota-th row in order, from a start that the seed and the stratum fix.

    The start is a share of the step, from the MD5 of seed and stratum.  Rows are ranked over all strata by
    ranges, so that no task sorts a whole stratum, and a stratum's first rank is taken off.  A row's stratum
    and order must be distinct and not null.
    """
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("stratum"))), 1, 12), 16, 10).cast("double") / float(1 << 48)
    step = F.col("size") / F.col("quota")
    picks = quotas.where("quota > 0").select("stratum", F.explode(F.transform(F.sequence(F.lit(0), F.col("quota") - 1), lambda i: F.floor((start + i) * step))).alias("_place"))
    placed = ranked(rows.withColumn("_key", F.struct("stratum", *order)), "_key")
    firsts = placed.groupBy("stratum").agg(F.min("rank").alias("_first"))
    return placed.join(picks.join(firsts, "stratum").select((F.col("_first") + F.col("_place")).alias("rank")), "rank").drop("rank", "_key")


def rotating(df: DataFrame, value: str, cursor: int | None, k: int) -> DataFrame:
    """The next k rows by value after the cursor, starting over at the end; null cursor starts at the beginning."""
    later = F.lit(False) if cursor is None else F.col(value) <= cursor
    return df.orderBy(later.cast("int"), value).limit(k)


def first_not_in(df: DataFrame, excluded: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """The first k rows in order whose key is not excluded."""
    return df.join(excluded.select(key).distinct(), key, "left_anti").orderBy(order, key).limit(k)


def rotation_order(checked: Column, version: Column, current: str, key: Column) -> list[Column]:
    """Sort keys of a sweep: never checked first, then other versions, then the stalest."""
    bucket = F.when(checked.isNull(), 0).when(~version.eqNullSafe(F.lit(current)), 1).otherwise(2)
    return [bucket.asc(), checked.asc_nulls_first(), key.asc()]
