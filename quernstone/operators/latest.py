"""One row per key: the last received, the first in order, or fresh over old."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[Column] | str) -> DataFrame:
    """The row with the greatest order for each key, whole.  Equal orders go to the greater content hash.

    A partial aggregation, not a window: a hot key is reduced before the shuffle.
    """
    order = [F.col(order)] if isinstance(order, str) else order
    tie = F.xxhash64(*(F.to_json(F.struct(*df.columns)),))
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, tie)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row with the least order for each key, whole; equal ones are told apart by the hash of their values."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order, F.xxhash64(F.to_json(F.struct(*rest))))).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def upsert(fresh: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Fresh rows, and old ones whose keys no fresh row has; columns missing on one side are null."""
    return fresh.unionByName(old.join(fresh.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def retained(old: DataFrame, fresh: DataFrame, keys: list[str], mark: str, value: str) -> DataFrame:
    """Fresh rows and those old ones that are gone, the latter with ``mark`` set to ``value``."""
    gone = old.join(fresh.select(*keys).distinct(), keys, "left_anti").withColumn(mark, F.lit(value))
    return fresh.unionByName(gone, allowMissingColumns=True)
