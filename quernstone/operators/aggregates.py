"""Counts and reports: per array element, zero-filled, pivoted, top-k with stable ties, bucketed, digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def element_counts(df: DataFrame, array: str, name: str = "element") -> DataFrame:
    """(element, n): in how many rows each element of the array column stands; repetitions in a row count once."""
    return df.select(F.explode(F.array_distinct(F.array_compact(F.col(array)))).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def zero_filled(counts: DataFrame, column: str, values: list, number: str = "n") -> DataFrame:
    """The counts with a row for each of ``values``, 0 where there was none; others are dropped."""
    every = counts.sparkSession.createDataFrame([(v,) for v in values], f"{column} {counts.schema[column].dataType.simpleString()}")
    return F.broadcast(every).join(counts, column, "left").select(column, F.coalesce(number, F.lit(0)).alias(number))


def top(df: DataFrame, column: Column, order: Column, k: int, name: str = "value") -> DataFrame:
    """(value, n): the k most frequent values; ties in the order of first appearance."""
    counts = df.select(column.alias(name), order.alias("_o")).where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"), F.min("_o").alias("_first"))
    return counts.orderBy(F.desc("n"), "_first", name).limit(k).select(name, "n")


def crosstab(df: DataFrame, rows: str, columns: str, values: list) -> DataFrame:
    """Counts of each row value by the given column values, 0 where there are none."""
    return df.groupBy(rows).pivot(columns, values).agg(F.count(F.lit(1))).na.fill(0)


def bucket(value: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """The name of the first edge that the value doesn't exceed, else ``last``."""
    case = F.when(value <= edges[0][0], edges[0][1])
    for edge, name in edges[1:]:
        case = case.when(value <= edge, name)
    return F.when(value.isNotNull(), case.otherwise(last))


def digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """(rows, digest): an order-free fingerprint of a table's content, by partial aggregation.

    Parts of the MD5 of each row's JSON text go into a sum and an exclusive or, so equal content gives equal
    digests in any order and layout, and repeated rows count.
    """
    hashed = F.md5(F.to_json(F.struct(*columns)))
    part = lambda at: F.conv(F.substring(hashed, at, 12), 16, 10)
    row = df.select(part(1).cast("decimal(20,0)").alias("d"), part(13).cast("bigint").alias("h"))
    return row.agg(F.count("*").alias("rows"), F.coalesce(F.expr("bit_xor(h)"), F.lit(0)).alias("x"), F.coalesce(F.sum("d"), F.lit(0)).alias("s")).select("rows", F.sha2(F.concat_ws("/", F.col("rows").cast("string"), F.col("x").cast("string"), F.col("s").cast("string")), 256).alias("digest"))
