"""Writers: datasets by year, JSON lines, CSV for spreadsheets, checksums of written trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_by(df: DataFrame, path: str, column: str, kind: str = "parquet") -> None:
    """One folder per value of the column; rows are first brought together so that files stay few.

    The hint lets adaptive execution split a value that holds much of the table over several tasks.
    """
    df.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).format(kind).save(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """JSON lines with sorted keys; null fields are absent."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def spreadsheet_rows(df: DataFrame) -> DataFrame:
    """The table with arrays joined by "; " and everything else as text, ready for CSV."""
    cell = lambda f: F.array_join(F.col(f.name), "; ") if isinstance(f.dataType, T.ArrayType) else F.col(f.name).cast("string")
    return df.select(*(cell(f).alias(f.name) for f in df.schema))


def write_csv(df: DataFrame, path: str) -> None:
    """RFC 4180 CSV with CRLF line ends and a byte order mark for spreadsheets, quoted where needed."""
    from quernstone.functions.text import csv_cell

    text = spreadsheet_rows(df)
    line = F.concat(F.concat_ws(",", *(csv_cell(F.col(c)) for c in text.columns)), F.lit("\r"))
    head = df.sparkSession.createDataFrame([("﻿" + ",".join(text.columns) + "\r",)], "value string")
    head.write.mode("overwrite").text(f"{path}/head")
    text.select(line.alias("value")).write.mode("overwrite").text(f"{path}/body")


def split_columns(df: DataFrame, key: str, core: list[str], shard: str) -> tuple[DataFrame, DataFrame]:
    """A table of core columns, and one of all others keyed for writing by shard."""
    return df.select(key, *core), df.select(key, shard, *(c for c in df.columns if c not in {key, shard, *core}))


def checksums(df_path: str, spark) -> DataFrame:
    """(file, bytes, sha256) of all files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(df_path)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify_checksums(listed: DataFrame, found: DataFrame) -> DataFrame:
    """(file, finding): files that differ, are missing or aren't listed."""
    both = listed.select("file", F.col("sha256").alias("want")).join(found.select("file", F.col("sha256").alias("got")), "file", "full_outer")
    finding = F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "unlisted").when(F.col("want") != F.col("got"), "mismatch")
    return both.select("file", finding.alias("finding")).where("finding IS NOT NULL")
