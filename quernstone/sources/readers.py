"""Readers of the feeds' shapes: enveloped JSON, typed CSV with odd headers, XML records, archives, tables in text."""

from __future__ import annotations

import csv
import io
import json
import tarfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class FeedShapeError(ValueError):
    """A feed whose shape is not one of those agreed."""


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType | str, row_keys: tuple[str, ...] = ("incidents", "entries", "data")) -> DataFrame:
    """Rows of JSON feed files: a bare array, or an object with exactly one non-empty row key.

    Each file is one row of text until its rows are exploded, as the format demands; ``file`` and ``pos``
    keep the order.  Files of another shape, unreadable ones and null rows raise FeedShapeError's message
    when the rows are read, so that no feed vanishes silently.
    """
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.trim("value").alias("text"))
    bare = F.from_json("text", T.ArrayType(kind))
    wrapped = F.from_json("text", T.StructType([T.StructField(k, T.ArrayType(kind)) for k in row_keys]))
    held = [F.when(F.size(wrapped[k]) > 0, wrapped[k]) for k in row_keys]
    filled = sum((h.isNotNull().cast("int") for h in held), F.lit(0))
    present = sum((wrapped[k].isNotNull().cast("int") for k in row_keys), F.lit(0))
    rows = F.when(F.startswith("text", F.lit("[")), bare).when(filled == 1, F.coalesce(*held)).when((filled == 0) & (present > 0), F.array().cast(T.ArrayType(kind)))
    checked = F.coalesce(rows, F.raise_error(F.concat(F.lit("feed has no agreed row key: "), F.col("file"))).cast(T.ArrayType(kind)))
    return files.select("file", F.posexplode(checked).alias("pos", "row")).select("file", "pos", "row.*")


def read_json_map(spark: SparkSession, path: str, value: T.DataType | str, key: str = "key") -> DataFrame:
    """(key, value fields): the entries of a JSON object keyed by data; keys that start with _ are metadata.

    A file that holds no JSON object raises FeedShapeError's message when the rows are read; one without any
    bytes has no entries.
    """
    kind = T._parse_datatype_string(value) if isinstance(value, str) else value
    entries = F.from_json("value", T.MapType(T.StringType(), kind))
    checked = F.coalesce(entries, F.raise_error(F.concat(F.lit("feed is no JSON object: "), F.col("_metadata.file_name"))).cast(T.MapType(T.StringType(), kind)))
    rows = spark.read.text(path, wholetext=True).select(F.explode(checked).alias(key, "v")).where(~F.startswith(F.col(key), F.lit("_")))
    return rows.select(key, "v.*") if isinstance(kind, T.StructType) else rows.withColumnRenamed("v", "value")


def ordered_union(frames: list[DataFrame], order: list[str]) -> DataFrame:
    """All rows with ``rank`` of their table and the order columns, columns of every table, null where missing."""
    out = None
    for rank, df in enumerate(frames):
        ranked = df.withColumn("rank", F.lit(rank))
        out = ranked if out is None else out.unionByName(ranked, allowMissingColumns=True)
    return out.select("rank", *order, *(c for c in out.columns if c not in ("rank", *order)))


def header_map(rows: list[list[str]], aliases: dict[str, list[str]], required: list[str]) -> dict[str, int]:
    """Column numbers by logical name from one or two header rows; a lower row's non-empty cell overrides.

    Names are compared trimmed and without regard to case.  A missing required column is an error.
    """
    width = max(len(r) for r in rows)
    heads = [next((r[i].strip().lower() for r in reversed(rows) if i < len(r) and r[i].strip()), "") for i in range(width)]
    found = {name: next((heads.index(a.lower()) for a in [name, *options] if a.lower() in heads), None) for name, options in aliases.items()}
    missing = [n for n in required if found.get(n) is None]
    if missing:
        raise FeedShapeError(f"columns are missing: {', '.join(missing)}")
    return {n: i for n, i in found.items() if i is not None}


def read_csv_by_header(spark: SparkSession, path: str, aliases: dict[str, list[str]], required: list[str], header_rows: int = 1) -> DataFrame:
    """A CSV's rows under logical names, whatever the columns' order and spelling; all values are strings."""
    raw = spark.read.option("header", False).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    heads = [["" if x is None else x for x in r] for r in raw.limit(header_rows).collect()]
    columns = header_map(heads, aliases, required)
    # The header's own rows are recognised by content: no row number exists in a distributed read.
    same = [F.concat_ws("\x1f", *(F.coalesce(F.col(c), F.lit("")) for c in raw.columns)) == "\x1f".join(h + [""] * (len(raw.columns) - len(h))) for h in heads]
    body = raw
    for s in same:
        body = body.where(~s)
    return body.select(*(F.trim(F.col(raw.columns[i])).alias(n) for n, i in columns.items()))


def read_xml_records(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One row per element; files with document types or entities are refused by the parser's settings."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def _members(allowed: str | None, largest: int):
    import re

    wanted = re.compile(allowed) if allowed else None

    def fits(archive: str, member: str, size: int) -> None:
        if size > largest:
            raise FeedShapeError(f"{member} in {archive} has {size} bytes, more than the limit of {largest}")

    def files(name: str, content: bytes):
        if zipfile.is_zipfile(io.BytesIO(content)):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for info in z.infolist():
                    if info.is_dir():
                        continue
                    if info.filename.endswith(".zip") or not wanted or wanted.search(info.filename):
                        fits(name, info.filename, info.file_size)
                        data = z.read(info)
                        if info.filename.endswith(".zip"):
                            yield from files(f"{name}!{info.filename}", data)
                        else:
                            yield info.filename, data
        else:
            with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as t:
                for info in t:
                    if info.isfile() and (not wanted or wanted.search(info.name)):
                        fits(name, info.name, info.size)
                        yield info.name, t.extractfile(info).read()

    def run(batches):
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for name, data in files(archive, content):
                    yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([name]), pa.array([data], pa.binary())], names=["archive", "member", "content"])

    return run


def read_archives(spark: SparkSession, path: str, member_pattern: str | None = None, largest_member: int = 256 << 20) -> DataFrame:
    """(archive, member, content) of the files in ZIP and TAR archives, ZIPs inside ZIPs included.

    Archives are read in parallel, each by one task, as their formats ask.  Members that don't match the
    pattern are left out; one of more than ``largest_member`` bytes is an error, as it would not fit into a
    task.  Nothing is written to disk.
    """
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_members(member_pattern, largest_member), "archive string, member string, content binary")


def _csv_lines(batches):
    for batch in batches:
        for member, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = [json.dumps(r) for r in csv.DictReader(io.StringIO(content.decode("utf-8-sig", "replace")))]
            yield pa.RecordBatch.from_arrays([pa.array([member] * len(rows), pa.string()), pa.array(rows, pa.string())], names=["member", "row"])


def csv_members(archives: DataFrame, schema: str) -> DataFrame:
    """Rows of CSV members, by header, with the schema's fields; others are dropped."""
    return archives.select("member", "content").mapInArrow(_csv_lines, "member string, row string").select("member", F.from_json("row", schema).alias("r")).select("member", "r.*")


def json_members(archives: DataFrame, schema: str) -> DataFrame:
    """One row per JSON member."""
    return archives.select("member", F.from_json(F.decode("content", "UTF-8"), schema).alias("r")).select("member", "r.*")


def read_pipe_tables(spark: SparkSession, path: str, columns: int) -> DataFrame:
    """(cells, urls) of the body rows of Markdown pipe tables with that many columns; rows without a link are left out."""
    line = F.trim("value")
    cells = F.transform(F.split(F.regexp_replace(line, r"^\||\|$", ""), r"(?<!\\)\|"), lambda c: F.trim(c))
    rows = spark.read.text(path).where(F.startswith(line, F.lit("|")) & ~line.rlike(r"^\|[\s:|-]+\|?$")).select(cells.alias("cells"), F.regexp_extract_all("value", F.lit(r"\]\((https?://[^)\s]+)\)")).alias("urls"))
    return rows.where((F.size("cells") == columns) & (F.size("urls") > 0))


def embedded_state(html: Column, script_id: str) -> Column:
    """The JSON text in a page's script element with the id; null where there is none or it isn't JSON."""
    body = F.regexp_extract(html, rf"(?s)<script[^>]*id=\"{script_id}\"[^>]*>(.+?)</script>", 1)
    return F.when(F.try_parse_json(body).isNotNull(), F.nullif(body, F.lit("")))
