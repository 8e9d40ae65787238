"""Queries through the readers and writers: tables written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quernstone.plans.lineage import shared_folder
from quernstone.plans.queries_records import INC, incidents
from quernstone.plans.registry import Registry, table
from quernstone.sources import readers, writers

REGISTRY = Registry()


def _place(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _one_text(df, at: str) -> str:
    """Writes a frame's single string column as text, one file of one line for the products' 600 rows."""
    df.coalesce(1).write.mode("overwrite").text(at)
    return f"{at}/part-*"


_PRODUCT = ["package", "vendor", "product", "ecosystem"]


@REGISTRY.add("json_feed_rows", "SELECT package, vendor, product, ecosystem FROM products")
def json_feed_rows(spark, folder):
    """An enveloped JSON feed, read by its row key."""
    rows = table(spark, folder, "products").agg(F.to_json(F.struct(F.lit("x").alias("source"), F.collect_list(F.struct(*_PRODUCT)).alias("entries"))).alias("value"))
    at = _one_text(rows, _place(spark, "feed"))
    return readers.read_json_rows(spark, at, ", ".join(f"{c} string" for c in _PRODUCT)).select(*_PRODUCT)


@REGISTRY.add("json_map_rows", "SELECT package, any_value(ecosystem) AS ecosystem FROM products WHERE package IS NOT NULL AND package NOT LIKE '\\_%' ESCAPE '\\' GROUP BY package")
def json_map_rows(spark, folder):
    """A side table kept as a JSON object by key."""
    entries = table(spark, folder, "products").where("package IS NOT NULL").groupBy("package").agg(F.any_value("ecosystem").alias("ecosystem"))
    whole = entries.agg(F.to_json(F.map_from_entries(F.array_append(F.collect_list(F.struct("package", F.struct("ecosystem").alias("v"))), F.struct(F.lit("_note").alias("package"), F.struct(F.lit("none").alias("ecosystem")).alias("v"))))).alias("value"))
    return readers.read_json_map(spark, _one_text(whole, _place(spark, "map")), "ecosystem string", "package")


@REGISTRY.add("json_lines_rows", f"WITH {INC} SELECT id, title, year, tags FROM inc WHERE id IS NOT NULL")
def json_lines_rows(spark, folder):
    """Records written as JSON lines and read back, nulls and empty arrays apart."""
    at = _place(spark, "lines")
    rows = incidents(spark, folder, "id", "title", "year", "tags").where("id IS NOT NULL")
    writers.write_json_lines(rows, at)
    return spark.read.schema(rows.schema).json(at)


@REGISTRY.add("csv_rows", rf"WITH {INC} SELECT id, nullif(trim(regexp_replace(affected, '[\r\n]+', ' / ', 'g')), '') AS affected, year::VARCHAR AS year, nullif(array_to_string(list_filter(tags, lambda x: x IS NOT NULL), '; '), '') AS tags FROM inc")
def csv_rows(spark, folder):
    """Records written as CSV for spreadsheets and read back."""
    at = _place(spark, "csv")
    writers.write_csv(incidents(spark, folder, "id", "affected", "year", "tags").withColumn("affected", F.regexp_replace("affected", r"[\r\n]+", " / ")), at)
    body = spark.read.schema("id string, affected string, year string, tags string").option("quote", '"').option("escape", '"').csv(f"{at}/body")
    return body.select("id", F.nullif(F.trim("affected"), F.lit("")).alias("affected"), "year", F.nullif(F.regexp_replace("tags", "\r$", ""), F.lit("")).alias("tags"))


@REGISTRY.add("rows_by_year", f"WITH {INC} SELECT year, count(*) AS n, min(id) AS first_id FROM inc WHERE year IS NOT NULL GROUP BY year")
def rows_by_year(spark, folder):
    """A dataset written in one folder per year and read back."""
    at = _place(spark, "years")
    writers.write_by(incidents(spark, folder, "id", "year").where("year IS NOT NULL"), at, "year")
    return spark.read.parquet(at).groupBy("year").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@REGISTRY.add("pipe_table_rows", "SELECT product, vendor FROM products WHERE product IS NOT NULL AND vendor IS NOT NULL")
def pipe_table_rows(spark, folder):
    """Markdown pipe tables, read row by row."""
    line = F.concat(F.lit("| "), F.col("product"), F.lit(" | "), F.col("vendor"), F.lit(" | [page](https://p.example/"), F.xxhash64("package").cast("string"), F.lit(") |"))
    text = table(spark, folder, "products").where("product IS NOT NULL AND vendor IS NOT NULL").select(line.alias("value"))
    at = _place(spark, "pipes")
    text.write.mode("overwrite").text(at)
    cells = readers.read_pipe_tables(spark, f"{at}/part-*", 3)
    return cells.select(F.get("cells", F.lit(0)).alias("product"), F.get("cells", F.lit(1)).alias("vendor"))


@REGISTRY.add("unlisted_files", "SELECT 'missing' AS finding, 1 AS n UNION ALL SELECT 'unlisted', 1")
def unlisted_files(spark, folder):
    """A written tree held against its checksums, from which one file was struck and to which one was added."""
    at = _place(spark, "tree")
    writers.write_json_lines(table(spark, folder, "nation").repartition(3, "n_nationkey"), at)
    found = writers.checksums(at, spark).where("file LIKE 'part-%'")
    listed = found.orderBy("file").offset(1).unionByName(spark.createDataFrame([("ghost.json", 1, "x")], "file string, bytes bigint, sha256 string"))
    return writers.verify_checksums(listed, found).groupBy("finding").agg(F.count("*").cast("int").alias("n"))
