"""Feed records as rows of one shape, from the tables that the readers and the shredder give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.dates import padded

# Keys of scores in order of preference, names that stand for none, hosts of code, form of CWE ids.
SCORES = ["cvssV3_1", "cvssV3_0", "cvssV4_0"]
NO_NAMES = ["n/a", "unspecified"]
REPOSITORY = r"^https?://github\.com/([^/\s]+)/([^/\s#?]+)"
CWE = "^CWE-[0-9]{1,4}$"


def _leaf(name: str) -> Column:
    return F.col("attributes")[name]


def _in_order(values: Column, where: Column, *order: str) -> Column:
    """The values of a record's elements that fulfil a condition, in order; nulls are left out."""
    held = F.collect_list(F.when(where & values.isNotNull(), F.struct(*order, values.alias("v"))))
    return F.transform(F.array_sort(held), lambda x: x["v"])


def _first_each(values: Column, key) -> Column:
    """The values without those whose key came before, and without blank ones."""
    kept = F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v != "")
    keys = F.transform(kept, key)
    return F.filter(kept, lambda v, i: F.array_position(keys, F.get(keys, i)) == i + 1)


def cve_rows(elements: DataFrame) -> DataFrame:
    """One row per record of shredded CVE records (see ``nested_records.shred_records``).

    (record_id, record_pos, cve_id, state, published, title, description, score, vector, severity, cwes, affected,
    products, references).  The description is the first English one of the record's own container, or its
    first; the score the first that has a number, in the order of containers, metrics and SCORES; affected the
    first four different vendor/product names; products all names by which a product is known, each once
    whatever its case; references the different URLs in order.
    """
    kind, own = F.col("kind"), F.col("container") == "cna"
    text = _leaf("value")
    english = F.coalesce(F.lower(_leaf("lang")).startswith("en"), F.lit(False))
    at = F.struct((~own).cast("int"), "container_pos", "item_pos", "sub_pos")
    scores = F.array_compact(F.array(*(F.when(_leaf(f"{k}.baseScore").try_cast("double").isNotNull(), F.struct(F.lit(i).alias("rank"), _leaf(f"{k}.baseScore").try_cast("double").alias("score"), _leaf(f"{k}.vectorString").alias("vector"), F.initcap(_leaf(f"{k}.baseSeverity")).alias("severity"))) for i, k in enumerate(SCORES))))
    score = F.when(kind == "metric", F.get(scores, F.lit(0)))
    vendor, product = F.trim(F.coalesce(_leaf("vendor"), F.lit(""))), F.trim(F.coalesce(_leaf("product"), _leaf("packageName"), F.lit("")))
    named = ~F.lower(vendor).isin("", *NO_NAMES) & (F.lower(vendor) != F.lower(product))
    label = F.when(~F.lower(product).isin("", *NO_NAMES), F.when(named, F.concat(vendor, F.lit("/"), product)).otherwise(product))
    cpes = F.coalesce(F.from_json(_leaf("cpes"), "array<string>"), F.array().cast("array<string>"))
    of_cpes = F.flatten(F.transform(F.filter(F.transform(cpes, lambda c: F.split(c, ":")), lambda b: F.size(b) > 4), lambda b: F.slice(b, 4, 2)))
    names = F.array_compact(F.concat(F.array(_leaf("vendor"), _leaf("product"), _leaf("packageName"), _leaf("repo"), F.nullif(F.regexp_replace(_leaf("collectionURL"), "^https?://[^/]+/", ""), F.lit(""))), of_cpes))
    repository = F.concat_ws("/", *(F.nullif(F.regexp_extract(_leaf("url"), REPOSITORY, i), F.lit("")) for i in (1, 2)))
    slug = F.when((kind == "reference") & own & _leaf("url").rlike(REPOSITORY), F.array(repository))
    every = F.when(kind == "affected", names).otherwise(slug)
    rank = F.when(kind == "reference", 1).otherwise(0)
    rows = elements.withColumn("_at", at).withColumn("_names", every).withColumn("_rank", rank)
    out = rows.groupBy("record_id", "record_pos").agg(
        F.max("cve_id").alias("cve_id"),
        F.max(F.when(kind == "record", _leaf("cveMetadata.state"))).alias("state"),
        F.max(F.when(kind == "record", _leaf("cveMetadata.datePublished"))).alias("published"),
        F.max(F.when((kind == "title") & own, F.trim(_leaf("title")))).alias("title"),
        F.min_by(text, F.when((kind == "description") & own & (F.trim(text) != ""), F.struct((~english).cast("int"), "_at"))).alias("description"),
        F.min_by(score, F.when(score.isNotNull(), F.col("_at"))).alias("_score"),
        F.array_sort(F.collect_set(F.when((kind == "problem") & own & _leaf("cweId").rlike(CWE), _leaf("cweId")))).alias("cwes"),
        _in_order(label, (kind == "affected") & own, "_at").alias("_labels"),
        _in_order(F.col("_names"), F.col("_names").isNotNull(), "_rank", "_at").alias("_products"),
        _in_order(_leaf("url"), (kind == "reference") & own, "_at").alias("_urls"),
    )
    return out.select(
        "record_id", "record_pos", "cve_id", "state", "published", "title", "description", "_score.score", "_score.vector", "_score.severity", "cwes",
        F.array_join(F.slice(F.array_distinct("_labels"), 1, 4), ", ").alias("affected"),
        _first_each(F.flatten("_products"), lambda v: F.lower(v)).alias("products"),
        F.array_distinct(F.filter("_urls", lambda u: F.trim(u) != "")).alias("references"),
    )


def osv_rows(records: DataFrame) -> DataFrame:
    """One row per OSV record (id, aliases, summary, details, published, modified, references, affected).

    (source_id, title, description, cve_ids, published, package, references): the title is the summary or
    the details' first line; CVE ids come from id and aliases, each once; ``package`` is ecosystem/name of
    the first affected package.  Records without an id give no rows; absent fields are null.
    """
    names = F.filter(F.concat(F.array("id"), F.coalesce("aliases", F.array().cast("array<string>"))), lambda a: a.isNotNull())
    first = F.get(F.col("affected.package"), F.lit(0))
    return records.where("id IS NOT NULL").select(
        F.col("id").alias("source_id"),
        F.coalesce(F.nullif(F.trim("summary"), F.lit("")), F.trim(F.substring_index("details", "\n", 1))).alias("title"),
        F.coalesce(F.nullif(F.trim("details"), F.lit("")), F.trim("summary")).alias("description"),
        F.array_distinct(F.filter(F.transform(names, lambda a: F.upper(F.trim(a))), lambda a: a.rlike("^CVE-[0-9]{4}-[0-9]{4,9}$"))).alias("cve_ids"),
        F.substring(F.coalesce("published", "modified"), 1, 10).alias("published"),
        F.when(first["name"].isNotNull(), F.concat_ws("/", F.lower(first["ecosystem"]), first["name"])).alias("package"),
        F.array_distinct(F.filter(F.col("references.url"), lambda u: u.startswith("http"))).alias("references"),
    )


def avid_rows(records: DataFrame, most_references: int = 6) -> DataFrame:
    """One row per AVID record (metadata, affects, problemtype, references, description, impact, dates).

    (source_id, title, description, cve_ids, published, vendors, products, references): CVE ids stand anywhere in
    title, description or references; at most ``most_references`` references are kept, as the feed's readers do.
    """
    title, text = F.col("problemtype.description.value"), F.col("description.value")
    empty = F.array().cast("array<string>")
    listed = lambda c: F.coalesce(F.col(c), empty)
    everywhere = F.concat_ws(" ", title, text, F.array_join(listed("references.url"), " "), F.array_join(listed("references.label"), " "))
    return records.select(
        F.coalesce("metadata.vuln_id", "metadata.report_id").alias("source_id"),
        F.trim(title).alias("title"),
        F.trim(F.coalesce(text, title)).alias("description"),
        F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(F.upper(everywhere), F.lit("CVE-[0-9]{4}-[0-9]{4,9}"), F.lit(0)), lambda c: c))).alias("cve_ids"),
        F.substring(F.coalesce("published_date", "reported_date"), 1, 10).alias("published"),
        F.array_distinct(F.concat(listed("affects.developer"), listed("affects.deployer"))).alias("vendors"),
        F.array_distinct(listed("affects.artifacts.name")).alias("products"),
        F.slice(F.array_distinct(F.filter(listed("references.url"), lambda u: u.startswith("http"))), 1, most_references).alias("references"),
    ).where("source_id IS NOT NULL")


def incident_csv_rows(rows: DataFrame) -> DataFrame:
    """Rows of the incident database's CSV (incident_id, date, title, description, deployers, developers, harmed, reports).

    (source_id, title, description, date, year, parties, reports): JSON-list cells become arrays, slugs in them
    become names in title case; ``parties`` are deployers and developers, each once in order.
    """
    cells = lambda c: F.transform(F.coalesce(F.from_json(F.col(c), "array<string>"), F.array().cast("array<string>")), lambda s: F.initcap(F.regexp_replace(F.trim(s), "[-_]+", " ")))
    return rows.where(F.trim("incident_id") != "").select(
        F.concat(F.lit("AIID-"), F.trim("incident_id")).alias("source_id"),
        F.trim("title").alias("title"),
        F.trim("description").alias("description"),
        "date",
        F.substring("date", 1, 4).try_cast("int").alias("year"),
        F.filter(F.array_distinct(F.concat(cells("deployers"), cells("developers"))), lambda p: p != "").alias("parties"),
        F.size(F.coalesce(F.from_json("reports", "array<int>"), F.array().cast("array<int>"))).alias("reports"),
    )


def paper_rows(records: DataFrame) -> DataFrame:
    """Rows of harvested papers (header, metadata.arXiv); deleted headers come with ``deleted`` and no title.

    (source_id, deleted, title, description, created, authors, categories): blanks in title and abstract are
    collapsed, authors are "forenames keyname" in order.
    """
    paper = "metadata.arXiv"
    one_line = lambda c: F.trim(F.regexp_replace(F.col(c), r"\s+", " "))
    return records.select(
        F.regexp_replace("header.identifier", "^oai:arXiv.org:", "arXiv:").alias("source_id"),
        F.coalesce(F.col("header._status") == "deleted", F.lit(False)).alias("deleted"),
        one_line(f"{paper}.title").alias("title"),
        one_line(f"{paper}.abstract").alias("description"),
        F.col(f"{paper}.created").cast("string").alias("created"),
        F.transform(F.col(f"{paper}.authors.author"), lambda a: F.trim(F.concat_ws(" ", a["forenames"], a["keyname"]))).alias("authors"),
        F.filter(F.split(F.coalesce(F.col(f"{paper}.categories"), F.lit("")), r"\s+"), lambda c: c != "").alias("categories"),
    )


def stamped(added: Column, updated: Column, version: int) -> tuple[Column, Column]:
    """Created and modified instants of an exchange object from rough days; never modified before created.

    The milliseconds of ``modified`` carry the exporter's version, so a new form of an object is a new one.
    """
    created = F.coalesce(padded(added), F.lit("1970-01-01T00:00:00.000Z"))
    modified = F.coalesce(padded(updated, f"T00:00:00.{version:03}Z"), created)
    return created, F.greatest(created, modified)
