"""Records as a graph for exchange formats: distinct nodes, edges, and name-based ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Namespace of name-based ids, as 32 hex digits; a parameter of every function here.
NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = NAMESPACE) -> Column:
    """The name-based UUID (version 5) of a name, computed in the JVM."""
    digest = F.substring(F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8"))), 1, 32)
    variant = F.lower(F.hex((F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(0x3F)).bitwiseOR(0x80)))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 19, 2)), F.substring(digest, 21, 12))


def nodes(df: DataFrame, kind: str, name: Column, namespace: str = NAMESPACE) -> DataFrame:
    """(node_id, kind, name): one node for each distinct non-null name."""
    named = df.select(name.alias("name")).where("name IS NOT NULL").distinct()
    return named.select(F.concat(F.lit(f"{kind}--"), uuid5(F.concat(F.lit(f"{kind}:"), F.col("name")), namespace)).alias("node_id"), F.lit(kind).alias("kind"), "name")


def edges(df: DataFrame, relation: str, source: tuple[str, Column], target: tuple[str, Column], namespace: str = NAMESPACE) -> DataFrame:
    """(edge_id, relation, source_id, target_id) between the nodes of two names, each pair once."""
    ids = [F.concat(F.lit(f"{k}--"), uuid5(F.concat(F.lit(f"{k}:"), n), namespace)) for k, n in (source, target)]
    both = df.select(source[1].alias("s"), target[1].alias("t"), ids[0].alias("source_id"), ids[1].alias("target_id")).where("s IS NOT NULL AND t IS NOT NULL").select("source_id", "target_id").distinct()
    name = F.concat_ws("|", F.lit(relation), "source_id", "target_id")
    return both.select(F.concat(F.lit("relationship--"), uuid5(name, namespace)).alias("edge_id"), F.lit(relation).alias("relation"), "source_id", "target_id")


def attributes(df: DataFrame, group: str, parts: dict[str, Column]) -> DataFrame:
    """(group, kind, value, value_md5): the distinct values of each kind within a group, one row each.

    Parts are arrays or single values.  A consumer that wants one object per group aggregates at its own risk.
    """
    each = None
    for kind, column in parts.items():
        one = df.select(F.col(group), F.lit(kind).alias("kind"), column.alias("value"))
        if one.schema["value"].dataType.typeName() == "array":
            one = one.select(group, "kind", F.explode("value").alias("value"))
        each = one if each is None else each.unionByName(one)
    return each.where("value IS NOT NULL AND value <> ''").distinct().withColumn("value_md5", F.md5("value"))


#: Fields of every exchange object.
SPECIFICATION = "2.1"


def stix_objects(records: DataFrame, version: int, namespace: str = NAMESPACE) -> DataFrame:
    """(object_id, type, created, modified, name, body): STIX objects of records, one row each; ``body`` is its JSON.

    ``records`` has id, title, added, updated, severity, tags, cve_ids and references (url), one row per id.
    Each record is an x-incident, each different CVE a vulnerability, each record's use of one a relationship.
    Relationships carry their record's instants; a vulnerability's are fixed, as it stands for no record.
    ``version`` is that of the exporter (see ``adapters.stamped``).
    """
    from quernstone.sources.adapters import stamped

    key = lambda kind, name: F.concat(F.lit(f"{kind}--"), uuid5(F.concat(F.lit(f"{kind}:"), name), namespace))
    created, modified = stamped(F.col("added"), F.coalesce("updated", "added"), version)
    rows = records.where("id IS NOT NULL").select("*", created.alias("created"), modified.alias("modified"))
    common = lambda kind: [F.lit(kind).alias("type"), F.lit(SPECIFICATION).alias("spec_version"), F.col("object_id").alias("id"), "created", "modified"]
    links = F.transform(F.filter(F.coalesce("references.url", F.array().cast("array<string>")), lambda u: F.length(F.trim(u)) > 0), lambda u: F.struct(F.lit("reference").alias("source_name"), u.alias("url")))
    incidents = rows.withColumn("object_id", key("x-incident", F.col("id"))).withColumn("links", links)
    body = F.to_json(F.struct(*common("x-incident"), F.col("title").alias("name"), F.col("id").alias("x_record_id"), F.col("severity").alias("x_severity"), F.col("tags").alias("labels"), F.when(F.size("links") > 0, F.col("links")).alias("external_references")))
    out = incidents.select("object_id", F.lit("x-incident").alias("type"), "created", "modified", F.col("title").alias("name"), body.alias("body"))
    pairs = rows.select("id", "created", "modified", F.explode(F.array_distinct(F.array_compact("cve_ids"))).alias("cve"))
    since = F.lit("1970-01-01T00:00:00.000Z").alias("created"), F.lit(f"1970-01-01T00:00:00.{version:03}Z").alias("modified")
    flaws = pairs.select("cve").distinct().select(key("vulnerability", F.col("cve")).alias("object_id"), *since, "cve")
    body = F.to_json(F.struct(*common("vulnerability"), F.col("cve").alias("name"), F.array(F.struct(F.lit("cve").alias("source_name"), F.col("cve").alias("external_id"))).alias("external_references")))
    out = out.unionByName(flaws.select("object_id", F.lit("vulnerability").alias("type"), "created", "modified", F.col("cve").alias("name"), body.alias("body")))
    ends = pairs.select(key("x-incident", F.col("id")).alias("source_ref"), key("vulnerability", F.col("cve")).alias("target_ref"), "created", "modified")
    ties = ends.withColumn("object_id", key("relationship", F.concat_ws("|", F.lit("exploits"), "source_ref", "target_ref")))
    body = F.to_json(F.struct(*common("relationship"), F.lit("exploits").alias("relationship_type"), "source_ref", "target_ref"))
    return out.unionByName(ties.select("object_id", F.lit("relationship").alias("type"), "created", "modified", F.lit("exploits").alias("name"), body.alias("body")))


def feed_events(attributes_of: DataFrame, group: str, namespace: str = NAMESPACE) -> DataFrame:
    """(group, uuid, info, attribute_count, digest): the header of each group's feed event.

    ``attributes_of`` comes from ``attributes``; the digest is free of order, so that it changes with the
    event's content only.  The attributes stay rows beside it: a year's may be more than one task can hold.
    """
    part = F.conv(F.substring("value_md5", 1, 12), 16, 10).cast("decimal(20,0)")
    sums = attributes_of.groupBy(group).agg(F.count("*").alias("attribute_count"), F.sum(part).alias("s"))
    name = F.coalesce(F.col(group).cast("string"), F.lit(""))
    return sums.select(group, uuid5(F.concat(F.lit("event:"), name), namespace).alias("uuid"), F.concat(F.lit("Incidents of "), F.nullif(name, F.lit(""))).alias("info"), "attribute_count", F.md5(F.col("s").cast("string")).alias("digest"))
