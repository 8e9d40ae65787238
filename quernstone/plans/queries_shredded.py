from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.operators.nested_records import KINDS, element_table, shred_records, unreadable_records
from quernstone.plans.registry import Registry, table
from quernstone.sources import adapters

REGISTRY = Registry()

_SQL = r"""
    WITH once AS (
        SELECT record_id, TRY_CAST(ltrim(trim(payload), chr(65279)) AS JSON) AS j FROM cve_records
    ), plain AS (
        SELECT record_id, CASE WHEN json_type(j) = 'VARCHAR' THEN TRY_CAST(ltrim(j ->> '$', chr(65279)) AS JSON) ELSE j END AS j FROM once
    ), single AS (
        SELECT record_id, 0 AS record_pos, j FROM plain WHERE json_type(j) <> 'ARRAY'
        UNION ALL SELECT record_id, p - 1, j -> (p - 1) FROM (SELECT record_id, j, unnest(range(1, 1 + json_array_length(j)::BIGINT)) AS p FROM plain WHERE json_type(j) = 'ARRAY')
    ), bare AS (
        SELECT record_id, record_pos, CASE WHEN json_type(j) <> 'OBJECT' THEN NULL WHEN json_exists(j, '$.containers') THEN j ELSE coalesce(j -> 'data', j -> 'record') END AS j FROM single
    ), boxes AS (
        SELECT record_id, record_pos, 'cna' AS container, 0 AS container_pos, j -> 'containers' -> 'cna' AS c FROM bare
        UNION ALL SELECT record_id, record_pos, 'adp', 0, j -> 'containers' -> 'adp' FROM bare WHERE json_type(j -> 'containers' -> 'adp') = 'OBJECT'
        UNION ALL SELECT record_id, record_pos, 'adp', p - 1, a -> (p - 1) FROM (
            SELECT record_id, record_pos, a, unnest(range(1, 1 + json_array_length(a)::BIGINT)) AS p FROM (
                SELECT record_id, record_pos, j -> 'containers' -> 'adp' AS a FROM bare WHERE json_type(j -> 'containers' -> 'adp') = 'ARRAY'))
    ), kinds AS (SELECT * FROM (VALUES ('description', 'descriptions'), ('affected', 'affected'), ('reference', 'references'), ('metric', 'metrics'), ('types', 'problemTypes')) v(kind, name)
    ), lists AS (
        SELECT record_id, record_pos, container, container_pos, kind, json_extract(c, name) AS a FROM boxes CROSS JOIN kinds WHERE json_type(c) = 'OBJECT'
    ), items AS (
        SELECT record_id, record_pos, container, container_pos, kind, p - 1 AS item_pos, a -> (p - 1) AS e FROM (
            SELECT *, unnest(range(1, 1 + json_array_length(a)::BIGINT)) AS p FROM lists WHERE json_type(a) = 'ARRAY')
    ), subs AS (
        SELECT record_id, record_pos, container, container_pos, kind, item_pos, p - 1 AS sub_pos, a -> (p - 1) AS e FROM (
            SELECT *, unnest(range(1, 1 + json_array_length(a)::BIGINT)) AS p FROM (
                SELECT record_id, record_pos, container, container_pos, 'version' AS kind, item_pos, e -> 'versions' AS a FROM items WHERE kind = 'affected'
                UNION ALL SELECT record_id, record_pos, container, container_pos, 'problem', item_pos, e -> 'descriptions' FROM items WHERE kind = 'types')
            WHERE json_type(a) = 'ARRAY')
    ), found AS (
        SELECT record_id, record_pos, container, container_pos, kind, item_pos, -1 AS sub_pos FROM items WHERE kind <> 'types' AND json_type(e) <> 'NULL'
        UNION ALL SELECT record_id, record_pos, container, container_pos, kind, item_pos, sub_pos FROM subs WHERE json_type(e) <> 'NULL'
        UNION ALL SELECT record_id, record_pos, container, container_pos, 'title', -1, -1 FROM boxes WHERE json_type(c -> 'title') = 'VARCHAR' AND trim(c ->> 'title') <> ''
    )
"""


@REGISTRY.add("p6_found", _SQL + "SELECT record_id, container, container_pos::INT AS container_pos, kind, item_pos::INT AS item_pos, sub_pos::INT AS sub_pos FROM found")
def p6_found(spark, folder):
    """Every element of every readable payload, by its place."""
    return shred_records(table(spark, folder, "cve_records")).where(F.col("kind").isin(KINDS)).drop("record_pos", "cve_id", "attributes")


@REGISTRY.add(
    "p6_versions",
    _SQL
    + """SELECT s.record_id, s.record_pos::INT AS record_pos, j -> 'cveMetadata' ->> 'cveId' AS cve_id, container, container_pos::INT AS container_pos, item_pos::INT AS item_pos, sub_pos::INT AS sub_pos,
        e ->> 'version' AS version, e ->> 'status' AS status, e ->> 'lessThan' AS "lessThan", e ->> 'lessThanOrEqual' AS "lessThanOrEqual", e ->> 'versionType' AS "versionType"
    FROM subs s JOIN bare USING (record_id, record_pos) WHERE kind = 'version' AND json_type(e) <> 'NULL'""",
)
def p6_versions(spark, folder):
    """The flat table of affected versions, each with record, container and parent element."""
    return element_table(shred_records(table(spark, folder, "cve_records")), "version")


@REGISTRY.add(
    "p6_metrics",
    _SQL
    + """SELECT i.record_id, i.record_pos::INT AS record_pos, j -> 'cveMetadata' ->> 'cveId' AS cve_id, container, container_pos::INT AS container_pos, item_pos::INT AS item_pos, -1 AS sub_pos,
        e -> 'cvssV3_1' ->> 'baseSeverity' AS "cvssV3_1_baseSeverity", e -> 'other' -> 'content' ->> 'id' AS other_content_id
    FROM items i JOIN bare USING (record_id, record_pos) WHERE kind = 'metric' AND json_type(e) <> 'NULL'""",
)
def p6_metrics(spark, folder):
    """The flat table of metrics with leaves that lie deeper in them."""
    return element_table(shred_records(table(spark, folder, "cve_records")), "metric", ["cvssV3_1.baseSeverity", "other.content.id"])


@REGISTRY.add(
    "p6_records",
    _SQL
    + """SELECT record_id, record_pos::INT AS record_pos, j -> 'cveMetadata' ->> 'cveId' AS cve_id, 'record' AS container, 0 AS container_pos, -1 AS item_pos, -1 AS sub_pos,
        j -> 'cveMetadata' ->> 'state' AS "cveMetadata_state", j -> 'cveMetadata' ->> 'datePublished' AS "cveMetadata_datePublished", j ->> 'dataVersion' AS "dataVersion"
    FROM bare WHERE j IS NOT NULL AND (json_exists(j, '$.containers') OR json_exists(j, '$.cveMetadata'))""",
)
def p6_records(spark, folder):
    """The root table: one row per record with its own fields."""
    return element_table(shred_records(table(spark, folder, "cve_records")), "record", ["cveMetadata.state", "cveMetadata.datePublished", "dataVersion"])


@REGISTRY.add(
    "p6_unreadable",
    r"""SELECT record_id, CASE WHEN payload IS NULL THEN 'null' WHEN ltrim(trim(payload), chr(65279)) = '' THEN 'blank'
        WHEN TRY_CAST(ltrim(trim(payload), chr(65279)) AS JSON) IS NULL THEN 'no JSON' ELSE 'no record' END AS reason
    FROM cve_records WHERE payload IS NULL OR NOT coalesce(contains(TRY_CAST(ltrim(trim(payload), chr(65279)) AS JSON)::VARCHAR, 'containers'), false)""",
)
def p6_unreadable(spark, folder):
    """Payloads without a record, with the reason."""
    return unreadable_records(table(spark, folder, "cve_records"))


@REGISTRY.add(
    "feed_cve_rows",
    _SQL
    + r""", own AS (SELECT * FROM items WHERE container = 'cna' AND json_type(e) = 'OBJECT'
    ), d AS (
        SELECT record_id, record_pos, arg_min(e ->> 'value', CASE WHEN lower(e ->> 'lang') LIKE 'en%' THEN 0 ELSE 1000000 END + item_pos) AS description FROM own WHERE kind = 'description' AND trim(e ->> 'value') <> '' GROUP BY ALL
    ), m AS (
        SELECT i.record_id, i.record_pos, k, (i.container = 'adp')::INT * 1000000000 + container_pos * 10000000 + item_pos * 10 + k AS rank, TRY_CAST(json_extract_string(e, '$.' || ['cvssV3_1', 'cvssV3_0', 'cvssV4_0'][k] || '.baseScore') AS DOUBLE) AS score, json_extract_string(e, '$.' || ['cvssV3_1', 'cvssV3_0', 'cvssV4_0'][k] || '.baseSeverity') AS severity
        FROM items i CROSS JOIN (SELECT unnest([1, 2, 3]) AS k) WHERE kind = 'metric' AND json_type(e) = 'OBJECT'
    ), s AS (SELECT record_id, record_pos, arg_min(struct_pack(score := score, severity := severity), rank) AS v FROM m WHERE score IS NOT NULL GROUP BY ALL
    ), c AS (SELECT record_id, record_pos, string_agg(DISTINCT e ->> 'cweId', ' ' ORDER BY e ->> 'cweId') AS cwes FROM subs WHERE kind = 'problem' AND container = 'cna' AND regexp_full_match(e ->> 'cweId', 'CWE-[0-9]{1,4}') GROUP BY ALL
    ), a AS (
        SELECT record_id, record_pos, item_pos, trim(coalesce(e ->> 'vendor', '')) AS v, trim(coalesce(e ->> 'product', e ->> 'packageName', '')) AS p FROM own WHERE kind = 'affected'
    ), l AS (
        SELECT record_id, record_pos, min(item_pos) AS rank, CASE WHEN lower(v) NOT IN ('', 'n/a', 'unspecified') AND lower(v) <> lower(p) THEN v || '/' || p ELSE p END AS label FROM a WHERE lower(p) NOT IN ('', 'n/a', 'unspecified') GROUP BY ALL
    ), f AS (SELECT record_id, record_pos, array_to_string(list(label ORDER BY rank)[:4], ', ') AS affected FROM l GROUP BY ALL
    ), u AS (SELECT record_id, record_pos, count(DISTINCT e ->> 'url') AS links FROM own WHERE kind = 'reference' AND trim(e ->> 'url') <> '' GROUP BY ALL
    )
    SELECT b.record_id, b.record_pos::INT AS record_pos, j -> 'cveMetadata' ->> 'cveId' AS cve_id, j -> 'cveMetadata' ->> 'state' AS state, CASE WHEN json_type(j -> 'containers' -> 'cna' -> 'title') = 'VARCHAR' THEN nullif(trim(j -> 'containers' -> 'cna' ->> 'title'), '') END AS title,
        description, s.v.score AS score, upper(left(s.v.severity, 1)) || lower(substr(s.v.severity, 2)) AS severity, coalesce(cwes, '') AS cwes, coalesce(affected, '') AS affected, coalesce(links, 0)::INT AS links
    FROM bare b LEFT JOIN d USING (record_id, record_pos) LEFT JOIN s USING (record_id, record_pos) LEFT JOIN c USING (record_id, record_pos) LEFT JOIN f USING (record_id, record_pos) LEFT JOIN u USING (record_id, record_pos)
    WHERE j IS NOT NULL AND (json_exists(j, '$.containers') OR json_exists(j, '$.cveMetadata'))""",
)
def feed_cve_rows(spark, folder):
    """Rows of one shape from CVE records: text, score, weaknesses, affected products, links."""
    rows = adapters.cve_rows(shred_records(table(spark, folder, "cve_records")))
    return rows.select("record_id", "record_pos", "cve_id", "state", "title", "description", "score", "severity", F.array_join("cwes", " ").alias("cwes"), "affected", F.size("references").alias("links"))
