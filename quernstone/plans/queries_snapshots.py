from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.operators.snapshots import day, snapshot_changes
from quernstone.plans.registry import Registry, table

REGISTRY = Registry()

_SQL = r"""
    WITH rows AS (
        SELECT snapshot_on, upper(trim(id)) AS id, nullif(lower(trim(status)), '') AS status,
               coalesce(nullif(regexp_replace(regexp_extract(trim(updated), '^[0-9]{4}[-/.]?[0-9]{2}[-/.]?[0-9]{2}'), '[-/.]', '', 'g'), ''), lower(trim(updated))) AS updated,
               received_at
        FROM incident_snapshots WHERE snapshot_on IS NOT NULL AND id IS NOT NULL
    ), latest AS (
        SELECT * FROM rows
        QUALIFY row_number() OVER (PARTITION BY snapshot_on, id ORDER BY received_at DESC NULLS LAST, status DESC NULLS LAST, updated DESC NULLS LAST) = 1
    ), days AS (
        SELECT snapshot_on, lag(snapshot_on) OVER (ORDER BY snapshot_on) AS earlier FROM (SELECT DISTINCT snapshot_on FROM latest)
    ), now AS (
        SELECT l.*, d.earlier FROM latest l JOIN days d USING (snapshot_on) WHERE earlier IS NOT NULL
    ), past AS (
        SELECT d.snapshot_on AS next_on, l.* FROM latest l JOIN days d ON l.snapshot_on = d.earlier
    ), changes AS (
        SELECT coalesce(n.snapshot_on, p.next_on) AS snapshot_on, coalesce(n.id, p.id) AS id,
               CASE WHEN p.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed'
                    WHEN n.status IS DISTINCT FROM p.status OR n.updated IS DISTINCT FROM p.updated THEN 'changed' END AS change_kind
        FROM now n FULL JOIN past p ON n.snapshot_on = p.next_on AND n.id = p.id
    )
"""


def _changes(spark, folder):
    return snapshot_changes(
        table(spark, folder, "incident_snapshots"),
        "snapshot_on",
        F.upper(F.trim("id")),
        {"status": F.expr("nullif(lower(trim(status)), '')"), "updated": day("updated")},
        "received_at",
    )


@REGISTRY.add("p5_found", _SQL + "SELECT snapshot_on, id, change_kind FROM changes WHERE change_kind IS NOT NULL")
def p5_found(spark, folder):
    """Records added, removed or changed from each snapshot to the next."""
    return _changes(spark, folder).select("snapshot_on", F.col("key").alias("id"), "change_kind")


@REGISTRY.add("p5_counts", _SQL + "SELECT snapshot_on, change_kind, count(*) AS n FROM changes WHERE change_kind IS NOT NULL GROUP BY ALL")
def p5_counts(spark, folder):
    """How many records each snapshot added, removed and changed."""
    return _changes(spark, folder).groupBy("snapshot_on", "change_kind").agg(F.count("*").alias("n"))
