"""Queries of graph exports, streams and joins of the star tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quernstone.functions import arrays
from quernstone.operators import graphs
from quernstone.plans.lineage import shared_folder
from quernstone.plans.queries_records import INC, incidents
from quernstone.plans.registry import Registry, table
from quernstone.streaming import stateful

REGISTRY = Registry()


@REGISTRY.add("graph_nodes", f"WITH {INC} SELECT kind, name FROM (SELECT DISTINCT 'vulnerability' AS kind, c AS name FROM (SELECT unnest(cve_ids) AS c FROM inc) WHERE c IS NOT NULL UNION ALL SELECT DISTINCT 'weakness', c FROM (SELECT unnest(cwe_ids) AS c FROM inc) WHERE c IS NOT NULL)")
def graph_nodes(spark, folder):
    """Distinct nodes of the exchange graph."""
    inc = incidents(spark, folder, "id", "cve_ids", "cwe_ids")
    cve, cwe = (inc.select(F.explode(c).alias("c")) for c in ("cve_ids", "cwe_ids"))
    return graphs.nodes(cve, "vulnerability", F.col("c")).unionByName(graphs.nodes(cwe, "weakness", F.col("c"))).select("kind", "name")


@REGISTRY.add("graph_edges", f"WITH {INC} SELECT 'exploits' AS relation, count(*) AS n FROM (SELECT DISTINCT id, c FROM (SELECT id, unnest(cve_ids) AS c FROM inc) WHERE c IS NOT NULL)")
def graph_edges(spark, folder):
    """How many distinct edges tie records to their identifiers."""
    pairs = incidents(spark, folder, "id", "cve_ids").select("id", F.explode("cve_ids").alias("c"))
    return graphs.edges(pairs, "exploits", ("incident", F.col("id")), ("vulnerability", F.col("c"))).groupBy("relation").agg(F.count("*").alias("n"))


@REGISTRY.add("name_based_ids", """WITH h AS (SELECT package, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(package)) AS d FROM products)
    SELECT package, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' || lower(format('{:02x}', ((('0x' || substr(d, 17, 2))::INT & 63) | 128))) || substr(d, 19, 2) || '-' || substr(d, 21, 12) AS uuid FROM h""")
def name_based_ids(spark, folder):
    """Version 5 UUIDs of products, computed without Python."""
    return table(spark, folder, "products").select("package", graphs.uuid5(F.col("package")).alias("uuid"))


@REGISTRY.add("feed_attributes", f"WITH {INC}, a AS (SELECT DISTINCT year, 'cve' AS kind, c AS value FROM (SELECT year, unnest(cve_ids) AS c FROM inc) WHERE c IS NOT NULL AND c <> '' UNION ALL SELECT DISTINCT year, 'url', u FROM (SELECT year, unnest(\"references\").url AS u FROM inc) WHERE u IS NOT NULL AND u <> '') SELECT coalesce(year::VARCHAR, '') AS year, kind, value, md5(value) AS value_md5 FROM a")
def feed_attributes(spark, folder):
    """Attributes of each year's feed event with their hashes."""
    return graphs.attributes(incidents(spark, folder, "id", "year", "cve_ids", "references"), "year", {"cve": F.col("cve_ids"), "url": F.col("references.url")}).withColumn("year", F.coalesce(F.col("year").cast("string"), F.lit("")))


_UUID5 = """substr({d}, 1, 8) || '-' || substr({d}, 9, 4) || '-5' || substr({d}, 14, 3) || '-' || lower(format('{{:02x}}', ((('0x' || substr({d}, 17, 2))::INT & 63) | 128))) || substr({d}, 19, 2) || '-' || substr({d}, 21, 12)"""


def _uuid5(name: str) -> str:
    return "(" + _UUID5.format(d=f"sha1(unhex('{graphs.NAMESPACE}') || encode({name}))") + ")"


def _instant(column: str, time: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({column}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN trim({column}) || '{time}' WHEN regexp_full_match(trim({column}), '[0-9]{{4}}-[0-9]{{2}}') THEN trim({column}) || '-01{time}' WHEN regexp_full_match(trim({column}), '[0-9]{{4}}') THEN trim({column}) || '-01-01{time}' END"


@REGISTRY.add(
    "stix_objects",
    f"""WITH {INC}, r AS (
        SELECT id, title, cve_ids, coalesce({_instant('added', 'T00:00:00.000Z')}, '1970-01-01T00:00:00.000Z') AS created, {_instant('coalesce(updated, added)', 'T00:00:00.003Z')} AS m FROM inc
    ), t AS (SELECT *, greatest(created, coalesce(m, created)) AS modified, 'x-incident--' || {_uuid5("'x-incident:' || id")} AS oid FROM r
    ), p AS (SELECT DISTINCT id, oid, created, modified, c FROM (SELECT *, unnest(cve_ids) AS c FROM t) WHERE c IS NOT NULL
    ), v AS (SELECT DISTINCT c, 'vulnerability--' || {_uuid5("'vulnerability:' || c")} AS vid FROM p)
    SELECT oid AS object_id, 'x-incident' AS type, created, modified, title AS name FROM t
    UNION ALL SELECT vid, 'vulnerability', '1970-01-01T00:00:00.000Z', '1970-01-01T00:00:00.003Z', c FROM v
    UNION ALL SELECT 'relationship--' || {_uuid5("'relationship:exploits|' || oid || '|' || vid")}, 'relationship', created, modified, 'exploits' FROM p JOIN v USING (c)""",
)
def stix_objects(spark, folder):
    """Every STIX object of the records, without its body."""
    inc = incidents(spark, folder, "id", "title", "added", "updated", "severity", "tags", "cve_ids", "references")
    return graphs.stix_objects(inc, 3).drop("body")


@REGISTRY.add("feed_events", f"WITH {INC}, a AS (SELECT DISTINCT year, 'cve' AS kind, c AS value FROM (SELECT year, unnest(cve_ids) AS c FROM inc) WHERE c IS NOT NULL AND c <> '' UNION ALL SELECT DISTINCT year, 'url', u FROM (SELECT year, unnest(\"references\").url AS u FROM inc) WHERE u IS NOT NULL AND u <> '') SELECT year, " + _uuid5("'event:' || coalesce(year::VARCHAR, '')") + " AS uuid, 'Incidents of ' || year AS info, count(*) AS attribute_count, md5(sum(('0x' || substr(md5(value), 1, 12))::HUGEINT)::VARCHAR) AS digest FROM a GROUP BY year")
def feed_events(spark, folder):
    """The headers of each year's feed event."""
    inc = incidents(spark, folder, "id", "year", "cve_ids", "references")
    return graphs.feed_events(graphs.attributes(inc, "year", {"cve": F.col("cve_ids"), "url": F.col("references.url")}), "year")


@REGISTRY.add("live_identifiers", f"WITH {INC}, p AS (SELECT DISTINCT id, status, unnest(cve_ids) AS c FROM inc), l AS (SELECT id, string_agg(c, ' ' ORDER BY c) AS live FROM p WHERE c IS NOT NULL AND c NOT IN (SELECT c FROM p WHERE status = 'retracted' AND c IS NOT NULL) GROUP BY id) SELECT inc.id, coalesce(live, '') AS live FROM inc LEFT JOIN l USING (id)")
def live_identifiers(spark, folder):
    """Identifiers of each record that no retracted record holds."""
    inc = incidents(spark, folder, "id", "cve_ids", "status")
    gone = inc.where("status = 'retracted'").select(F.explode("cve_ids").alias("c")).where("c IS NOT NULL").distinct()
    pairs = inc.select("id", F.explode(F.array_distinct(arrays.strings(F.col("cve_ids")))).alias("c")).join(gone, "c", "left_anti")
    kept = pairs.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list("c")), " ").alias("live"))
    return inc.select("id").join(kept, "id", "left").select("id", F.coalesce("live", F.lit("")).alias("live"))


def _stream(spark, folder, name):
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*").option("recursiveFileLookup", "true").parquet(folder) if not _is_folder(spark, f"{folder}/{name}.parquet") else spark.readStream.schema(schema).parquet(f"{folder}/{name}.parquet")


def _is_folder(spark, path):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def _drained(stream, mode):
    """All that a stream gives until its input is used up, kept in the shared folder; the last version for complete mode."""
    spark = stream.sparkSession
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex[:12]}"

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{at}/out" if mode == "complete" else f"{at}/out/batch={number}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out").select(*stream.columns)


@REGISTRY.add("stream_hourly_counts", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_hourly_counts(spark, folder):
    """Hourly counts by type, kept up by a stream."""
    counts = stateful.windowed_counts(_stream(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", None, "1 day", ["event_type"])
    return _drained(counts, "complete").select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n")


@REGISTRY.add("stream_source_health", """WITH e AS (SELECT user_id, ts, event_type FROM events), s AS (SELECT user_id, max(ts) AS last FROM e WHERE event_type = 'view' GROUP BY user_id),
    f AS (SELECT e.user_id, count(*) FILTER (event_type = 'error' AND (last IS NULL OR ts > last)) AS failures FROM e LEFT JOIN s USING (user_id) GROUP BY e.user_id)
    SELECT user_id, failures, CASE WHEN failures >= 3 THEN 'stale' WHEN failures > 0 THEN 'degraded' ELSE 'ok' END AS status FROM f""")
def stream_source_health(spark, folder):
    """Each source's status after its runs, kept up by a stateful stream."""
    events = _stream(spark, folder, "events")
    kind = F.when(F.col("event_type") == "error", "failure").when(F.col("event_type") == "view", "success").otherwise("skipped")
    return _drained(stateful.health_stream(events.select("user_id", "ts", kind.alias("outcome")), "user_id", "outcome", "ts"), "update")


@REGISTRY.add("stream_changes", r"""WITH r AS (SELECT id, received_at::VARCHAR AS day, md5(concat_ws(chr(31), coalesce(status, chr(1)), coalesce(severity, chr(1)))) AS content, received_at FROM incident_snapshots),
    l AS (SELECT *, lag(content) OVER w AS before, row_number() OVER w AS n, first_value(day) OVER w AS added FROM r WINDOW w AS (PARTITION BY id ORDER BY received_at, content))
    SELECT id, added, day AS updated, CASE WHEN n = 1 THEN 'added' ELSE 'changed' END AS change FROM l WHERE n = 1 OR content <> before""")
def stream_changes(spark, folder):
    """New and changed records as deliveries come in."""
    rows = _stream(spark, folder, "incident_snapshots")
    return _drained(stateful.detect_changes(rows, "id", ["status", "severity"], "received_at"), "append")


@REGISTRY.add("revenue_by_nation", "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_shipdate >= '1995-01-01' GROUP BY n_name")
def revenue_by_nation(spark, folder):
    """A star join with its aggregation; the fixed dimensions are small enough to broadcast."""
    line = table(spark, folder, "lineitem").where("l_shipdate >= '1995-01-01'").select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(38,10)").alias("amount"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    per = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum("amount").alias("amount"), F.count("*").alias("n"))
    return per.join(F.broadcast(table(spark, folder, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", F.round("amount", 2).cast("double").alias("revenue"), "n")


@REGISTRY.add("pricing_summary", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order FROM lineitem WHERE l_shipdate <= '1998-09-02' GROUP BY ALL")
def pricing_summary(spark, folder):
    """Scan, filter and wide aggregation."""
    rows = table(spark, folder, "lineitem").where("l_shipdate <= '1998-09-02'")
    exact = lambda c: F.sum(c.cast("decimal(30,8)")).cast("double")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(exact(F.col("l_quantity")), 2).alias("sum_qty"), F.round(exact(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("count_order"))
