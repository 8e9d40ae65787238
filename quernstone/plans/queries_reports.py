"""Queries of aggregates, estimates, samples, joins, diffs, checks, redirects and identity."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import arrays
from quernstone.functions.identifiers import cve_ids
from quernstone.operators import aggregates, diffs, enrich, estimates, health, identity, quality, redirects, sampling
from quernstone.operators.latest import first_by, retained, upsert
from quernstone.operators.search import SEVERITIES
from quernstone.functions.text import one_of, title_key
from quernstone.plans.queries_records import _SEV, _STANDS, INC, incidents
from quernstone.plans.registry import Registry, table

REGISTRY = Registry()


@REGISTRY.add("element_counts", f"WITH {INC} SELECT tag, count(*) AS n FROM (SELECT DISTINCT id, unnest(tags) AS tag FROM inc) WHERE tag IS NOT NULL GROUP BY tag")
def element_counts(spark, folder):
    """In how many records each tag stands."""
    return aggregates.element_counts(incidents(spark, folder, "id", "tags"), "tags", "tag")


_ASKED = ["agentic", "chatbot", "rce", "quantum", "sector-health"]


@REGISTRY.add("zero_filled_counts", f"WITH {INC} SELECT v.tag, count(t.id) AS n FROM (VALUES ('agentic'), ('chatbot'), ('rce'), ('quantum'), ('sector-health')) v(tag) LEFT JOIN (SELECT DISTINCT id, unnest(tags) AS tag FROM inc) t ON t.tag = v.tag GROUP BY v.tag")
def zero_filled_counts(spark, folder):
    """Counts of given tags, 0 where there are none."""
    return aggregates.zero_filled(aggregates.element_counts(incidents(spark, folder, "id", "tags"), "tags", "tag"), "tag", _ASKED)


@REGISTRY.add("year_by_severity", f"WITH {INC}, s AS (SELECT year, coalesce({_SEV}, 'Medium') AS sev FROM inc WHERE year IS NOT NULL) SELECT year, " + ", ".join(f"count(*) FILTER (sev = '{s}') AS \"{s}\"" for s in SEVERITIES) + " FROM s GROUP BY year")
def year_by_severity(spark, folder):
    """Records by year and severity."""
    rows = incidents(spark, folder, "id", "year", "severity").where("year IS NOT NULL").select("year", one_of(F.col("severity"), SEVERITIES, "Medium").alias("sev"))
    return aggregates.crosstab(rows, "year", "sev", SEVERITIES)


@REGISTRY.add("corpus_stats", f"WITH {INC} SELECT count(*) FILTER ({_STANDS}) AS standing, count(*) FILTER (status = 'retracted') AS retracted, count(*) FILTER (status = 'unverified') AS unverified, count(*) FILTER (status = 'disputed') AS disputed, min(year) AS first_year, max(year) AS last_year, count(*) FILTER (len(cve_ids) > 0) AS with_cve, count(DISTINCT year) AS years FROM inc")
def corpus_stats(spark, folder):
    """The corpus in one row."""
    from quernstone.operators.search import stands

    is_status = lambda s: F.count_if(F.col("status") == s).alias(s)
    return incidents(spark, folder, "id", "year", "cve_ids", "status").agg(F.count_if(stands()).alias("standing"), is_status("retracted"), is_status("unverified"), is_status("disputed"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count_if(F.size(F.coalesce("cve_ids", F.array())) > 0).alias("with_cve"), F.count_distinct("year").alias("years"))


@REGISTRY.add("top_vectors", f"WITH {INC} SELECT coalesce(nullif(attack_vector, ''), 'other') AS value, count(*) AS n FROM inc GROUP BY 1 ORDER BY n DESC, min(id), 1 LIMIT 12")
def top_vectors(spark, folder):
    """The twelve most frequent classes; ties in the order of their first record."""
    return aggregates.top(incidents(spark, folder, "id", "attack_vector"), F.coalesce(F.nullif(F.col("attack_vector"), F.lit("")), F.lit("other")), F.col("id"), 12)


@REGISTRY.add("reference_buckets", f"WITH {INC}, s AS (SELECT len(coalesce(\"references\", [])) AS k FROM inc) SELECT CASE WHEN k <= 0 THEN '0' WHEN k <= 1 THEN '1' WHEN k <= 2 THEN '2' WHEN k <= 4 THEN '3-4' ELSE '5+' END AS bucket, count(*) AS n FROM s GROUP BY 1")
def reference_buckets(spark, folder):
    """Histogram of the number of references."""
    size = F.size(F.coalesce("references", F.array().cast("array<struct<title:string,url:string,type:string>>")))
    return incidents(spark, folder, "id", "references").groupBy(aggregates.bucket(size, [(0, "0"), (1, "1"), (2, "2"), (4, "3-4")], "5+").alias("bucket")).agg(F.count("*").alias("n"))


@REGISTRY.add("vendor_totals", "SELECT p.vendor, count(*) AS n, count(DISTINCT i.id) AS ids FROM incidents i JOIN products p USING (package) GROUP BY p.vendor")
def vendor_totals(spark, folder):
    """Rows and records per vendor."""
    return table(spark, folder, "incidents").select("package", "id").join(table(spark, folder, "products"), "package").groupBy("vendor").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))


@REGISTRY.add("coverage_sets", f"WITH {INC} SELECT (SELECT count(DISTINCT package) FROM inc WHERE package IN (SELECT package FROM products)) AS seen, (SELECT count(*) FROM products) AS population")
def coverage_sets(spark, folder):
    """How many of a population are observed."""
    products = table(spark, folder, "products").select("package")
    seen = incidents(spark, folder, "id", "package").select("package").join(products, "package", "left_semi").agg(F.count_distinct("package").alias("seen"))
    return seen.withColumn("population", products.agg(F.count("*")).scalar())


_LABEL = "CASE WHEN doc_id % 7 = 0 THEN NULL WHEN n_chars > 1000 THEN 1 ELSE 0 END"
_SAMPLE = f"s AS (SELECT coalesce(source, '-') AS stratum, lang, {_LABEL} AS y FROM documents WHERE doc_id % 3 = 0), p AS (SELECT coalesce(source, '-') AS stratum, count(*)::DOUBLE AS size FROM documents GROUP BY 1)"
_Z = estimates.Z95


def _wilson_sql(p, n):
    z2 = _Z * _Z
    half = f"{_Z} * sqrt({p} * (1 - {p}) / {n} + {z2} / (4 * {n} * {n})) / (1 + {z2} / {n})"
    middle = f"({p} + {z2} / (2 * {n})) / (1 + {z2} / {n})"
    return f"greatest(0, {middle} - {half})", f"least(1, {middle} + {half})"


_LOW, _HIGH = _wilson_sql("p", "e")
_EST = """, d AS (SELECT {by} stratum, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS hits FROM s WHERE y IS NOT NULL GROUP BY ALL), w AS (SELECT d.*, size, size / n AS w FROM d JOIN p USING (stratum)),
    t AS (SELECT {by} count(*) AS strata, sum(n)::BIGINT AS n, sum(size) AS population, sum(w * n) * sum(w * n) / sum(w * w * n) AS e, sum(w * hits) / sum(size) AS p FROM w GROUP BY ALL)"""


def _sample(spark, folder):
    """Every third document is the drawn sample, its label made from its length."""
    docs = table(spark, folder, "documents").withColumn("stratum", F.coalesce("source", F.lit("-")))
    y = F.when(F.col("doc_id") % 7 == 0, F.lit(None)).when(F.col("n_chars") > 1000, 1).otherwise(0)
    return docs.where("doc_id % 3 = 0").select("stratum", "lang", y.alias("y")), docs.groupBy("stratum").agg(F.count("*").alias("size"))


def _rounded(df, names):
    return df.select(*(F.round(c, 9).alias(c) if c in names else c for c in df.columns))


@REGISTRY.add("stratified_estimate", f"WITH {_SAMPLE}{_EST.format(by='')} SELECT strata, n, population, round(e, 9) AS effective_n, round(p, 9) AS estimate, round({_LOW}, 9) AS low, round({_HIGH}, 9) AS high FROM t")
def stratified_estimate(spark, folder):
    """A share estimated from a stratified sample, with its interval."""
    return _rounded(estimates.stratified(*_sample(spark, folder)), ["effective_n", "estimate", "low", "high"])


@REGISTRY.add("domain_estimates", f"WITH {_SAMPLE}{_EST.format(by='lang,')} SELECT lang, strata, n, population, round(e, 9) AS effective_n, round(p, 9) AS estimate, round({_LOW}, 9) AS low, round({_HIGH}, 9) AS high FROM t")
def domain_estimates(spark, folder):
    """The same for each language."""
    return _rounded(estimates.stratified(*_sample(spark, folder), ["lang"]), ["effective_n", "estimate", "low", "high"])


_PLOW, _PHIGH = _wilson_sql("precision", "(tp + fp)")
_RLOW, _RHIGH = _wilson_sql("recall", "(tp + fn)")


@REGISTRY.add(
    "confusion_matrix",
    f"WITH c AS (SELECT count(*) FILTER (a AND b) AS tp, count(*) FILTER (a AND NOT b) AS fp, count(*) FILTER (NOT a AND b) AS fn, count(*) FILTER (NOT a AND NOT b) AS tn FROM (SELECT contains(lower(text), 'agent') AS a, n_chars > 1000 AS b FROM documents)), r AS (SELECT *, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall FROM c) SELECT tp, fp, fn, tn, round(precision, 9) AS precision, round({_PLOW}, 9) AS precision_low, round({_PHIGH}, 9) AS precision_high, round(recall, 9) AS recall, round({_RLOW}, 9) AS recall_low, round({_RHIGH}, 9) AS recall_high FROM r",
)
def confusion_matrix(spark, folder):
    """A rule's errors against labels, with intervals."""
    docs = table(spark, folder, "documents")
    out = estimates.confusion(docs, F.contains(F.lower("text"), F.lit("agent")), F.col("n_chars") > 1000)
    return _rounded(out, [c for c in out.columns if c.startswith(("precision", "recall"))])


_STRATA = "f AS (SELECT *, coalesce(quality_tier, '-') AS tier FROM inc), c AS (SELECT tier, feed, count(*) AS n, sum(count(*)) OVER (PARTITION BY tier) AS total FROM f GROUP BY tier, feed), g AS (SELECT tier, feed, CASE WHEN n < 0.02 * total THEN 'other' ELSE feed END AS family FROM c), k AS (SELECT f.id, f.tier || '/' || g.family AS stratum FROM f JOIN g ON f.tier = g.tier AND f.feed = g.feed), z AS (SELECT stratum, count(*) AS size FROM k GROUP BY stratum)"


def _strata(spark, folder):
    return sampling.frame(incidents(spark, folder, "id", "quality_tier", "feed"), F.coalesce("quality_tier", F.lit("-")), F.col("feed"))


@REGISTRY.add("stratum_quotas", f"WITH {INC}, {_STRATA}, e AS (SELECT *, 150 * size / sum(size) OVER () AS exact FROM z), r AS (SELECT *, row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, size DESC, stratum) AS rank, 150 - sum(floor(exact)) OVER () AS spare FROM e) SELECT stratum, size, (floor(exact) + CASE WHEN rank <= spare THEN 1 ELSE 0 END)::BIGINT AS quota FROM r")
def stratum_quotas(spark, folder):
    """150 rows split over strata by largest remainders, small families pooled."""
    return sampling.allocate(_strata(spark, folder).groupBy("stratum").agg(F.count("*").alias("size")), 150)


@REGISTRY.add(
    "systematic_sample",
    f"""WITH {INC}, {_STRATA}, e AS (SELECT *, 150 * size / sum(size) OVER () AS exact FROM z), r AS (SELECT *, row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, size DESC, stratum) AS rank, 150 - sum(floor(exact)) OVER () AS spare FROM e), q AS (SELECT stratum, size, (floor(exact) + CASE WHEN rank <= spare THEN 1 ELSE 0 END)::BIGINT AS quota FROM r),
    picks AS (SELECT stratum, floor((('0x' || substr(md5('20261011|' || stratum), 1, 12))::BIGINT / 281474976710656.0 + i) * (size / quota))::BIGINT AS place FROM (SELECT *, unnest(range(quota)) AS i FROM q WHERE quota > 0)),
    placed AS (SELECT id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY id) - 1 AS place FROM k)
    SELECT id, stratum FROM placed JOIN picks USING (stratum, place)""",
)
def systematic_sample(spark, folder):
    """The stratified systematic sample itself."""
    rows = _strata(spark, folder).select("id", "stratum")
    return sampling.systematic(rows, sampling.allocate(rows.groupBy("stratum").agg(F.count("*").alias("size")), 150), ["id"], 20_261_011)


@REGISTRY.add("rotating_sample", "SELECT doc_id FROM documents ORDER BY (doc_id <= 990)::INT, doc_id LIMIT 25")
def rotating_sample(spark, folder):
    """The next 25 documents after a cursor, starting over at the end."""
    return sampling.rotating(table(spark, folder, "documents").select("doc_id"), "doc_id", 990, 25)


@REGISTRY.add("fresh_sample", f"WITH {INC} SELECT id FROM inc WHERE id NOT IN (SELECT incident_id FROM documents WHERE incident_id IS NOT NULL) ORDER BY id LIMIT 40")
def fresh_sample(spark, folder):
    """The first forty records that no document refers to."""
    used = table(spark, folder, "documents").select(F.col("incident_id").alias("id")).where("id IS NOT NULL")
    return sampling.first_not_in(incidents(spark, folder, "id"), used, "id", "id", 40)


_KEV = "kev AS (SELECT upper(trim(c)) AS cve, min(snapshot_on) AS added FROM (SELECT unnest(cve_ids) AS c, updated AS snapshot_on FROM incidents WHERE exploited_in_wild) WHERE c IS NOT NULL GROUP BY 1)"


def _known_exploited(spark, folder):
    """A side table keyed by CVE, made from the records that say so."""
    each = table(spark, folder, "incidents").where("exploited_in_wild").select(F.explode("cve_ids").alias("cve"), "updated").where("cve IS NOT NULL")
    return each.groupBy(F.upper(F.trim("cve")).alias("cve")).agg(F.min("updated").alias("added"))


@REGISTRY.add("enriched_by_element", f"WITH {INC}, {_KEV} SELECT i.id, min(k.added) AS first_added, count(DISTINCT k.cve) AS known FROM (SELECT id, unnest(CASE WHEN len(cve_ids) > 0 THEN cve_ids ELSE [NULL] END) AS cve FROM inc) i LEFT JOIN kev k USING (cve) GROUP BY i.id")
def enriched_by_element(spark, folder):
    """The earliest date a side table has for any of a record's identifiers."""
    out = enrich.best_of_elements(incidents(spark, folder, "id", "cve_ids"), "id", "cve_ids", _known_exploited(spark, folder), "cve", {"first_added": F.min("added"), "known": F.count("*")})
    return out.select("id", "first_added", F.coalesce("known", F.lit(0)).alias("known"))


@REGISTRY.add("subset_states", f"WITH {INC}, {_KEV}, e AS (SELECT DISTINCT id, unnest(cve_ids) AS cve FROM inc), m AS (SELECT id, count(*) AS n, count(k.cve) AS hit, array_to_string(list_sort(list(k.cve) FILTER (k.cve IS NOT NULL)), ' ') AS marked FROM e LEFT JOIN kev k USING (cve) WHERE e.cve IS NOT NULL GROUP BY id) SELECT inc.id, coalesce(marked, '') AS marked, coalesce(n = hit AND n > 0, false) AS all_marked FROM inc LEFT JOIN m USING (id)")
def subset_states(spark, folder):
    """Which of a record's identifiers are marked, and whether all are."""
    out = enrich.subset_state(incidents(spark, folder, "id", "cve_ids").select("id", "cve_ids"), "id", "cve_ids", _known_exploited(spark, folder), "cve")
    return out.select("id", F.array_join("marked", " ").alias("marked"), "all_marked")


@REGISTRY.add("without_denied", f"WITH {INC} SELECT id FROM inc WHERE NOT list_has_any(coalesce(list_filter(tags, lambda x: x IS NOT NULL), []), ['rce', 'xss'])")
def without_denied(spark, folder):
    """Records with none of the denied tags."""
    denied = spark.createDataFrame([("rce",), ("xss",)], "tag string")
    return enrich.without_any(incidents(spark, folder, "id", "tags"), "id", "tags", denied, "tag").select("id")


@REGISTRY.add("first_override", f"WITH {INC}, o AS (SELECT package AS sid, vendor AS owner FROM products), p AS (SELECT id, unnest([package, 'x']) AS sid, unnest([1, 2]) AS pos FROM inc) SELECT inc.id, arg_min(o.owner, p.pos) FILTER (o.owner IS NOT NULL) AS owner FROM inc LEFT JOIN p ON p.id = inc.id LEFT JOIN o ON o.sid = p.sid GROUP BY inc.id")
def first_override(spark, folder):
    """Fields from the side table of the first element that has a row in it."""
    side = table(spark, folder, "products").select(F.col("package").alias("sid"), F.col("vendor").alias("owner"))
    rows = incidents(spark, folder, "id", "package").select("id", F.array("package", F.lit("x")).alias("sids"))
    return enrich.first_hit(rows, "id", "sids", side, "sid", ["owner"]).select("id", "owner")


_HOLD = "k AS (SELECT DISTINCT id, upper(trim(u)) AS cve FROM (SELECT id, unnest(cve_ids) AS u FROM inc) WHERE regexp_full_match(upper(trim(u)), 'CVE-[0-9]{4}-[0-9]{4,9}')), t AS (SELECT id, substr(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')), 1, 80) AS tk FROM inc)"


@REGISTRY.add("would_merge", f"WITH {INC}, {_HOLD}, h AS (SELECT a.id, 0 AS r, 'cve' AS kind, b.id AS other FROM k a JOIN k b USING (cve) WHERE a.id <> b.id UNION ALL SELECT a.id, 1, 'title', b.id FROM t a JOIN t b USING (tk) WHERE a.id <> b.id) SELECT id, arg_min(kind, (r, other)) AS kind, arg_min(other, (r, other)) AS other FROM h GROUP BY id")
def would_merge(spark, folder):
    """For each record the first kind of key that another record shares, and the smallest such record."""
    inc = incidents(spark, folder, "id", "title", "cve_ids")
    rows = inc.select("id", cve_ids("cve_ids").alias("cves"), title_key(F.col("title")).alias("tk"))
    cves = rows.select(F.explode("cves").alias("cve"), "id")
    return enrich.by_priority(rows, "id", [("cve", cves, "cves"), ("title", rows.select("tk", "id"), "tk")], "other")


@REGISTRY.add("parent_lookup", "WITH c AS (SELECT DISTINCT p_type, p_type || '.' || (p_size % 3)::VARCHAR AS code FROM part), m AS (SELECT DISTINCT p_type, CASE WHEN p_type LIKE '%STEEL%' THEN 'metal' WHEN p_type LIKE '%BRASS%' THEN 'alloy' END AS v FROM part) SELECT c.code, coalesce(m.v, '') AS found FROM c JOIN m USING (p_type)")
def parent_lookup(spark, folder):
    """Codes looked up by themselves or by their parent."""
    part = table(spark, folder, "part")
    kinds = F.when(F.col("p_type").contains("STEEL"), F.array(F.lit("metal"))).when(F.col("p_type").contains("BRASS"), F.array(F.lit("alloy"))).otherwise(F.array().cast("array<string>"))
    codes = part.select("p_type", F.concat_ws(".", "p_type", (F.col("p_size") % 3).cast("string")).alias("code")).distinct()
    return codes.select("code", F.array_join(enrich.with_parent_fallback(F.array("code"), F.create_map(F.col("p_type"), kinds)), ",").alias("found"))


_BEFORE_AFTER = "b AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 10 <> 0), a AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN upper(c_mktsegment) || '!' ELSE c_mktsegment END AS c_mktsegment, c_name, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM customer WHERE c_custkey % 13 <> 0)"


def _states(spark, folder):
    c = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    after = c.where("c_custkey % 13 <> 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, F.concat(F.upper("c_mktsegment"), F.lit("!"))).otherwise(F.col("c_mktsegment"))).withColumn("c_nationkey", F.when(F.col("c_custkey") % 11 != 0, F.col("c_nationkey")))
    return c.where("c_custkey % 10 <> 0"), after


@REGISTRY.add("changed_keys", f"WITH {_BEFORE_AFTER} SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, CASE WHEN b.c_custkey IS NULL THEN 'added' WHEN a.c_custkey IS NULL THEN 'removed' ELSE 'changed' END AS change FROM b FULL JOIN a ON a.c_custkey = b.c_custkey WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL OR (a.c_name, a.c_nationkey, a.c_mktsegment) IS DISTINCT FROM (b.c_name, b.c_nationkey, b.c_mktsegment)")
def changed_keys(spark, folder):
    """Keys that two states of a table don't agree in."""
    return diffs.changed_keys(*_states(spark, folder), "c_custkey")


@REGISTRY.add("field_changes", f"""WITH {_BEFORE_AFTER}, d AS (SELECT b.c_custkey, b.c_nationkey AS o1, a.c_nationkey AS n1, b.c_mktsegment AS o2, a.c_mktsegment AS n2 FROM b JOIN a USING (c_custkey))
    SELECT c_custkey, 'c_nationkey' AS field, o1::VARCHAR AS old, n1::VARCHAR AS new FROM d WHERE o1 IS DISTINCT FROM n1 UNION ALL SELECT c_custkey, 'c_mktsegment', '"' || o2 || '"', '"' || n2 || '"' FROM d WHERE o2 IS DISTINCT FROM n2""")
def field_changes(spark, folder):
    """Each differing field with its old and new value."""
    before, after = _states(spark, folder)
    return diffs.changed_fields(before, after, "c_custkey", ["c_name", "c_nationkey", "c_mktsegment"])


@REGISTRY.add("field_change_counts", f"WITH {_BEFORE_AFTER}, d AS (SELECT b.c_nationkey AS o1, a.c_nationkey AS n1, b.c_mktsegment AS o2, a.c_mktsegment AS n2 FROM b JOIN a USING (c_custkey)) SELECT * FROM (SELECT 'c_nationkey' AS field, count(*) FILTER (o1 IS DISTINCT FROM n1) AS n FROM d UNION ALL SELECT 'c_mktsegment', count(*) FILTER (o2 IS DISTINCT FROM n2) FROM d) WHERE n > 0")
def field_change_counts(spark, folder):
    """How often each field differs."""
    before, after = _states(spark, folder)
    return diffs.field_counts(diffs.changed_fields(before, after, "c_custkey", ["c_name", "c_nationkey", "c_mktsegment"]))


@REGISTRY.add("code_census", f"WITH {INC} SELECT code, count(*) AS n FROM (SELECT unnest(cwe_ids) AS code FROM inc) WHERE code IS NOT NULL GROUP BY code")
def code_census(spark, folder):
    """The multiset of codes."""
    return diffs.code_census(incidents(spark, folder, "id", "cwe_ids"), "cwe_ids")


@REGISTRY.add("one_sided_values", "WITH a AS (SELECT DISTINCT package AS v FROM incidents WHERE package IS NOT NULL), b AS (SELECT DISTINCT package AS v FROM documents WHERE package IS NOT NULL) SELECT v AS value, 'removed' AS side FROM a WHERE v NOT IN (SELECT v FROM b) UNION ALL SELECT v, 'added' FROM b WHERE v NOT IN (SELECT v FROM a)")
def one_sided_values(spark, folder):
    """Packages of one table only."""
    held = [table(spark, folder, t).select("package").where("package IS NOT NULL") for t in ("incidents", "documents")]
    return diffs.set_difference(*held, "package")


@REGISTRY.add("upserted", "WITH f AS (SELECT s_suppkey, s_name || ' new' AS s_name FROM supplier WHERE s_suppkey % 4 = 0) SELECT * FROM f UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM f)")
def upserted(spark, folder):
    """Fresh rows over old ones."""
    old = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return upsert(old.where("s_suppkey % 4 = 0").withColumn("s_name", F.concat("s_name", F.lit(" new"))), old, ["s_suppkey"])


@REGISTRY.add("retained_rows", "SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'retained' END AS source_status FROM supplier")
def retained_rows(spark, folder):
    """Rows that a fresh delivery lacks stay, marked."""
    old = table(spark, folder, "supplier").select("s_suppkey")
    return retained(old, old.where("s_suppkey % 4 <> 0"), ["s_suppkey"], "source_status", "retained")


@REGISTRY.add("first_of_key", "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_of_key(spark, folder):
    """The first event of each user and type."""
    return first_by(table(spark, folder, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


@REGISTRY.add("broken_rules", f"WITH {INC} SELECT rule, id AS subject, NULL::VARCHAR AS detail FROM (SELECT id, 'severity is a level' AS rule, coalesce(severity IN ('Info', 'Low', 'Medium', 'High', 'Critical'), false) AS ok FROM inc UNION ALL SELECT id, 'description is long enough', coalesce(length(description) >= 20, false) FROM inc UNION ALL SELECT id, 'year fits date', coalesce(year = try_cast(substr(date, 1, 4) AS INT), false) FROM inc) WHERE NOT ok")
def broken_rules(spark, folder):
    """Findings of row checks."""
    rules = {"severity is a level": F.col("severity").isin(SEVERITIES), "description is long enough": F.length("description") >= 20, "year fits date": F.col("year") == F.substring("date", 1, 4).try_cast("int")}
    return quality.violations(incidents(spark, folder, "id", "description", "date", "year", "severity"), "id", rules)


@REGISTRY.add("keys_held_twice", f"WITH {INC} SELECT 'key held by several rows: cve_ids' AS rule, key AS subject, count(DISTINCT id)::VARCHAR AS detail FROM (SELECT id, unnest(cve_ids) AS key FROM inc) WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT id) > 1")
def keys_held_twice(spark, folder):
    """Identifiers of several records."""
    return quality.repeated_keys(incidents(spark, folder, "id", "cve_ids"), "id", ["cve_ids"])


@REGISTRY.add("lost_references", "SELECT 'package refers to nothing' AS rule, doc_id::VARCHAR AS subject, package AS detail FROM documents WHERE package IS NOT NULL AND package NOT IN (SELECT package FROM products WHERE package NOT LIKE '%a%')")
def lost_references(spark, folder):
    """References without a target."""
    known = table(spark, folder, "products").where("package NOT LIKE '%a%'")
    return quality.missing_references(table(spark, folder, "documents"), "doc_id", "package", known, "package")


_OLD_NEW = "o AS (SELECT id, unnest(source_ids) AS key FROM inc), n AS (SELECT key, 'N' || (hash_ % 3)::VARCHAR AS id FROM (SELECT key, min(length(key) + ascii(right(key, 1))) AS hash_ FROM o WHERE key IS NOT NULL AND key <> '' GROUP BY key))"


@REGISTRY.add("split_keys", f"WITH {INC}, {_OLD_NEW} SELECT o.id AS old_id, array_to_string(list_sort(list(DISTINCT n.id)), ',') AS new_ids FROM o JOIN n USING (key) GROUP BY o.id HAVING count(DISTINCT n.id) > 1")
def split_keys(spark, folder):
    """Old ids whose keys went to several new ids."""
    old = incidents(spark, folder, "id", "source_ids").select(F.explode("source_ids").alias("key"), "id").where("key IS NOT NULL AND key <> ''")
    new = old.groupBy("key").agg(F.min(F.length("key") + F.ascii(F.right(F.col("key"), F.lit(1)))).alias("h")).select("key", F.concat(F.lit("N"), (F.col("h") % 3).cast("string")).alias("id"))
    return quality.split_keys(old, new).select("old_id", F.array_join("new_ids", ",").alias("new_ids"))


@REGISTRY.add("shrunk_sources", "SELECT source, count(*) AS old, count(*) FILTER (n_chars > 500) AS new FROM documents GROUP BY source HAVING count(*) FILTER (n_chars > 500) < 0.9 * count(*) AND source IS NOT NULL")
def shrunk_sources(spark, folder):
    """Sources that lost more than a tenth of their rows."""
    docs = table(spark, folder, "documents").where("source IS NOT NULL")
    return quality.yield_kept(docs.where("n_chars > 500"), docs, "source")


_RUNS = "runs AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'error' THEN 'failure' WHEN 'view' THEN 'success' ELSE 'skipped' END AS outcome FROM events), era AS (SELECT *, sum((outcome = 'success')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS e FROM runs)"


def _runs(spark, folder):
    kind = F.when(F.col("event_type") == "error", "failure").when(F.col("event_type") == "view", "success").otherwise("skipped")
    return table(spark, folder, "events").select("user_id", "ts", "event_id", kind.alias("outcome"))


@REGISTRY.add("health_history", f"WITH {_RUNS}, f AS (SELECT event_id, user_id, sum((outcome = 'failure')::INT) OVER (PARTITION BY user_id, e ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS failures FROM era) SELECT event_id, user_id, failures, CASE WHEN failures >= 3 THEN 'stale' WHEN failures > 0 THEN 'degraded' ELSE 'ok' END AS status FROM f")
def health_history(spark, folder):
    """Failures in a row and status after each run."""
    return health.health_history(_runs(spark, folder), "user_id", ["ts", "event_id"], "outcome").select("event_id", "user_id", "failures", "status")


@REGISTRY.add("current_health", f"WITH {_RUNS}, l AS (SELECT user_id, max(ts) FILTER (outcome = 'success') AS last_success FROM runs GROUP BY user_id), f AS (SELECT r.user_id, count(*) FILTER (outcome = 'failure') AS failures FROM runs r JOIN l USING (user_id) WHERE last_success IS NULL OR ts > last_success GROUP BY r.user_id) SELECT l.user_id, strftime(last_success, '%Y-%m-%d %H:%M:%S') AS last_success, coalesce(failures, 0) AS failures, CASE WHEN failures >= 3 THEN 'stale' WHEN failures > 0 THEN 'degraded' ELSE 'ok' END AS status FROM l LEFT JOIN f USING (user_id)")
def current_health(spark, folder):
    """Each source's state after all runs."""
    return health.current_health(_runs(spark, folder), "user_id", "ts", "outcome").withColumn("last_success", F.date_format("last_success", "yyyy-MM-dd HH:mm:ss"))


_LOG = "log AS (SELECT p_partkey AS seq, p_partkey AS \"from\", CASE WHEN p_partkey % 11 = 0 THEN []::BIGINT[] WHEN p_partkey % 10 = 0 THEN [p_partkey + 1, p_partkey + 2] WHEN p_partkey % 8 = 0 THEN [p_partkey - 1] ELSE [p_partkey + p_partkey % 7 + 1] END AS \"into\" FROM part WHERE p_partkey % 3 <> 0), live AS (SELECT p_partkey AS id FROM part WHERE p_partkey % 3 = 0)"


def _log(spark, folder):
    k = F.col("p_partkey")
    part = table(spark, folder, "part")
    into = F.when(k % 11 == 0, F.array().cast("array<bigint>")).when(k % 10 == 0, F.array(k + 1, k + 2)).when(k % 8 == 0, F.array(k - 1)).otherwise(F.array(k + k % 7 + 1))
    ids = part.select(k.alias("id"))
    return ids, part.where("p_partkey % 3 <> 0").select(k.alias("seq"), k.alias("from"), into.alias("into")), ids.where("id % 3 = 0")


@REGISTRY.add(
    "resolved_ids",
    f"""WITH RECURSIVE {_LOG}, walk AS (
        SELECT p_partkey AS id, p_partkey AS node, [p_partkey] AS path FROM part
        UNION ALL SELECT w.id, l."into"[1], list_append(w.path, l."into"[1]) FROM walk w JOIN log l ON l."from" = w.node WHERE len(l."into") = 1 AND NOT list_contains(w.path, l."into"[1]) AND w.node NOT IN (SELECT id FROM live)
    ) SELECT id, max(CASE WHEN node IN (SELECT id FROM live) THEN node END)::VARCHAR AS target FROM walk GROUP BY id""",
)
def resolved_ids(spark, folder):
    """The live id at the end of each chain of single successors."""
    return redirects.resolve(*_log(spark, folder)).withColumn("target", F.col("target").cast("string"))


_WALK_ALL = f"""WITH RECURSIVE {_LOG}, walk AS (
        SELECT p_partkey AS id, p_partkey AS node, [p_partkey] AS path FROM part
        UNION ALL SELECT id, nxt, list_append(path, nxt) FROM (SELECT w.id, w.path, unnest(l."into") AS nxt FROM walk w JOIN log l ON l."from" = w.node WHERE w.node NOT IN (SELECT id FROM live)) WHERE NOT list_contains(path, nxt)
    ), g AS (SELECT id, list_sort(list(DISTINCT node) FILTER (node IN (SELECT id FROM live))) AS targets FROM walk GROUP BY id)"""


@REGISTRY.add("answered_ids", _WALK_ALL + "SELECT id, CASE WHEN id IN (SELECT id FROM live) THEN 'live' WHEN id NOT IN (SELECT \"from\" FROM log) THEN 'unknown' WHEN coalesce(len(targets), 0) = 0 THEN 'withdrawn' WHEN len(targets) = 1 THEN 'successor' ELSE 'group' END AS kind, coalesce(array_to_string(targets, ','), '') AS targets FROM g")
def answered_ids(spark, folder):
    """What became of each id."""
    return redirects.answer(*_log(spark, folder)).select("id", "kind", F.array_join("targets", ",").alias("targets"))


# The same log with reasons; every fifth id has a scoped record before its general one, whose successor lies elsewhere.
_STATUS = _WALK_ALL.replace("WHERE p_partkey % 3 <> 0), live AS", "WHERE p_partkey % 3 <> 0 AND p_partkey % 11 <> 0), live AS") + """, single AS (
        SELECT p_partkey AS id, p_partkey AS node, [p_partkey] AS path FROM part
        UNION ALL SELECT w.id, l."into"[1], list_append(w.path, l."into"[1]) FROM single w JOIN log l ON l."from" = w.node WHERE len(l."into") = 1 AND NOT list_contains(w.path, l."into"[1]) AND w.node NOT IN (SELECT id FROM live)
    ), o AS (SELECT id, max(CASE WHEN node IN (SELECT id FROM live) THEN node END) AS one FROM single GROUP BY id
    ), a AS (
        SELECT id, id % 3 = 0 AS alive, id % 5 = 0 AND id % 3 <> 0 AS scoped, id % 3 <> 0 AS known, 'r' || (id % 4) AS reason FROM o
    )"""


def _status(spark, folder, release):
    ids, log, live = _log(spark, folder)
    k = F.col("from")
    general = log.select((k * 2 + 1).alias("seq"), "from", "into", F.concat(F.lit("r"), (k % 4).cast("string")).alias("reason"), F.lit(None).cast("array<string>").alias("releases"))
    scoped = log.where("from % 5 = 0").select((k * 2).alias("seq"), "from", F.array(k + 2).alias("into"), F.lit("moved").alias("reason"), F.array(F.lit("v1.0.0"), F.lit("v1.1.0")).alias("releases"))
    out = redirects.status(ids, general.unionByName(scoped), live, release, untold=("r3",))
    return out.select("id", "status", "successor", F.array_join("group", ",").alias("group"), F.size(F.coalesce(F.map_keys("by_release"), F.array().cast("array<string>"))).alias("releases"), "reason")


@REGISTRY.add("id_status", _STATUS + """ SELECT a.id, CASE WHEN alive THEN 'live' WHEN scoped THEN 'release-dependent' WHEN known AND reason = 'r3' THEN 'pre-tombstone' WHEN one IS NOT NULL THEN 'successor' WHEN len(coalesce(targets, [])) > 0 THEN 'group' WHEN known THEN 'withdrawn' ELSE 'unknown' END AS status,
    CASE WHEN alive OR (NOT scoped AND reason <> 'r3') THEN one END AS successor, coalesce(array_to_string(targets, ','), '') AS "group", CASE WHEN scoped THEN 2 ELSE 0 END AS releases, CASE WHEN NOT alive THEN reason END AS reason
    FROM a JOIN o USING (id) JOIN g USING (id)""")
def id_status(spark, folder):
    """How each id resolves in general, with the reason."""
    return _status(spark, folder, None)


@REGISTRY.add("id_status_in_release", _STATUS + """, p AS (SELECT *, CASE WHEN scoped THEN id + 2 ELSE id END AS start FROM a), q AS (
        SELECT p.*, coalesce(o.one, CASE WHEN p.start % 3 = 0 THEN p.start END) AS one, coalesce(g.targets, []) AS targets FROM p LEFT JOIN o ON o.id = p.start LEFT JOIN g ON g.id = p.start
    ) SELECT id, CASE WHEN alive THEN 'live' WHEN scoped THEN CASE WHEN one IS NOT NULL THEN 'successor' WHEN len(targets) > 0 THEN 'group' ELSE 'withdrawn' END
        WHEN known AND reason = 'r3' THEN 'pre-tombstone' WHEN one IS NOT NULL THEN 'successor' WHEN len(targets) > 0 THEN 'group' WHEN known THEN 'withdrawn' ELSE 'unknown' END AS status,
    CASE WHEN alive OR scoped OR reason <> 'r3' THEN one END AS successor, array_to_string(targets, ',') AS "group", CASE WHEN scoped THEN 2 ELSE 0 END AS releases, CASE WHEN alive THEN NULL WHEN scoped THEN 'moved' ELSE reason END AS reason FROM q""")
def id_status_in_release(spark, folder):
    """How each id that a citation took from release 1.1.0 resolves."""
    return _status(spark, folder, "1.1.0")


@REGISTRY.add("merged_records")
def merged_records(spark, folder):
    """Records merged in order by identifiers, URLs and titles; see tests for the reference run."""
    from quernstone.functions.identifiers import identifiers
    from quernstone.functions.urls import normalize_url

    inc = incidents(spark, folder, "id", "title", "year", "source_ids", "cve_ids", "references")
    rows = identity.ranked(inc.select("id", "title", "year", "references", "cve_ids", "source_ids"), "id").select(
        F.col("rank").alias("seq"), "id", identifiers("cve_ids").alias("cve"), identifiers("source_ids").alias("source"), F.array_distinct(F.filter(F.transform(F.col("references.url"), lambda u: normalize_url(u)), lambda u: u.isNotNull())).alias("url"), title_key(F.col("title")).alias("title"), "year"
    )
    merged = identity.ordered_merge(rows, round_ups="/weekly/")
    ids = rows.select("seq", "id")
    return merged.join(ids, "seq").join(ids.select(F.col("seq").alias("survivor"), F.col("id").alias("survivor_id")), "survivor").select("id", "survivor_id")


@REGISTRY.add("merged_fields", f"WITH {INC} SELECT package, count(*) AS merged_rows, array_to_string(list_sort(list_distinct(flatten(list(list_filter(coalesce(cwe_ids, []), lambda x: x IS NOT NULL))))), ',') AS cwe_ids, arg_min(affected, id) FILTER (affected IS NOT NULL AND affected <> '') AS affected, arg_max(severity, (CASE severity WHEN 'Info' THEN 0 WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 WHEN 'Critical' THEN 4 ELSE -1 END, -try_cast(substr(id, 5) AS BIGINT))) FILTER (severity IN ('Info', 'Low', 'Medium', 'High', 'Critical')) AS severity FROM inc WHERE package IS NOT NULL GROUP BY package")
def merged_fields(spark, folder):
    """Field by field merge of a package's records."""
    from quernstone.functions.text import rank_in

    rows = incidents(spark, folder, "id", "severity", "affected", "package", "cwe_ids").where("package IS NOT NULL").withColumn("seq", F.substring("id", 5, 20).try_cast("bigint")).withColumn("severity", F.when(F.col("severity").isin(SEVERITIES), F.col("severity")))
    merged = identity.merge_fields(rows, "package", "seq", ["cwe_ids"], ["affected"], {"severity": rank_in(F.col("severity"), SEVERITIES)})
    return merged.select("package", "merged_rows", F.array_join("cwe_ids", ",").alias("cwe_ids"), "affected", "severity")


@REGISTRY.add("allocated_ids", "WITH c AS (SELECT s_suppkey AS seq, CASE WHEN s_suppkey % 3 = 0 THEN 'OLD-' || lpad((s_suppkey - s_suppkey % 2)::VARCHAR, 4, '0') END AS wish FROM supplier), t AS (SELECT wish, min(seq) AS taker FROM c WHERE wish IS NOT NULL GROUP BY wish), k AS (SELECT c.seq, c.wish, t.taker FROM c LEFT JOIN t ON t.wish = c.wish AND t.taker = c.seq), f AS (SELECT seq, 'INC-' || lpad((row_number() OVER (ORDER BY seq) - 1 + 500)::VARCHAR, 8, '0') AS fresh FROM k WHERE taker IS NULL) SELECT k.seq, coalesce(CASE WHEN taker IS NOT NULL THEN wish END, fresh) AS id, coalesce(wish, '') AS previous FROM k LEFT JOIN f USING (seq)")
def allocated_ids(spark, folder):
    """Known ids kept, new ones numbered in order."""
    s = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("seq"), F.concat(F.lit("k"), F.col("s_suppkey").cast("string")).alias("key"))
    prior = s.where("seq % 3 = 0").select("key", F.concat(F.lit("OLD-"), F.lpad((F.col("seq") - F.col("seq") % 2).cast("string"), 4, "0")).alias("id"))
    return identity.allocate_ids(s, prior, 500).select("seq", "id", F.array_join("previous", ",").alias("previous"))


@REGISTRY.add("ranked_rows", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rank FROM orders")
def ranked_rows(spark, folder):
    """Global ranks without a single-task sort."""
    return identity.ranked(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@REGISTRY.add("content_digest", """WITH h AS (SELECT md5('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS m FROM orders),
    p AS (SELECT ('0x' || substr(m, 1, 12))::BIGINT AS d, ('0x' || substr(m, 13, 12))::BIGINT AS h FROM h)
    SELECT count(*) AS rows, sha256(count(*) || '/' || bit_xor(h) || '/' || sum(d::HUGEINT)) AS digest FROM p""")
def content_digest(spark, folder):
    """An order-free fingerprint of a table."""
    return aggregates.digest(table(spark, folder, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])
