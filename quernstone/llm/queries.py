"""Queries of the training-data operators, with SQL forms where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions.dates import day_range
from quernstone.functions.identifiers import identifiers
from quernstone.llm.components import connected_components, ties_of_values
from quernstone.llm.linkage import entities, link_entities
from quernstone.llm.mixing import mix_sources
from quernstone.llm.near_duplicates import near_duplicates
from quernstone.llm.packing import fill_rates, pack_texts
from quernstone.llm.survivors import Bundle, Dependency, surviving_records
from quernstone.llm.truncation import length_limits, truncated_texts, truncation_rates
from quernstone.plans.lineage import cut
from quernstone.plans.reducer import Reducer
from quernstone.plans.registry import Registry, table

REGISTRY = Registry()

#: A text with at least one character that is not white space.
NOT_BLANK = r"(?U)\S"


def _near_duplicates(spark, folder, usable=None, complete=True):
    incidents = table(spark, folder, "incidents")
    return near_duplicates(incidents, "id", ["title", "description"], "received_at", usable, complete=complete)


#: Words of each record's latest version, and pairs of different texts that are at least 0.75 alike.
_ALIKE = r"""
    latest AS (
        SELECT id, arg_max({{'text': coalesce(title, '') || ' ' || coalesce(description, ''), 'usable': {usable}}}, received_at) AS v FROM incidents GROUP BY id
    ), uses AS (
        SELECT id, v.text AS text, unnest(regexp_extract_all(lower(v.text), '[\p{{L}}\p{{N}}]+')) AS word FROM latest WHERE v.usable
    ), copies AS (
        SELECT DISTINCT id, min(id) OVER (PARTITION BY text) AS head FROM uses
    ), words AS (
        SELECT id, word, count(*) AS n FROM uses WHERE id IN (SELECT head FROM copies) GROUP BY id, word
    ), sizes AS (
        SELECT id, sum(n) AS size FROM words GROUP BY id
    ), common AS (
        SELECT a.id AS id_a, b.id AS id_b, sum(least(a.n, b.n)) AS shared
        FROM words a JOIN words b ON a.word = b.word AND a.id < b.id GROUP BY a.id, b.id
    ), alike AS (
        SELECT id_a, id_b FROM common JOIN sizes x ON x.id = id_a JOIN sizes y ON y.id = id_b WHERE shared >= 0.75 * greatest(x.size, y.size)
        UNION ALL SELECT head, id FROM copies WHERE id <> head
    )
"""


@REGISTRY.add("p1_found", "WITH " + _ALIKE.format(usable=r"coalesce(regexp_matches(description, '\S'), false)") + "SELECT id_a, id_b FROM alike")
def p1_found(spark, folder):
    """Pairs of incident records whose title and description are at least 0.75 alike.

    Records without a description make no case.  Of records with exactly the same text the first stands for
    all in pairs with others, and is paired with each of its copies.
    """
    return _near_duplicates(spark, folder, F.col("description").rlike(NOT_BLANK)).pairs().select("id_a", "id_b")


@REGISTRY.add(
    "p1_groups",
    "WITH RECURSIVE "
    + _ALIKE.format(usable="true")
    + """, ties AS (
        SELECT id_a AS a, id_b AS b FROM alike UNION SELECT id_b, id_a FROM alike
    ), reach(id, other) AS (
        SELECT a, b FROM ties UNION SELECT r.id, t.b FROM reach r JOIN ties t ON t.a = r.other
    )
    SELECT id, least(id, min(other)) AS group_id FROM reach GROUP BY id
    """,
)
def p1_groups(spark, folder):
    """The group of each record that is a copy or near-copy of another one, with or without a description."""
    edges = _near_duplicates(spark, folder, complete=False).edges()
    return connected_components(edges, "id_a", "id_b")


@REGISTRY.add(
    "p1_copies",
    r"""
    WITH latest AS (
        SELECT id, arg_max(coalesce(title, '') || ' ' || coalesce(description, ''), received_at) AS text FROM incidents GROUP BY id
    )
    SELECT id, min(id) OVER (PARTITION BY text) AS copy_of, count(*) OVER (PARTITION BY text) AS copies
    FROM latest WHERE regexp_matches(lower(text), '[\p{L}\p{N}]')
    """,
)
def p1_copies(spark, folder):
    """For each record the first one with exactly its title and description, and how many have them."""
    return _near_duplicates(spark, folder, complete=False).copies()


_TIES = r"""
    held AS (
        SELECT DISTINCT id, v FROM (
            SELECT id, upper(trim(regexp_replace(unnest(list_concat(coalesce(cve_ids, []), coalesce(source_ids, []))), '[‐‑‒–—―−﹘﹣－]', '-', 'g'))) AS v FROM incidents)
        WHERE v NOT IN ('', 'N/A', 'NONE', 'UNKNOWN', 'TBD')
          AND NOT (starts_with(v, 'CVE-') AND NOT (regexp_full_match(v, 'CVE-[0-9]{4}-[0-9]{4,}') AND NOT regexp_full_match(v, 'CVE-[0-9]{4}-0+')))
    ), ties AS (
        SELECT DISTINCT a.id AS a, b.id AS b FROM held a JOIN held b ON a.v = b.v AND a.id <> b.id
    )
"""


@REGISTRY.add(
    "p7_found",
    "WITH RECURSIVE "
    + _TIES
    + """, reach(id, other) AS (
        SELECT a, b FROM ties
        UNION SELECT r.id, t.b FROM reach r JOIN ties t ON t.a = r.other
    )
    SELECT id, least(id, min(other)) AS group_id FROM reach GROUP BY id
    """,
)
def p7_found(spark, folder):
    """The group of every incident record that shares an identifier with another one, directly or not."""
    incidents = table(spark, folder, "incidents")
    return connected_components(ties_of_values(incidents, "id", identifiers("cve_ids", "source_ids")))


def _linked(spark, folder):
    incidents = entities(table(spark, folder, "incidents"), "id", "title", "date", F.col("references.url"), "received_at")
    reports = entities(table(spark, folder, "reports"), "report_id", "headline", "occurred", F.col("links"), "received_at")
    return link_entities(incidents, reports).select(F.col("left_id").alias("incident_id"), F.col("right_id").alias("report_id"), "confidence")


@REGISTRY.add("p3_found")
def p3_found(spark, folder):
    """Reports with the incident record that they tell of."""
    return _linked(spark, folder).select("incident_id", "report_id")


@REGISTRY.add("p3_confidence")
def p3_confidence(spark, folder):
    """The same pairs with their confidence."""
    return _linked(spark, folder)


@REGISTRY.add("p10_found")
def p10_found(spark, folder):
    """Documents whose text was cut inside a word or sentence."""
    return truncated_texts(table(spark, folder, "documents"), "doc_id", "text", "source").where("truncated").select(F.col("id").alias("doc_id"))


@REGISTRY.add("p10_rates")
def p10_rates(spark, folder):
    """How often each source truncates."""
    return truncation_rates(truncated_texts(table(spark, folder, "documents"), "doc_id", "text", "source"))


@REGISTRY.add(
    "p10_lengths",
    """
    WITH once AS (
        SELECT DISTINCT source, text FROM documents WHERE text <> ''
    ), sizes AS (
        SELECT source, 'characters' AS unit, length(text) AS size FROM once UNION ALL SELECT source, 'bytes', strlen(text) FROM once
    ), per AS (
        SELECT source, unit, size, count(*) AS texts, size // 40 AS bin FROM sizes GROUP BY source, unit, size
    ), near AS (
        SELECT p.source, p.unit, p.size, p.texts, (sum(o.texts) - p.texts) / 119.0 AS usual
        FROM per p JOIN per o ON o.source IS NOT DISTINCT FROM p.source AND o.unit = p.unit AND o.bin BETWEEN p.bin - 1 AND p.bin + 1
        WHERE p.texts >= 5 GROUP BY p.source, p.unit, p.size, p.texts
    )
    SELECT source, unit, size::INT AS size, texts, usual FROM near WHERE texts >= 8 * usual + 1
    """,
)
def p10_lengths(spark, folder):
    """Lengths at which a source's texts pile up, which hint at field limits."""
    return length_limits(table(spark, folder, "documents"), "text", "source")


def _packed(spark, folder):
    return pack_texts(table(spark, folder, "documents"), table(spark, folder, "pack_limits"), "doc_id", "text", "source")


@REGISTRY.add("p8_containers")
def p8_containers(spark, folder):
    """The container of each text, or piece of a long one, for each capacity."""
    return _packed(spark, folder).withColumnRenamed("id", "doc_id")


@REGISTRY.add("p8_fill")
def p8_fill(spark, folder):
    """How full the containers of each capacity are."""
    return fill_rates(_packed(spark, folder))


@REGISTRY.add("p8_apart")
def p8_apart(spark, folder):
    """The same, with texts of vendors and of the press in containers of their own."""
    apart = {"press-watch": ["vendor-psirt", "cvelist"]}
    return pack_texts(table(spark, folder, "documents"), table(spark, folder, "pack_limits"), "doc_id", "text", "source", apart).withColumnRenamed("id", "doc_id")


def _mix(spark, folder, total=None):
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"), "doc_id", "text", "source", total_tokens=total)


@REGISTRY.add("p9_draws")
def p9_draws(spark, folder):
    """Each mix's texts with their copies, in mixed order."""
    return _mix(spark, folder).draws.withColumnRenamed("id", "doc_id")


@REGISTRY.add("p9_shares")
def p9_shares(spark, folder):
    """Target and actual share of each source in each mix."""
    return _mix(spark, folder).shares


@REGISTRY.add("p9_shortfalls")
def p9_shortfalls(spark, folder):
    """The shares reached by mixes of as many tokens as all texts have: sources at their cap fall short."""
    return _mix(spark, folder, "all").shares


#: How far a record's text, rating, references and tags are trusted by the care its feed took.
_CARE = {"curated": 1.0, "reviewed": 0.7, "auto": 0.4}
_SEVERITIES = ["Critical", "High", "Medium", "Low", "Info"]


def incident_bundles() -> tuple[list[Bundle], list[Dependency]]:
    """Text, severity, score, kind, tags and references of incident records.

    Trust is half completeness, three tenths the feed's care, two tenths recency.  A score must lie in the
    band of the severity, and the attack vector that the tags name must be the record's kind.
    """
    care = F.coalesce(*(F.when(F.lower(F.trim("quality_tier")) == t, w) for t, w in _CARE.items()), F.lit(0.3))
    age = F.datediff(day_range(F.coalesce("updated", "added", "date"))["last"], F.lit("2000-01-01").cast("date"))
    recency = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(age / 20_000.0, F.lit(0.0))))
    trust = lambda full, present: F.when(present, 0.5 * F.least(F.lit(1.0), full) + 0.3 * care + 0.2 * recency)
    severity = F.initcap(F.lower(F.trim("severity")))
    score = F.when(F.col("cvss_score").between(0.1, 10), F.col("cvss_score"))
    band = F.when(score >= 9, "Critical").when(score >= 7, "High").when(score >= 4, "Medium").otherwise("Low")
    vector = F.lower(F.trim("attack_vector"))
    tags = F.array_distinct(F.filter(F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda t: F.lower(F.trim(t))), lambda t: (t != "") & t.isNotNull()))
    references = F.filter(F.coalesce("references", F.array().cast("array<struct<title:string,url:string,type:string>>")), lambda r: F.length(F.trim(r["url"])) > 0)
    none = F.lit(None).cast("string")
    bundles = [
        Bundle("text", F.struct("title", "description"), trust(F.length("description") / 2_000.0, F.col("description").rlike(NOT_BLANK)), none, 2.0),
        Bundle("severity", severity, trust(F.lit(1.0), severity.isin(_SEVERITIES)), severity),
        Bundle("score", score, trust(F.lit(1.0), score.isNotNull()), band, 0.8),
        Bundle("kind", F.struct("category", vector.alias("attack_vector")), trust(F.when(vector == "other", 0.2).otherwise(1.0), vector != ""), vector),
        Bundle("tags", tags, trust(F.size(tags) / 8.0, F.size(tags) > 0), F.when(F.array_contains(tags, vector), vector)),
        Bundle("references", references, trust(F.size(references) / 6.0, F.size(references) > 0), none),
    ]
    dependencies = [
        Dependency("severity", "score", lambda severity, band: severity == band),
        Dependency("kind", "tags", lambda vector, named: named is None or named == vector),
    ]
    return bundles, dependencies


@REGISTRY.add("p4_survivors")
def p4_survivors(spark, folder):
    """The surviving record of each group of copies and of records that share an identifier."""
    incidents = table(spark, folder, "incidents")
    copies = _near_duplicates(spark, folder, complete=False).edges().select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    groups = cut(connected_components(copies.union(ties_of_values(incidents, "id", identifiers("cve_ids", "source_ids")))), "groups")
    # Only rows of grouped ids need to move; the join below is exact.
    wanted = Reducer(groups, F.xxhash64("id"), groups.count())
    fields = ["title", "description", "severity", "cvss_score", "category", "attack_vector", "tags", "references", "quality_tier", "updated", "added", "date"]
    rows = wanted.keep(incidents.select("id", "received_at", *fields), F.xxhash64("id")).select("id", "received_at", F.struct(*fields).alias("v"))
    latest = rows.groupBy("id").agg(F.max_by("v", F.struct("received_at", "v")).alias("v")).join(groups, "id").select("id", "group_id", "v.*")
    return surviving_records(latest, "id", "group_id", *incident_bundles())
