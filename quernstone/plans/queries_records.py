"""Queries of the record operators over the incident tables: filters, text, rules, arrays, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from quernstone.functions import arrays, dates, rules, text, urls
from quernstone.operators.latest import latest_by
from quernstone.operators.search import SEVERITIES, QuerySpec, by_id, by_identifier, stands
from quernstone.plans.registry import Registry, table

REGISTRY = Registry()

#: One row per id: the last received; repetitions have equal content.
INC = "inc AS (SELECT * FROM incidents QUALIFY row_number() OVER (PARTITION BY id ORDER BY received_at DESC) = 1)"
_SEV = "CASE WHEN lower(trim(severity)) IN ('info', 'low', 'medium', 'high', 'critical') THEN upper(left(trim(severity), 1)) || lower(substr(trim(severity), 2)) END"
_STANDS = "coalesce(lower(trim(status)) NOT IN ('retracted', 'unverified'), true)"


def incidents(spark, folder, *columns):
    """One row per id, of the given columns; only these and the time of receipt are read."""
    rows = table(spark, folder, "incidents").select(*columns, "received_at")
    return latest_by(rows, ["id"], "received_at").select(*columns)


@REGISTRY.add("standing_records", f"WITH {INC} SELECT id, status FROM inc WHERE {_STANDS}")
def standing_records(spark, folder):
    """Records that count; no status counts."""
    return incidents(spark, folder, "id", "status").where(stands()).select("id", "status")


@REGISTRY.add("filter_typed", f"WITH {INC} SELECT id, year, severity FROM inc WHERE year = 2025 AND severity = 'High' AND list_contains(tags, 'agentic') AND len(coalesce(cve_ids, [])) > 0")
def filter_typed(spark, folder):
    """Equality on scalars, membership in arrays, presence."""
    spec = QuerySpec(filters={"year": 2025, "severity": "High", "tags": "agentic"}, has=["cve_ids"])
    return spec.rows(incidents(spark, folder, "id", "year", "severity", "cve_ids", "tags")).select("id", "year", "severity")


@REGISTRY.add("filter_text", f"WITH {INC} SELECT id, title FROM inc WHERE contains(lower(concat_ws(' ', id, title, array_to_string(cve_ids, ' '))), 'path traversal') AND {_STANDS}")
def filter_text(spark, folder):
    """Text search over id, title and identifiers of standing records."""
    return QuerySpec(text=" Path Traversal ", standing_only=True).rows(incidents(spark, folder, "id", "title", "cve_ids", "status")).select("id", "title")


@REGISTRY.add("filter_wide_text", f"WITH {INC} SELECT id FROM inc WHERE contains(lower(concat_ws(' ', id, title, attack_vector, affected, array_to_string(cwe_ids, ' '))), 'cwe-22')")
def filter_wide_text(spark, folder):
    """Text search over a wider set of fields."""
    return QuerySpec(text="CWE-22", text_columns=("id", "title", "attack_vector", "affected", "cwe_ids")).rows(incidents(spark, folder, "id", "title", "attack_vector", "affected", "cwe_ids")).select("id")


@REGISTRY.add("filter_lacking", f"WITH {INC} SELECT id, severity FROM inc WHERE severity = 'High' AND len(coalesce(cve_ids, [])) = 0")
def filter_lacking(spark, folder):
    """Records of a severity that hold no identifier."""
    return QuerySpec(filters={"severity": "High", "year": None}, lacks=["cve_ids"]).rows(incidents(spark, folder, "id", "year", "severity", "cve_ids")).select("id", "severity")


@REGISTRY.add("filter_reference", f"WITH {INC} SELECT id, title FROM inc WHERE contains(lower(concat_ws(' ', id, title, array_to_string(cve_ids, ' '), \"references\"[1].url)), 'harrow.example/item')")
def filter_reference(spark, folder):
    """Text search that reaches the primary reference."""
    return QuerySpec(text=" Harrow.example/ITEM ").rows(incidents(spark, folder, "id", "title", "cve_ids", "references")).select("id", "title")


@REGISTRY.add("record_by_id", f"WITH {INC} SELECT id, title, status FROM inc WHERE id = 'INC-00000042'")
def record_by_id(spark, folder):
    """One record, retracted or not, by its id."""
    return by_id(incidents(spark, folder, "id", "title", "status"), "INC-00000042")


@REGISTRY.add("by_identifier", f"WITH {INC} SELECT id, cve_ids FROM inc WHERE list_contains(cve_ids, 'CVE-2024-10000336')")
def identifier_lookup(spark, folder):
    """Records that hold an identifier; the argument's case and blanks don't matter."""
    return by_identifier(incidents(spark, folder, "id", "cve_ids"), "cve_ids", " cve-2024-10000336 ").select("id", "cve_ids")


_NEWEST = "coalesce(try_cast(split_part(date, '-', 1) AS INT), 0) DESC, coalesce(try_cast(split_part(date, '-', 2) AS INT), 0) DESC, coalesce(try_cast(split_part(date, '-', 3) AS INT), 0) DESC, lower(title) ASC NULLS FIRST, id ASC"


@REGISTRY.add("newest_page", f"WITH {INC} SELECT id, date, title FROM inc WHERE {_STANDS} ORDER BY {_NEWEST} LIMIT 100 OFFSET 100")
def newest_page(spark, folder):
    """The second page of a hundred, newest first, rough dates last in their period."""
    return QuerySpec(standing_only=True, page=2, size=100).paged(incidents(spark, folder, "id", "title", "date", "year", "severity", "status")).select("id", "date", "title")


@REGISTRY.add("severity_page", f"WITH {INC} SELECT id, severity FROM inc ORDER BY CASE severity WHEN 'Info' THEN 0 WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 WHEN 'Critical' THEN 4 ELSE -1 END DESC, id LIMIT 50")
def severity_page(spark, folder):
    """The first page by severity, unknown ones last."""
    return QuerySpec(sort="severity", size=50).paged(incidents(spark, folder, "id", "title", "date", "year", "severity")).select("id", "severity")


@REGISTRY.add("padded_page", f"WITH {INC} SELECT id, date FROM inc ORDER BY rpad(coalesce(date, year::VARCHAR, ''), 10, '0') DESC, id LIMIT 250")
def padded_page(spark, folder):
    """The first page by zero-padded date text."""
    return QuerySpec(sort="padded").paged(incidents(spark, folder, "id", "title", "date", "year", "severity")).select("id", "date")


@REGISTRY.add(
    "slim_view",
    f"WITH {INC} SELECT id, CASE WHEN length(description) <= 280 THEN description ELSE rtrim(CASE WHEN length(regexp_replace(substr(description, 1, 279), '\\s+\\S*$', '')) > 168 THEN regexp_replace(substr(description, 1, 279), '\\s+\\S*$', '') ELSE substr(description, 1, 279) END, ' ') || '…' END AS description, \"references\"[1].url AS primary_reference, array_to_string(tags[1:8], ' ') AS tags FROM inc",
)
def slim_view(spark, folder):
    """The slim form: short description, first reference, first eight tags."""
    return incidents(spark, folder, "id", "description", "references", "tags").select("id", text.cut_words(F.col("description"), 280).alias("description"), F.get("references", F.lit(0))["url"].alias("primary_reference"), F.array_join(F.slice("tags", 1, 8), " ").alias("tags"))


@REGISTRY.add("title_keys", f"WITH {INC} SELECT id, substr(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')), 1, 80) AS title_key, regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g') AS slug, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS clean FROM inc")
def title_keys(spark, folder):
    """Keys by which like titles meet."""
    t = F.col("title")
    return incidents(spark, folder, "id", "title").select("id", text.title_key(t).alias("title_key"), text.slug(t).alias("slug"), text.collapse_spaces(t).alias("clean"))


@REGISTRY.add(
    "normalized_urls",
    f"""WITH {INC}, u AS (SELECT DISTINCT id, unnest("references").url AS url FROM inc), s AS (
        SELECT id, url, split_part(regexp_replace(trim(url), '^[hH][tT][tT][pP][sS]?://([wW][wW][wW][.])?', ''), '#', 1) AS t FROM u WHERE url IS NOT NULL
    ), p AS (
        SELECT id, url, rtrim(lower(split_part(t, '?', 1)), '/') AS path, unnest(CASE WHEN contains(t, '?') THEN string_split(substr(t, strpos(t, '?') + 1), '&') ELSE [''] END) AS pair FROM s
    ), n AS (
        SELECT id, url, path, lower(split_part(pair, '=', 1)) AS k, CASE WHEN contains(pair, '=') THEN substr(pair, strpos(pair, '=') + 1) ELSE '' END AS v,
               pair <> '' AND NOT regexp_full_match(lower(split_part(pair, '=', 1)), 'utm(_[a-z]+)?|(fb|g|d|y|mscl?k)c?l?k?id|mc_[a-z]+|igshid|ref_src|referrer|spm|cmp(id)?|icid|_g[al]|s_cid|iref|edt(sign|code)|scm|web_view|_com_liferay_.*') AS keep FROM p
    )
    SELECT id, url, nullif(path || coalesce('?' || string_agg(CASE WHEN v <> '' THEN k || '=' || v ELSE k END, '&' ORDER BY k, v) FILTER (keep), ''), '') AS normalized FROM n GROUP BY id, url, path""",
)
def normalized_urls(spark, folder):
    """References as they are compared."""
    each = incidents(spark, folder, "id", "references").select("id", F.explode("references.url").alias("url")).where("url IS NOT NULL").distinct()
    return each.withColumn("normalized", urls.normalize_url(F.col("url")))


@REGISTRY.add("severity_levels", f"WITH {INC} SELECT id, coalesce({_SEV}, 'Medium') AS severity, CASE coalesce({_SEV}, 'Medium') WHEN 'Info' THEN 0 WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 ELSE 4 END AS rank FROM inc")
def severity_levels(spark, folder):
    """Severities in one spelling, unknown ones as Medium, with their rank."""
    level = text.one_of(F.col("severity"), SEVERITIES, "Medium")
    return incidents(spark, folder, "id", "severity").select("id", level.alias("severity"), text.rank_in(level, SEVERITIES).alias("rank"))


#: An example rule table; rules are parameters of the operator.
RULES = [("(?i)prompt injection|jailbreak", "prompt-injection"), ("(?i)sql injection", "sql-injection"), ("(?i)path traversal|outside the extraction folder", "path-traversal"), ("(?i)deserialization|run commands", "rce"), ("(?i)request forgery", "ssrf"), ("(?i)denial|exhaust|resource consumption", "dos"), ("(?i)misjudged|wrong", "algorithmic-bias")]
_CASE = "CASE " + " ".join(f"WHEN regexp_matches(coalesce(title, ''), '{p}') THEN '{v}'" for p, v in RULES) + " ELSE 'other' END"
_ALL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(coalesce(title, ''), '{p}') THEN '{v}' END" for p, v in RULES) + "], lambda x: x IS NOT NULL)"


@REGISTRY.add("first_rule", f"WITH {INC} SELECT id, {_CASE} AS vector FROM inc")
def first_rule(spark, folder):
    """Classification by an ordered rule table."""
    return incidents(spark, folder, "id", "title").select("id", rules.first_match(F.col("title"), RULES, "other").alias("vector"))


@REGISTRY.add("all_rules", f"WITH {INC} SELECT id, array_to_string({_ALL}, ',') AS vectors FROM inc")
def all_rules(spark, folder):
    """All rules that match."""
    return incidents(spark, folder, "id", "title").select("id", F.array_join(rules.all_matches(F.col("title"), RULES), ",").alias("vectors"))


@REGISTRY.add("second_chance", f"WITH {INC} SELECT id, CASE WHEN coalesce(nullif(attack_vector, ''), 'other') = 'other' THEN {_CASE} ELSE attack_vector END AS vector FROM inc")
def second_chance(spark, folder):
    """The stated class, or the rules' where it is missing or other."""
    stated = F.coalesce(F.nullif(F.col("attack_vector"), F.lit("")), F.lit("other"))
    return incidents(spark, folder, "id", "title", "attack_vector").select("id", F.when(stated == "other", rules.first_match(F.col("title"), RULES, "other")).otherwise(F.col("attack_vector")).alias("vector"))


_WORDS = ["agent", "chat", "model", "prompt", "tokenizer", "embedding"]
_FOUND = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(coalesce(description, '')), '(^|[^a-z0-9]){w}([^a-z0-9]|$)') THEN '{w}' END" for w in _WORDS) + "], lambda x: x IS NOT NULL)"


@REGISTRY.add("two_signal_gate", f"WITH {INC} SELECT id, array_to_string({_FOUND}, ' ') AS words FROM inc WHERE len({_FOUND}) >= 2 OR (len({_FOUND}) >= 1 AND regexp_matches(lower(coalesce(description, '')), 'training|weights'))")
def two_signal_gate(spark, folder):
    """Records with a word of a list and a second signal, with the words as evidence."""
    d = F.col("description")
    return incidents(spark, folder, "id", "description").where(rules.two_signals(d, _WORDS, "training|weights")).select("id", F.array_join(rules.matched_words(d, _WORDS), " ").alias("words"))


@REGISTRY.add("fragment_gate", "SELECT package, vendor FROM products WHERE contains('-' || regexp_replace(lower(product), '[^a-z0-9]+', '-', 'g') || '-', '-agent-') OR contains('-' || regexp_replace(lower(product), '[^a-z0-9]+', '-', 'g') || '-', '-pavirra-flow-')")
def fragment_gate(spark, folder):
    """Products whose name holds a run of whole segments."""
    return table(spark, folder, "products").where(rules.has_fragment(F.col("product"), ["agent", "pavirra-flow"])).select("package", "vendor")


@REGISTRY.add("sorted_codes", f"WITH {INC} SELECT id, array_to_string(list_sort(list_distinct(list_filter(list_concat(coalesce(cve_ids, []), coalesce(cwe_ids, []), coalesce(source_ids, [])), lambda x: x IS NOT NULL))), '|') AS codes FROM inc")
def sorted_codes(spark, folder):
    """Sorted unions of code lists; null lists count as empty."""
    return incidents(spark, folder, "id", "source_ids", "cve_ids", "cwe_ids").select("id", F.array_join(arrays.sorted_union(F.col("cve_ids"), F.col("cwe_ids"), F.col("source_ids")), "|").alias("codes"))


@REGISTRY.add("numbered_codes", f"WITH {INC} SELECT id, array_to_string(list_transform(list_sort(list_transform(list_distinct(list_filter(coalesce(cwe_ids, []), lambda x: x IS NOT NULL)), lambda x: {{'n': coalesce(try_cast(regexp_extract(x, '([0-9]+)[^0-9]*$', 1) AS BIGINT), -1), 'x': x}})), lambda s: s.x), ',') AS codes FROM inc")
def numbered_codes(spark, folder):
    """Codes in the order of their numbers."""
    return incidents(spark, folder, "id", "cwe_ids").select("id", F.array_join(arrays.by_number(F.col("cwe_ids")), ",").alias("codes"))


_MAP = {"CWE-22": "path-traversal", "CWE-79": "xss", "CWE-89": "sql-injection", "CWE-918": "ssrf", "CWE-502": "rce", "CWE-78": "rce", "CWE-94": "rce", "CWE-862": "auth-bypass", "CWE-200": "data-exfiltration"}
_SQL_MAP = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in _MAP.items()) + "}"


@REGISTRY.add("unanimous_class", f"WITH {INC}, m AS (SELECT id, list_distinct(list_filter(list_transform(list_filter(coalesce(cwe_ids, []), lambda x: x IS NOT NULL), lambda x: {_SQL_MAP}[x]), lambda x: x IS NOT NULL)) AS v FROM inc) SELECT id, CASE WHEN len(v) = 1 THEN v[1] END AS class FROM m")
def unanimous_class(spark, folder):
    """The class on which all mappable codes agree."""
    mapping = F.create_map(*(F.lit(x) for pair in _MAP.items() for x in pair))
    return incidents(spark, folder, "id", "cwe_ids").select("id", arrays.unanimous(arrays.looked_up(F.col("cwe_ids"), mapping)).alias("class"))


@REGISTRY.add("renamed_tags", f"WITH {INC} SELECT id, array_to_string(list_transform(list_filter(coalesce(tags, []), lambda x: x IS NOT NULL), lambda x: CASE x WHEN 'xss' THEN 'cross-site-scripting' WHEN 'dos' THEN 'denial-of-service' ELSE x END), ',') AS tags FROM inc")
def renamed_tags(spark, folder):
    """Codes renamed inside arrays."""
    return incidents(spark, folder, "id", "tags").select("id", F.array_join(arrays.renamed(F.col("tags"), {"xss": "cross-site-scripting", "dos": "denial-of-service"}), ",").alias("tags"))


@REGISTRY.add(
    "date_precision",
    f"""WITH {INC} SELECT id, CASE WHEN regexp_full_match(date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 3 WHEN regexp_full_match(date, '[0-9]{{4}}-[0-9]{{2}}') THEN 2 WHEN regexp_full_match(date, '[0-9]{{4}}') THEN 1 ELSE 0 END AS digits,
    coalesce(strftime(try_cast(date AS DATE), '%Y-%m-%d') = date, false) AS real_day,
    CASE length(date) WHEN 10 THEN date WHEN 7 THEN date || '-01' WHEN 4 THEN date || '-01-01' END || 'T00:00:00.000Z' AS instant FROM inc""",
)
def date_precision(spark, folder):
    """How precise dates are, whether they are real days, and the first instant they may mean."""
    d = F.col("date")
    return incidents(spark, folder, "id", "date").select("id", dates.precision(d).alias("digits"), dates.is_iso_day(d).alias("real_day"), dates.padded(d).alias("instant"))


@REGISTRY.add("affected_packages", "SELECT package, 'pkg:' || CASE ecosystem WHEN 'golang' THEN 'golang' ELSE ecosystem END || '/' || lower(replace(product, ' ', '-')) AS built FROM products WHERE ecosystem IN ('pypi', 'npm', 'maven', 'golang', 'cargo')")
def affected_packages(spark, folder):
    """Package URLs built from ecosystem and name."""
    fragment = F.concat_ws("/", F.col("ecosystem"), F.lower(F.replace(F.col("product"), F.lit(" "), F.lit("-"))))
    built = text.package_url(fragment)
    return table(spark, folder, "products").select("package", built.alias("built")).where("built IS NOT NULL")


@REGISTRY.add("text_heads", "SELECT doc_id, regexp_replace(substr(text, 1, 400), '\\s+', ' ', 'g') AS head, length(text) - length(replace(text, '{', '')) AS braces FROM documents")
def text_heads(spark, folder):
    """Heads of texts in one line, and how often a suspicious mark stands in them."""
    return table(spark, folder, "documents").select("doc_id", F.regexp_replace(F.substring("text", 1, 400), r"\s+", " ").alias("head"), F.regexp_count("text", F.lit(r"\{")).cast("bigint").alias("braces"))


@REGISTRY.add(
    "first_sentences",
    r"""WITH p AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(2), 'g'), chr(2)) AS parts FROM documents WHERE text IS NOT NULL),
    u AS (SELECT doc_id, unnest(parts) AS s, unnest(range(len(parts))) AS k FROM p), c AS (SELECT *, sum(length(s) + 1) OVER (PARTITION BY doc_id ORDER BY k) - 1 AS total FROM u)
    SELECT d.doc_id, f.lead FROM documents d LEFT JOIN (SELECT doc_id, string_agg(s, ' ' ORDER BY k) AS lead FROM c WHERE k = 0 OR total <= 300 GROUP BY doc_id) f USING (doc_id)""",
)
def first_sentences(spark, folder):
    """Whole sentences from the start of each text, up to 300 characters."""
    return table(spark, folder, "documents").select("doc_id", text.first_sentences(F.col("text")).alias("lead"))


@REGISTRY.add("csv_cells", f"""WITH {INC} SELECT id, CASE WHEN regexp_matches(coalesce(affected, ''), '[",\\r\\n]') THEN '"' || replace(coalesce(affected, ''), '"', '""') || '"' ELSE coalesce(affected, '') END AS affected, coalesce(array_to_string(tags, '; '), '') AS tags FROM inc""")
def csv_cells(spark, folder):
    """Cells of a CSV export, quoted where needed."""
    return incidents(spark, folder, "id", "affected", "tags").select("id", text.csv_cell(F.col("affected")).alias("affected"), text.csv_cell(F.col("tags"), True).alias("tags"))
