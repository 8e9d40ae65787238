"""Scalar expressions on text.  All stay in the JVM; null in gives null out unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse_spaces(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def title_key(text: Column, length: int = 80) -> Column:
    """Lower-cased letters a-z and digits with single blanks between, cut to ``length``: equal for like titles."""
    return F.substring(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), 1, length)


def slug(text: Column, mark: str = "_") -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", mark)


def unslug(text: Column) -> Column:
    """Words of a slug with capital initials."""
    return F.initcap(F.regexp_replace(text, "[-_]+", " "))


def cut_words(text: Column, limit: int, least: float = 0.6) -> Column:
    """At most ``limit`` characters, cut at the last blank if that lies beyond ``least`` of it, with an ellipsis."""
    head = F.substring(text, 1, limit - 1)
    back = F.regexp_replace(head, r"\s+\S*\z", "")
    kept = F.when(F.length(back) > int(limit * least), back).otherwise(head)
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.rtrim(kept), F.lit("…")))


def cut_plain(text: Column, limit: int) -> Column:
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.rtrim(F.substring(text, 1, limit - 1)), F.lit("…")))


def first_sentences(text: Column, limit: int = 300) -> Column:
    """Whole sentences from the start while they fit into ``limit`` characters, at least the first."""
    parts = F.split(text, r"(?<=[.!?])\s+")
    joined = F.aggregate(
        parts,
        F.struct(F.lit("").alias("out"), F.lit(False).alias("full")),
        lambda acc, s: F.struct(
            F.when(acc["full"] | ((acc["out"] != "") & (F.length(acc["out"]) + 1 + F.length(s) > limit)), acc["out"]).when(acc["out"] == "", s).otherwise(F.concat(acc["out"], F.lit(" "), s)).alias("out"),
            (acc["full"] | ((acc["out"] != "") & (F.length(acc["out"]) + 1 + F.length(s) > limit))).alias("full"),
        ),
    )
    return joined["out"]


def one_of(text: Column, levels: list[str], default: str | None = None) -> Column:
    """The text as one of ``levels``, whatever its case and outer blanks; others give the default."""
    found = F.initcap(F.lower(F.trim(text)))
    value = F.when(found.isin(levels), found)
    return F.coalesce(value, F.lit(default)) if default is not None else value


def rank_in(text: Column, levels: list[str]) -> Column:
    """Place of a level from 0, -1 for anything else."""
    return F.coalesce(F.array_position(F.array(*(F.lit(x) for x in levels)), text) - 1, F.lit(-1)).cast("int")


def safe_url(url: Column) -> Column:
    """The URL if it is plain http(s) without blanks, quotes or angle brackets, else #."""
    return F.when(url.rlike("^(?i:https?)://[^\\s<>\"'`]+$"), url).otherwise(F.lit("#"))


def escape_xml(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def escape_table_cell(text: Column) -> Column:
    """Text for a cell of a Markdown table: bars and angle brackets escaped, line ends as blanks."""
    text = F.regexp_replace(text, r"\s+", " ")
    for raw, safe in (("|", "\\|"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def csv_cell(value: Column, is_array: bool = False) -> Column:
    """A cell's text: null as nothing, arrays joined by "; ", quoted where commas, quotes or line ends ask for it."""
    text = F.coalesce(F.array_join(value, "; ") if is_array else value.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[",\\r\\n]'), quoted).otherwise(text)


def machine_tag(namespace: str, predicate: str, value: Column) -> Column:
    return F.concat(F.lit(f'{namespace}:{predicate}="'), value, F.lit('"'))


def without_parameters(text: Column, names: str) -> Column:
    """URLs in free text without the query parameters whose names match the pattern ``names``."""
    text = F.regexp_replace(text, rf"(?i)([?&])(?:(?:{names})=[^&\s]*&)+", "$1")
    return F.regexp_replace(text, rf"(?i)[?&](?:{names})=[^&\s]*(?=\s|$)", "")


# Names of package ecosystems and their types in package URLs.
ECOSYSTEMS = {"pypi": "pypi", "pip": "pypi", "npm": "npm", "maven": "maven", "go": "golang", "golang": "golang", "cargo": "cargo", "crates.io": "cargo", "nuget": "nuget", "rubygems": "gem", "gem": "gem"}


def package_url(fragment: Column) -> Column:
    """``ecosystem/name`` as a package URL without version; null for unknown ecosystems and empty names."""
    text = F.trim(fragment)
    kind = F.try_element_at(F.create_map(*(F.lit(x) for pair in ECOSYSTEMS.items() for x in pair)), F.lower(F.substring_index(text, "/", 1)))
    name = F.regexp_replace(F.regexp_extract(text, "^[^/]+/(.+)$", 1), r"(?<=.)@[^@/]*$|\s.*$", "")
    name = F.when(kind == "maven", F.replace(name, F.lit(":"), F.lit("/"))).when(kind == "npm", F.regexp_replace(name, "^@", "%40")).otherwise(name)
    return F.when(kind.isNotNull() & (name != ""), F.concat(F.lit("pkg:"), kind, F.lit("/"), name))


def cpe_products(cpes: Column) -> Column:
    """Vendor and product of each CPE 2.3 name, as vendor/product."""
    return F.transform(F.filter(cpes, lambda c: c.startswith("cpe:")), lambda c: F.concat_ws("/", F.get(F.split(c, ":"), F.lit(3)), F.get(F.split(c, ":"), F.lit(4))))
