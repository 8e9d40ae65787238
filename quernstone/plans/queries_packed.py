from __future__ import annotations

from quernstone.operators.packed_fields import explode_packed
from quernstone.plans.registry import Registry, table

REGISTRY = Registry()

#: Tokens of a field in the order in which they are tried: text in quotes or brackets, line-break tags, single
#: separators, blanks, words, anything else.  Words hold no blank, separator, quote or bracket; apostrophes and
#: escaped marks may stand inside them.
_SEPARATE = r",;|\[\]{}!?\n\r\t\v\f\x{0085}\x{2028}\x{2029}、；，｜。！？·…"
_BLANK = r" \x{00a0}\x{2000}-\x{200a}\x{202f}\x{3000}"
_TOKENS = "|".join(
    [
        r'"(?:[^"\\]|\\.|"")*"', "“[^“”]*”", "‘[^‘’]*’", "«[^«»]*»", "„[^„‟]*‟", "''[^'']*''", r"\((?:[^()]|\([^()]*\))*\)", "（[^（）]*）",
        r"<[bB][rR] ?/?>", f"[{_SEPARATE}]", f"[{_BLANK}]+", rf"""(?:\\.|[^{_SEPARATE}{_BLANK}"“‘«„\\(（<''])(?:\\.|[^{_SEPARATE}{_BLANK}"“«„\\(（<])*""", ".",
    ]
)
_SQL = rf"""
    WITH latest AS (
        SELECT id, affected FROM incidents WHERE id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY received_at DESC NULLS LAST, affected DESC NULLS LAST) = 1
    ), lexed AS (
        SELECT id, unnest(tokens) AS t, unnest(range(len(tokens))) AS n FROM (SELECT id, regexp_extract_all(affected, '{_TOKENS}', 0, 's') AS tokens FROM latest WHERE affected IS NOT NULL)
    ), marked AS (
        SELECT *, regexp_full_match(t, '[{_SEPARATE}]|(?i:and)|/|(?i:<br ?/?>)', 's') AS separates FROM lexed
    ), placed AS (
        SELECT *, sum(separates::INT) OVER (PARTITION BY id ORDER BY n) AS part FROM marked
    ), joined AS (
        SELECT id, part, trim(string_agg(t, '' ORDER BY n), ' ' || chr(160) || chr(12288)) AS v FROM placed WHERE NOT separates GROUP BY id, part
    ), bare AS (
        SELECT id, part, regexp_replace(regexp_replace(v, '^(?:[-*+](?: +|$)|[•‣◦–—▪] *)', ''), '^(?:[-*+](?: +|$)|[•‣◦–—▪] *)', '') AS v FROM joined
    ), plain AS (
        SELECT id, part, CASE
            WHEN regexp_full_match(v, '"(?:[^"\\]|""|\\.)*"', 's') THEN trim(regexp_replace(replace(v[2:-2], '""', '"'), '\\(.)', '\1', 'g'))
            WHEN regexp_full_match(v, '“[^“”]*”|‘[^‘’]*’|«[^«»]*»|„[^„‟]*‟|''.*''', 's') AND length(v) > 1 THEN trim(v[2:-2])
            ELSE v END AS item FROM bare
    ), found AS (
        SELECT id, (row_number() OVER (PARTITION BY id ORDER BY part))::INT AS pos, item, (count(*) OVER (PARTITION BY id))::INT AS items FROM plain WHERE item <> ''
    )
"""


@REGISTRY.add("p2_found", _SQL + "SELECT id, pos, item FROM found WHERE items >= 2")
def p2_found(spark, folder):
    """Each value of an ``affected`` field that packs two or more."""
    return explode_packed(table(spark, folder, "incidents"), "id", "affected", "received_at").where("items >= 2").select("id", "pos", "item")


@REGISTRY.add("p2_all_values", _SQL + "SELECT id, pos, item, items FROM found")
def p2_all_values(spark, folder):
    """Each value of every ``affected`` field, with the number of values beside it."""
    return explode_packed(table(spark, folder, "incidents"), "id", "affected", "received_at")
