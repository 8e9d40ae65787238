"""Ordered rule tables compiled to expressions.

Rules are data: pairs of a pattern and a value, in order of precedence.  A table of any size becomes one
CASE or one array expression, so classification stays inside code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = list[tuple[str, str]]


def first_match(text: Column, rules: Rules, default: str | None = None) -> Column:
    """The value of the first rule whose pattern is found; null text counts as empty."""
    if not rules:
        return F.lit(default).cast("string")
    text = F.coalesce(text, F.lit(""))
    case = F.when(text.rlike(rules[0][0]), rules[0][1])
    for pattern, value in rules[1:]:
        case = case.when(text.rlike(pattern), value)
    return case.otherwise(F.lit(default))


def all_matches(text: Column, rules: Rules) -> Column:
    """The values of all rules that are found, each once, in rule order."""
    text = F.coalesce(text, F.lit(""))
    return F.array_distinct(F.array_compact(F.array(*(F.when(text.rlike(p), v) for p, v in rules))))


def matched_words(text: Column, words: list[str]) -> Column:
    """Which of the words occur as whole words, in the list's order; case is ignored."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(*(F.when(low.rlike(rf"(^|[^a-z0-9]){w}([^a-z0-9]|$)"), F.lit(w)) for w in words)))


def two_signals(text: Column, words: list[str], second: str) -> Column:
    """Whether a word occurs and a second signal backs it: another word, or the pattern ``second``."""
    found = F.size(matched_words(text, words))
    return (found >= 2) | ((found >= 1) & F.lower(F.coalesce(text, F.lit(""))).rlike(second))


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(c, F.lit(False)) for c in conditions))


def has_fragment(text: Column, fragments: list[str]) -> Column:
    """Whether a run of whole segments of the text (cut at anything but letters and digits) equals a fragment."""
    segments = F.concat(F.lit("-"), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "-"), F.lit("-"))
    return any_of(*(F.contains(segments, F.lit(f"-{f}-")) for f in fragments))
