"""Identifiers as they are compared: one case, one kind of dash, without stand-ins for missing ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds of dash, and values that name nothing.
DASHES = "[‐‑‒–—―−﹘﹣－]"
NO_NAMES = ["", "N/A", "NONE", "UNKNOWN", "TBD"]
CVE = "^CVE-[0-9]{4}-[0-9]{4,}$"
#: A well-formed CVE id, whose number has nine digits at most; ``CVE`` only tells what names something.
CVE_ID = "^CVE-[0-9]{4}-[0-9]{4,9}$"
ZEROS = "^CVE-[0-9]{4}-0+$"


def identifier(value: Column) -> Column:
    """The value trimmed, in upper case and with plain dashes; null if it names nothing."""
    text = F.upper(F.regexp_replace(F.regexp_replace(value, DASHES, "-"), r"(?U)^\s+|\s+$", ""))
    nothing = text.isin(NO_NAMES) | (text.startswith("CVE-") & ~(text.rlike(CVE) & ~text.rlike(ZEROS)))
    return F.when(~nothing, text)


def cve_ids(column: str) -> Column:
    """The well-formed CVE ids of an array column, trimmed and in upper case, each once; null counts as empty."""
    each = F.transform(F.coalesce(F.col(column), F.array().cast("array<string>")), lambda c: F.upper(F.trim(c)))
    return F.array_distinct(F.filter(each, lambda c: c.rlike(CVE_ID)))


def identifiers(*lists: str) -> Column:
    """All identifiers that name something in the given array columns; null arrays count as empty."""
    empty = F.array().cast("array<string>")
    every = F.concat(*(F.coalesce(F.col(c), empty) for c in lists))
    return F.array_distinct(F.filter(F.transform(every, identifier), lambda x: x.isNotNull()))
