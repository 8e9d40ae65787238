"""URLs as they are compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track where a reader came from, by their whole name, by a beginning
# before letters, and by a beginning before anything.  A bare "ref" names a branch on some hosts and is kept.
TRACKING = [
    "utm", "fbclid", "gclid", "msclkid", "dclid", "igshid", "ref_src", "referrer", "spm", "cmpid", "icid", "yclid",
    "_ga", "_gl", "s_cid", "cmp", "iref", "edtsign", "edtcode", "scm", "web_view",
]
TRACKING_BEFORE_LETTERS = ["utm_", "mc_"]
TRACKING_BEFORE_ANYTHING = ["_com_liferay_"]


def tracks(name: Column) -> Column:
    """Whether a query parameter of that lower-cased name only tracks."""
    letters = [name.startswith(p) & F.substr(name, F.lit(len(p) + 1)).rlike("^[a-z]+$") for p in TRACKING_BEFORE_LETTERS]
    out = name.isin(TRACKING)
    for test in [*letters, *(name.startswith(p) for p in TRACKING_BEFORE_ANYTHING)]:
        out = out | test
    return out


def normalize_url(url: Column, keep_value_case: bool = True) -> Column:
    """Without http scheme, www after it, fragment and trailing slashes; host, path and parameter names in lower
    case; parameters sorted by name and value, those that only track dropped.  Null and what leaves nothing
    give null."""
    text = F.substring_index(F.regexp_replace(F.trim(url), r"(?i)^https?://(?:www\.)?", ""), "#", 1)
    path = F.rtrim(F.lower(F.substring_index(text, "?", 1)), F.lit("/"))
    raw = F.when(F.contains(text, F.lit("?")), F.substr(text, F.instr(text, "?") + 1)).otherwise("")
    name = lambda p: F.lower(F.substring_index(p, "=", 1))
    value = lambda p: F.when(F.contains(p, F.lit("=")), F.substr(p, F.instr(p, "=") + 1)).otherwise("")
    pairs = F.transform(F.filter(F.split(raw, "&"), lambda p: p != ""), lambda p: F.struct(name(p).alias("name"), value(p).alias("value")))
    kept = F.array_sort(F.filter(pairs, lambda p: ~tracks(p["name"])))
    query = F.array_join(F.transform(kept, lambda p: F.when(p["value"] != "", F.concat(p["name"], F.lit("="), p["value"])).otherwise(p["name"])), "&")
    if not keep_value_case:
        query = F.lower(query)
    return F.nullif(F.when(query != "", F.concat(path, F.lit("?"), query)).otherwise(path), F.lit(""))
