"""Rough and variously written dates as ranges of days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names, by their first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_NAME = "([a-z]{3})[a-z]*\\.?"


def _month(name: Column) -> Column:
    return F.array_position(F.array(*(F.lit(m) for m in MONTHS)), name).cast("int")


def day_range(text: Column) -> Column:
    """struct(first, last) of days that a date may mean; null where none can be read.

    Read are ISO dates with dashes, slashes, dots or none, day.month.year, "2 May 2024", "May 2, 2024",
    "May 2024", year and month, and a year alone; a time of day is ignored.
    """
    t = F.lower(F.trim(text))
    plain = t.try_cast("date")
    # Plain ISO dates, by far the most, need no search through the other notations.
    end = F.when(F.length(t) == 10, plain).when(F.length(t) == 7, F.last_day(plain)).otherwise(F.last_day(F.add_months(plain, 11)))
    fast = F.when(plain.isNotNull(), F.struct(plain.alias("first"), end.alias("last")))
    return F.when(t.rlike("^[12][0-9]{3}(?:-[01][0-9](?:-[0-3][0-9])?)?$"), fast).otherwise(_any_day_range(t))


def _any_day_range(t: Column) -> Column:
    part = lambda pattern, group: F.regexp_extract(t, pattern, group)
    number = lambda pattern, group: part(pattern, group).try_cast("int")
    iso = r"^([12][0-9]{3})[-/.]([01]?[0-9])[-/.]([0-3]?[0-9])(?![0-9])"
    packed = r"^([12][0-9]{3})([01][0-9])([0-3][0-9])(?![0-9])"
    european = r"^([0-3]?[0-9])[./]([01]?[0-9])[./]([12][0-9]{3})(?![0-9])"
    day_first = rf"^([0-3]?[0-9])(?:st|nd|rd|th)?\s+{_NAME},?\s+([12][0-9]{{3}})(?![0-9])"
    month_first = rf"^{_NAME}\s+([0-3]?[0-9])(?:st|nd|rd|th)?,?\s+([12][0-9]{{3}})(?![0-9])"
    month_only = rf"^{_NAME},?\s+([12][0-9]{{3}})$"
    iso_month = r"^([12][0-9]{3})[-/.]([01]?[0-9])$"
    year = r"^([12][0-9]{3})$"
    y = F.coalesce(number(iso, 1), number(packed, 1), number(european, 3), number(day_first, 3), number(month_first, 3), number(month_only, 2), number(iso_month, 1), number(year, 1))
    m = F.coalesce(number(iso, 2), number(packed, 2), number(european, 2), _month_or_null(part(day_first, 2)), _month_or_null(part(month_first, 1)), _month_or_null(part(month_only, 1)), number(iso_month, 2))
    d = F.coalesce(number(iso, 3), number(packed, 3), number(european, 1), number(day_first, 1), number(month_first, 2))
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    first = F.concat_ws("-", pad(y, 4), pad(F.coalesce(m, F.lit(1)), 2), pad(F.coalesce(d, F.lit(1)), 2)).try_cast("date")
    last = F.when(d.isNotNull(), first).when(m.isNotNull(), F.last_day(first)).otherwise(F.last_day(F.add_months(first, 11)))
    return F.when(y.isNotNull() & first.isNotNull(), F.struct(first.alias("first"), last.alias("last")))


def _month_or_null(name: Column) -> Column:
    found = _month(name)
    return F.when(found > 0, found)


def days_apart(a: Column, b: Column) -> Column:
    """Days between two ranges; 0 if they overlap, null if one is unknown."""
    return F.greatest(F.lit(0), F.datediff(a["first"], b["last"]), F.datediff(b["first"], a["last"]))


def precision(text: Column) -> Column:
    """3 for a day, 2 for a month, 1 for a year in ISO form, 0 for anything else."""
    t = F.coalesce(F.trim(text), F.lit(""))
    return F.when(t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), 3).when(t.rlike("^[0-9]{4}-[0-9]{2}$"), 2).when(t.rlike("^[0-9]{4}$"), 1).otherwise(0)


def is_iso_day(text: Column) -> Column:
    """Whether the text is a real day in ISO form."""
    return F.coalesce(F.date_format(text.try_cast("date"), "yyyy-MM-dd") == text, F.lit(False))


def padded(text: Column, time: str = "T00:00:00.000Z") -> Column:
    """A rough ISO date as the first instant it may mean; null where the date can't be read."""
    p = precision(text)
    t = F.trim(text)
    return F.when(p == 3, F.concat(t, F.lit(time))).when(p == 2, F.concat(t, F.lit(f"-01{time}"))).when(p == 1, F.concat(t, F.lit(f"-01-01{time}")))


def newest_first(text: Column) -> list[Column]:
    """Sort keys: later periods first, and within a period its rougher dates after its days."""
    parts = F.split(F.coalesce(text, F.lit("")), "-")
    number = lambda i: F.coalesce(F.get(parts, F.lit(i)).try_cast("int"), F.lit(0))
    return [number(0).desc(), number(1).desc(), number(2).desc()]


def better_date(old: Column, new: Column, as_of_year: int) -> Column:
    """The date to keep of two: a future one gives way, then the more precise one wins, else the old."""
    future = lambda c: F.coalesce(F.substring(c, 1, 4).try_cast("int"), F.lit(0)) > as_of_year
    take = (future(old) & ~future(new) & (precision(new) > 0)) | (~future(new) & (precision(new) > precision(old)))
    return F.when(old.isNull() | take, F.coalesce(new, old)).otherwise(old)


def first_year(text: Column) -> Column:
    """The first year from 1900 to 2099 in a text."""
    return F.regexp_extract(text, "(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1).try_cast("int")
