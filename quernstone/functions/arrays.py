"""Expressions on arrays.  Null arrays count as empty; absent elements are dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def strings(array: Column) -> Column:
    return F.array_compact(F.coalesce(array, F.array().cast("array<string>")))


def sorted_union(*arrays: Column) -> Column:
    return F.array_sort(F.array_distinct(F.concat(*(strings(a) for a in arrays))))


def without(array: Column, dropped: Column) -> Column:
    """Elements not in ``dropped``, in order, each once."""
    return F.array_except(strings(array), strings(dropped))


def overlap(a: Column, b: Column) -> Column:
    """Whether two arrays share an element; never null."""
    return F.coalesce(F.arrays_overlap(strings(a), strings(b)), F.lit(False))


def disjoint(a: Column, b: Column) -> Column:
    """Whether both arrays have elements and share none."""
    return (F.size(strings(a)) > 0) & (F.size(strings(b)) > 0) & ~overlap(a, b)


def within(a: Column, b: Column) -> Column:
    """Whether ``a`` has elements and all of them are in ``b``."""
    return (F.size(strings(a)) > 0) & (F.size(without(a, b)) == 0)


def first_of_each(array: Column, key: Callable[[Column], Column]) -> Column:
    """The elements with a new key, in order: the first of each key stays."""
    keys = F.transform(array, key)
    return F.filter(array, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def looked_up(array: Column, mapping: Column) -> Column:
    """The mapping's values for the elements that it has, each once, in order."""
    return F.array_distinct(F.array_compact(F.transform(strings(array), lambda x: F.try_element_at(mapping, x))))


def looked_up_all(array: Column, mapping: Column) -> Column:
    """As looked_up where the mapping's values are arrays themselves."""
    found = F.transform(strings(array), lambda x: F.coalesce(F.try_element_at(mapping, x), F.array().cast("array<string>")))
    return F.array_distinct(F.flatten(found))


def unanimous(array: Column) -> Column:
    """The only distinct element, null if there are several or none."""
    once = F.array_distinct(strings(array))
    return F.when(F.size(once) == 1, F.get(once, F.lit(0)))


def by_number(array: Column) -> Column:
    """Codes such as X-9 and X-10 in order of their last number."""
    number = lambda x: F.coalesce(F.regexp_extract(x, "([0-9]+)[^0-9]*$", 1).try_cast("bigint"), F.lit(-1))
    return F.transform(F.array_sort(F.transform(F.array_distinct(strings(array)), lambda x: F.struct(number(x).alias("n"), x.alias("x")))), lambda s: s["x"])


def renamed(array: Column, mapping: dict[str, str], strict: bool = False) -> Column:
    """Elements renamed by the mapping; others stay, or raise an error if ``strict``."""
    pairs = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    missing = (lambda x: F.raise_error(F.concat(F.lit("no new name for "), x)).cast("string")) if strict else (lambda x: x)
    return F.transform(strings(array), lambda x: F.coalesce(F.try_element_at(pairs, x), missing(x)))
