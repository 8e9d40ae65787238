"""The record query interface: typed filters, text search, orders, pages, and query state in URLs."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from functools import reduce
from urllib.parse import parse_qsl, urlencode

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.functions.dates import newest_first
from quernstone.functions.text import rank_in

PAGE_SIZES = (50, 100, 250, 500, 1000)
SEVERITIES = ["Info", "Low", "Medium", "High", "Critical"]


def stands(status: str = "status") -> Column:
    """Whether a record counts: its status is neither retracted nor unverified; no status counts."""
    return ~F.coalesce(F.lower(F.trim(F.col(status))).isin("retracted", "unverified"), F.lit(False))


def matches(df: DataFrame, name: str, value) -> Column:
    """A field's test by its type: membership for arrays, equality without coercion for others.

    A missing value matches nothing; a value of another type than the field's matches nothing.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.array_contains(F.col(name), value), F.lit(False))
    number = isinstance(kind, T.NumericType)
    if isinstance(value, bool) != isinstance(kind, T.BooleanType) or number != (isinstance(value, (int, float)) and not isinstance(value, bool)):
        return F.lit(False)
    return F.coalesce(F.col(name) == F.lit(value), F.lit(False))


def text_of(df: DataFrame, column: str) -> Column:
    """A column's text; arrays are joined by blanks.  ``primary_reference``, where it is no column, is the
    first reference's URL."""
    if column == "primary_reference" and column not in df.columns:
        return F.get(F.col("references.url"), F.lit(0)) if "references" in df.columns else F.lit(None).cast("string")
    return F.array_join(F.col(column), " ") if isinstance(df.schema[column].dataType, T.ArrayType) else F.col(column).cast("string")


def haystack(columns: list[str], df: DataFrame) -> Column:
    """The columns' text in one lower-cased string; arrays are joined by blanks."""
    parts = [text_of(df, c) for c in columns]
    return F.lower(F.concat_ws(" ", *parts))


def with_text(df: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """Rows in whose columns the text occurs, whatever its case."""
    return df.where(F.contains(haystack(columns, df), F.lit(text.strip().lower())))


def by_id(df: DataFrame, value: str, column: str = "id", order: str | None = None) -> DataFrame:
    """The row with that id, or none; of several the first by ``order``, or else the one with the least values.

    Looks at all rows, retracted ones too.  A null id is found by nothing.
    """
    found = df.where(F.col(column) == F.lit(value))
    # min_by keeps one row for each partition before anything moves.
    row = F.struct(*(F.col(c) for c in df.columns))
    rank = F.col(order) if order else F.xxhash64(*df.columns)
    return found.groupBy(F.col(column).alias("_id")).agg(F.min_by(row, F.struct(rank, F.xxhash64(*df.columns))).alias("_row")).select("_row.*")


def by_identifier(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose array holds the value in upper case and without outer blanks."""
    return df.where(F.array_contains(F.col(column), value.strip().upper()))


@dataclass
class QuerySpec:
    """A query's state: equality and membership filters, search text, order and page."""

    filters: dict = field(default_factory=dict)
    has: list[str] = field(default_factory=list)
    lacks: list[str] = field(default_factory=list)
    text: str = ""
    text_columns: tuple[str, ...] = ("id", "title", "cve_ids", "primary_reference")
    standing_only: bool = False
    sort: str = "newest"
    page: int = 1
    size: int = 250

    def rows(self, df: DataFrame) -> DataFrame:
        """All matching rows, in no order."""
        filled = lambda c: F.size(F.coalesce(F.col(c), F.array())) > 0 if isinstance(df.schema[c].dataType, T.ArrayType) else F.col(c).isNotNull()
        tests = [matches(df, n, v) for n, v in self.filters.items() if v is not None] + [filled(c) for c in self.has] + [~filled(c) for c in self.lacks]
        if self.standing_only:
            tests.append(stands())
        if tests:
            df = df.where(reduce(lambda a, b: a & b, tests))
        return with_text(df, self.text, [c for c in self.text_columns if c in df.columns or c == "primary_reference"]) if self.text.strip() else df

    def order(self) -> list[Column]:
        orders = {
            "newest": [*newest_first(F.col("date")), F.lower("title").asc(), F.col("id").asc()],
            "padded": [F.rpad(F.coalesce("date", F.col("year").cast("string"), F.lit("")), 10, "0").desc(), F.col("id").asc()],
            "severity": [rank_in(F.col("severity"), SEVERITIES).desc(), F.col("id").asc()],
            "title": [F.lower("title").asc(), F.col("id").asc()],
        }
        return orders[self.sort]

    def ordered(self, df: DataFrame) -> DataFrame:
        return self.rows(df).orderBy(*self.order())

    def paged(self, df: DataFrame) -> DataFrame:
        """The page's rows; a page before the first or past the last is the first."""
        rows = self.rows(df)
        start = (self.page - 1) * self.size
        if self.page < 1 or (self.page > 1 and rows.count() <= start):
            start = 0
        return rows.orderBy(*self.order()).offset(start).limit(self.size)

    def to_url(self) -> str:
        """Query string of everything that differs from the default."""
        base = QuerySpec()
        pairs = [(f"f.{k}", v) for k, v in sorted(self.filters.items())] + [("has", h) for h in self.has] + [("lacks", h) for h in self.lacks]
        pairs += [(f.name, getattr(self, f.name)) for f in fields(self) if f.name in ("text", "sort", "page", "size", "standing_only") and getattr(self, f.name) != getattr(base, f.name)]
        return urlencode(pairs)

    @classmethod
    def from_url(cls, query: str, numbers: tuple[str, ...] = ("year",)) -> QuerySpec:
        """The state in a query string; unknown keys, orders and page sizes are ignored."""
        spec = cls()
        for key, value in parse_qsl(query.lstrip("?")):
            if key.startswith("f."):
                spec.filters[key[2:]] = int(value) if key[2:] in numbers and value.isdigit() else value
            elif key == "has":
                spec.has.append(value)
            elif key == "lacks":
                spec.lacks.append(value)
            elif key == "text":
                spec.text = value
            elif key == "standing_only":
                spec.standing_only = value == "True"
            elif key == "sort" and value in ("newest", "padded", "severity", "title"):
                spec.sort = value
            elif key == "page" and value.isdigit():
                spec.page = int(value)
            elif key == "size" and value.isdigit() and int(value) in PAGE_SIZES:
                spec.size = int(value)
        return spec
