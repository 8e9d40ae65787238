"""Changes between consecutive full snapshots of a table.

Each row shrinks to a key hash, a row hash and its order before anything is moved.  A bucket's hashes of all
snapshots are sorted in numpy, and sorted arrays of neighbouring snapshots are set against each other by
binary search; full keys and values are fetched, and compared again, for the differing keys only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.plans.lineage import cut

#: Rows that a task compares.
TASK_ROWS = 4_000_000
LEAST = -(1 << 63)


def day(column: Column | str) -> Column:
    """The day of a date in ISO form, with dashes, slashes, dots or none, a time after it or not.

    Anything else is compared as it stands, trimmed and in lower case; blank is null.
    """
    text = F.lower(F.trim(F.col(column) if isinstance(column, str) else column))
    found = F.regexp_extract(text, r"^([0-9]{4})[-/.]?([0-9]{2})[-/.]?([0-9]{2})(?![0-9])", 0)
    digits = F.regexp_replace(found, "[-/.]", "")
    iso = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    return F.when(found != "", iso).when(text != "", text)


def _last(at: np.ndarray, key: np.ndarray, ord_: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted rows: which are the last of their snapshot and key, and whether others as late differ."""
    group_end = np.ones(len(key), bool)
    group_end[:-1] = (at[1:] != at[:-1]) | (key[1:] != key[:-1])
    tied = np.zeros(len(key), bool)
    tied[1:] = ~group_end[:-1] & (ord_[1:] == ord_[:-1]) & (row[1:] != row[:-1])
    return group_end, tied


def _sorted(batches) -> list[np.ndarray]:
    """at, hash, ord and row of all rows in order, equal rows once."""
    parts = [tuple(b.column(i).to_numpy() for i in range(4)) for b in batches if b.num_rows]
    if not parts:
        return []
    at, key, ord_, row = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((row, ord_, key, at))
    columns = [c[order] for c in (at, key, ord_, row)]
    new = np.ones(len(at), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return [c[new] for c in columns]


def _shrink(batches):
    """Leaves of each batch the latest rows of a snapshot's key, so that a hot key travels once a batch."""
    for batch in batches:
        columns = _sorted([batch])
        if columns:
            at, key, ord_, row = columns
            end, tied = _last(at, key, ord_, row)
            # Of rows that are equally late and differ, two suffice to show it.
            keep = end.copy()
            keep[:-1] |= end[1:] & tied[1:]
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (at, key, ord_, row)], names=["at", "hash", "ord", "row"])


def _compare(snapshots: int):
    """(hash) of each key that may differ between snapshots.  Rows in: at, hash, ord, row of a partition's keys."""

    def run(batches):
        columns = _sorted(batches)
        if not columns:
            return
        at, key, ord_, row = columns
        end, tied = _last(at, key, ord_, row)
        at, key, row, unsure = at[end], key[end], row[end], tied[end]
        edges = np.searchsorted(at, np.arange(snapshots + 1))
        found = [np.zeros(0, np.int64)]
        for i in range(1, snapshots):
            old, new = slice(edges[i - 1], edges[i]), slice(edges[i], edges[i + 1])
            before, after = key[old], key[new]
            if not len(before) or not len(after):
                found.append(before if len(before) else after)
                continue
            spot = np.minimum(np.searchsorted(before, after), len(before) - 1)
            same = before[spot] == after
            # Rows whose last version is not clear from hashes alone go on to the exact comparison.
            differs = same & ((row[old][spot] != row[new]) | unsure[old][spot] | unsure[new])
            spot = np.minimum(np.searchsorted(after, before), len(after) - 1)
            found += [after[~same], before[after[spot] != before], after[differs]]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)))], names=["hash"])

    return run


def _as_number(column: Column, kind: T.DataType) -> Column:
    """The order as a number, null least."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        number = F.unix_micros(column.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        number = F.unix_date(column).cast("bigint")
    elif isinstance(kind, T.IntegralType):
        number = column.cast("bigint")
    else:
        raise TypeError(f"snapshots are ordered by times, days or whole numbers, not by {kind.simpleString()}")
    return F.coalesce(number, F.lit(LEAST))


def snapshot_changes(df: DataFrame, snapshot: str, key: Column, compared: dict[str, Column], order_column: str) -> DataFrame:
    """(snapshot_on, key, change_kind, before, after): what differs from each snapshot to the next.

    ``before`` and ``after`` are structs of the compared values, null for an added or a removed key.
    Snapshots follow each other in the order of ``snapshot``.  Null keys and null snapshots are left out;
    of several rows for a key in a snapshot the one with the greatest ``order_column`` (a time, a day or a
    whole number) holds; null is least, and a tie goes to the greater compared values.  One snapshot or
    none gives no rows.
    """
    spark = df.sparkSession
    names = sorted(r[0] for r in df.select(snapshot).where(F.col(snapshot).isNotNull()).distinct().collect())
    days = spark.createDataFrame([(n, i) for i, n in enumerate(names)], f"snapshot_on {df.schema[snapshot].dataType.simpleString()}, at int")
    values = F.struct(*(c.alias(n) for n, c in compared.items()))
    given = df.select(F.col(snapshot).alias("snapshot_on"), key.alias("key"), values.alias("values"), _as_number(F.col(order_column), df.schema[order_column].dataType).alias("ord"))
    # One row for each snapshot.
    rows = given.where("snapshot_on IS NOT NULL AND key IS NOT NULL").join(F.broadcast(days), "snapshot_on").withColumn("hash", F.xxhash64("key"))
    present = [F.coalesce(F.col(f"values.{n}").cast("string"), F.lit("\0")) for n in compared]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / TASK_ROWS))
    slim = rows.select("at", "hash", "ord", F.xxhash64(*present).alias("row")).mapInArrow(_shrink, "at int, hash bigint, ord bigint, row bigint")
    found = cut(slim.repartition(parts, "hash").mapInArrow(_compare(len(names)), "hash bigint"), "differing")
    # Everything of the differing keys: their last rows, set against each other in full.
    latest = rows.join(found, "hash", "left_semi").groupBy("at", "key").agg(F.max_by("values", F.struct("ord", "values")).alias("values"))
    none = F.lit(None).cast(latest.schema["values"].dataType)
    sides = latest.select("key", F.explode(F.array(F.struct("at", F.col("values").alias("after"), none.alias("before")), F.struct((F.col("at") + 1).alias("at"), none.alias("after"), F.col("values").alias("before")))).alias("s"))
    both = sides.select("key", "s.*").where(F.col("at").between(1, len(names) - 1)).groupBy("at", "key").agg(F.max("after").alias("after"), F.max("before").alias("before"))
    kind = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(~F.col("before").eqNullSafe(F.col("after")), "changed")
    return both.withColumn("change_kind", kind).where("change_kind IS NOT NULL").join(F.broadcast(days), "at").select("snapshot_on", "key", "change_kind", "before", "after")
