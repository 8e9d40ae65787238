"""Several values packed in one field: one row per value, with its position."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions.packed import split_packed


def _explode(batches):
    for batch in batches:
        lists = split_packed(batch.column(1))
        counts = np.diff(np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1])
        parent = np.repeat(np.arange(len(lists)), counts)
        pos = np.arange(len(parent)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(parent)), pa.array(pos.astype(np.int32)), lists.flatten(), pa.array(np.repeat(counts, counts).astype(np.int32))],
            names=["id", "pos", "item", "items"],
        )


def explode_packed(df: DataFrame, id_column: str, packed_column: str, order_column: str | None = None) -> DataFrame:
    """(id, pos, item, items): each value of the packed field, its place from 1, and how many there are.

    Of several rows of one id the one with the greatest ``order_column`` counts (null is least; a tie
    goes to the greater field value).  Without an order column every row counts.  Null or empty fields
    and null ids give no rows.  Other columns are ignored, whatever their names.
    """
    rows = df.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), F.col(packed_column).cast("string").alias("packed"), *([F.col(order_column).alias("ord")] if order_column else []))
    if order_column:
        rows = rows.groupBy("id").agg(F.max_by("packed", F.struct("ord", "packed")).alias("packed"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.where("packed IS NOT NULL").select("id", "packed").mapInArrow(_explode, f"id {kind}, pos int, item string, items int")
