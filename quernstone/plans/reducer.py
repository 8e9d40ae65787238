"""A semi-join reducer of bounded size: which of its slots the wanted keys fall into.

Built by partial aggregation in the JVM, it has SLOTS slots for each key that may come and at most
2**MOST_BITS / 8 bytes (16 MB), however many keys there are.  It only spares the shuffle rows that a later
exact join would drop anyway: beyond some 10**8 keys it fills up and lets everything pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 16, 27
SLOTS = 4
_PAGE = 32_768


class Reducer:
    def __init__(self, keys: DataFrame, key: Column, rows: int = 1 << 22) -> None:
        """``rows``: how many keys there may be, roughly."""
        self.slots = 1 << min(MOST_BITS, max(LEAST_BITS, (SLOTS * rows).bit_length()))
        slot = F.pmod(key, F.lit(self.slots))
        pages = keys.select(slot.alias("slot")).groupBy(F.expr(f"slot div {_PAGE}").alias("page")).agg(F.bitmap_construct_agg(F.expr(f"slot % {_PAGE}")).alias("bits")).collect()
        self.bits = np.zeros(self.slots // 8, np.uint8)
        for page, bits in pages:
            self.bits[page * _PAGE // 8 : (page + 1) * _PAGE // 8] = np.frombuffer(bits, np.uint8)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """For each 64-bit key whether it may be wanted; true for every key that is."""
        slot = keys.view(np.int64) & (self.slots - 1)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1

    def keep(self, df: DataFrame, key: Column) -> DataFrame:
        """The rows whose key may be wanted, dropped batch by batch before any shuffle."""
        held = df.sparkSession.sparkContext.broadcast(self)
        schema = df.schema

        def run(batches):
            for batch in batches:
                mask = pa.array(held.value.may_hold(batch.column(batch.num_columns - 1).to_numpy()))
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(mask)

        return df.select("*", key.alias("_key")).mapInArrow(run, schema)
