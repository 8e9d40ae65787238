"""Structured Streaming forms: change detection, grow-only upsert, source health, windowed counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout


def windowed_counts(events: DataFrame, time: str, window: str, slide: str | None, lateness: str, by: list[str]) -> DataFrame:
    """Counts per time window and group; events later than ``lateness`` behind the newest are dropped."""
    return events.withWatermark(time, lateness).groupBy(F.window(time, window, slide), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *by, "n")


def sessions(events: DataFrame, time: str, gap: str, lateness: str, by: list[str]) -> DataFrame:
    """Sessions of activity separated by gaps."""
    return events.withWatermark(time, lateness).groupBy(F.session_window(time, gap), *by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *by, "n")


def first_seen(events: DataFrame, keys: list[str], time: str, lateness: str) -> DataFrame:
    """The first event of each key; keys are forgotten once the watermark has passed them."""
    return events.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def detect_changes(rows: DataFrame, key: str, content: list[str], day: str) -> DataFrame:
    """(key, added, updated, change): one row whenever a key is new or its content differs from the last seen.

    Rows of a batch are taken by day, equal ones by content hash, so that a rerun gives the same.
    """

    def step(keys: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, added, updated = state.get if state.exists else (None, None, None)
        out = []
        seen = pd.concat(list(batches)).sort_values(["day", "content"])
        for content_hash, on in zip(seen["content"], seen["day"]):
            if content_hash != last:
                change = "added" if last is None else "changed"
                added, updated, last = added or on, on, content_hash
                out.append((keys[0], added, updated, change))
        state.update((last, added, updated))
        yield pd.DataFrame(out, columns=[key, "added", "updated", "change"])

    slim = rows.select(key, F.md5(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in content))).alias("content"), F.col(day).cast("string").alias("day"))
    kind = rows.schema[key].dataType.simpleString()
    return slim.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, added string, updated string, change string", "hash string, added string, updated string", "append", GroupStateTimeout.NoTimeout)


def grow_only_upsert(keys: list[str], path: str) -> Callable[[DataFrame, int], None]:
    """A sink for foreachBatch: fresh rows replace stored ones with the same keys, others stay.

    Each batch writes a new version beside the old one, so a failed batch leaves the last version whole.  A
    batch builds on the latest version before its own number, whatever that is; a version that is there but
    can't be read is an error, never an empty table.  Of several rows of a batch with the same keys the one
    with the least hash of all its values stays.
    """
    from quernstone.operators.latest import upsert

    def versions(spark) -> list[int]:
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
        done = [n for n in names if n.startswith("version=") and system.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
        return sorted(int(n.removeprefix("version=")) for n in done)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = [v for v in versions(spark) if v < number]
        stored = spark.read.parquet(f"{path}/version={before[-1]}") if before else None
        every = F.struct(*batch.columns)
        rows = batch.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min_by(every, F.xxhash64(*batch.columns)).alias("_row")).select("_row.*")
        (upsert(rows, stored, keys) if stored is not None else rows).write.mode("overwrite").parquet(f"{path}/version={number}")

    return write


def health_stream(runs: DataFrame, source: str, outcome: str, time: str, stale_after: int = 3) -> DataFrame:
    """(source, failures, status) after each batch in which the source ran."""

    def step(keys: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        failures = state.get[0] if state.exists else 0
        for one in pd.concat(list(batches)).sort_values(time)[outcome]:
            failures = 0 if one == "success" else failures + 1 if one == "failure" else failures
        state.update((failures,))
        yield pd.DataFrame({source: [keys[0]], "failures": [failures], "status": ["stale" if failures >= stale_after else "degraded" if failures else "ok"]})

    kind = runs.schema[source].dataType.simpleString()
    return runs.select(source, outcome, time).groupBy(source).applyInPandasWithState(step, f"{source} {kind}, failures long, status string", "failures long", "update", GroupStateTimeout.NoTimeout)
