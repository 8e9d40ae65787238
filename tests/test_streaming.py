from pyspark.sql import functions as F

from quernstone.streaming import stateful

SCHEMA = "id string, status string, day string, ts timestamp, outcome string"


def feed(spark, tmp_path, name, batches):
    """A stream that takes one written file per trigger."""
    folder = tmp_path / name
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "id string, status string, day string, outcome string").withColumn("ts", F.to_timestamp("day")).select("id", "status", "day", "ts", "outcome").coalesce(1).write.mode("append").parquet(str(folder / f"b={i}"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def run(stream, name, mode, tmp_path):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name).collect()


def test_changes(spark, tmp_path):
    stream = feed(spark, tmp_path, "c", [[("a", "x", "2026-01-01", ""), ("b", "x", "2026-01-01", "")], [("a", "x", "2026-01-02", ""), ("b", "y", "2026-01-02", "")], [("b", "y", "2026-01-03", "")]])
    got = {tuple(r) for r in run(stateful.detect_changes(stream, "id", ["status"], "day"), "changes", "append", tmp_path)}
    assert got == {("a", "2026-01-01", "2026-01-01", "added"), ("b", "2026-01-01", "2026-01-01", "added"), ("b", "2026-01-01", "2026-01-02", "changed")}


def test_health(spark, tmp_path):
    stream = feed(spark, tmp_path, "h", [[("s", "", "2026-01-01", "failure"), ("s", "", "2026-01-02", "failure")], [("s", "", "2026-01-03", "skipped"), ("s", "", "2026-01-04", "failure")], [("s", "", "2026-01-05", "success")]])
    got = [(r.failures, r.status) for r in run(stateful.health_stream(stream, "id", "outcome", "ts"), "health", "update", tmp_path)]
    assert got == [(2, "degraded"), (3, "stale"), (0, "ok")]


def test_late_rows_and_windows(spark, tmp_path):
    stream = feed(spark, tmp_path, "w", [[("a", "", "2026-01-10", "")], [("a", "", "2026-01-11", "")], [("b", "", "2026-01-01", ""), ("c", "", "2026-01-10", "")], [("d", "", "2026-02-10", "")]])
    got = {(str(r.window_start)[:10], r.n) for r in run(stateful.windowed_counts(stream, "ts", "1 day", None, "2 days", []), "windows", "append", tmp_path)}
    assert got == {("2026-01-10", 2), ("2026-01-11", 1)}


def test_upsert(spark, tmp_path):
    stream = feed(spark, tmp_path, "u", [[("a", "1", "2026-01-01", ""), ("b", "1", "2026-01-01", "")], [("b", "2", "2026-01-02", "")]])
    path = str(tmp_path / "stored")
    stream.select("id", "status").writeStream.option("checkpointLocation", str(tmp_path / "us")).trigger(availableNow=True).foreachBatch(stateful.grow_only_upsert(["id"], path)).start().awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(f"{path}/version=1").collect()} == {("a", "1"), ("b", "2")}
