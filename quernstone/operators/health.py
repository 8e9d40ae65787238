"""Health of sources over runs: a small state machine, in batch form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STALE_AFTER = 3


def health_history(runs: DataFrame, source: str, order: list[str], outcome: str, stale_after: int = STALE_AFTER) -> DataFrame:
    """The runs with the failures in a row up to each and the status: ok, degraded, or stale.

    Outcomes are success, failure and anything else, which changes nothing.  A success starts over.
    """
    w = Window.partitionBy(source).orderBy(*order)
    era = F.sum((F.col(outcome) == "success").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = runs.withColumn("_era", era)
    failures = F.sum((F.col(outcome) == "failure").cast("int")).over(Window.partitionBy(source, "_era").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    status = F.when(F.col("failures") >= stale_after, "stale").when(F.col("failures") > 0, "degraded").otherwise("ok")
    return rows.withColumn("failures", failures).withColumn("status", status).drop("_era")


def current_health(runs: DataFrame, source: str, order: str, outcome: str, stale_after: int = STALE_AFTER) -> DataFrame:
    """(source, last_success, failures, status): the state after all runs, without a window.

    Failures in a row are those after the last success, so two partial aggregations do, however many runs.
    """
    last = runs.groupBy(source).agg(F.max(F.when(F.col(outcome) == "success", F.col(order))).alias("last_success"))
    later = runs.join(last, source).where("last_success IS NULL OR " + f"{order} > last_success")
    failed = later.groupBy(source).agg(F.count_if(F.col(outcome) == "failure").alias("failures"))
    joined = last.join(failed, source, "left").withColumn("failures", F.coalesce("failures", F.lit(0)))
    return joined.withColumn("status", F.when(F.col("failures") >= stale_after, "stale").when(F.col("failures") > 0, "degraded").otherwise("ok"))


def pause_state(until: str, today: str, horizon_days: int = 180) -> Column:
    """none, active, invalid or expired for a pause's last day in ISO form."""
    day = F.col(until).try_cast("date")
    now = F.lit(today).cast("date")
    return F.when(F.col(until).isNull(), "none").when(day.isNull() | (F.datediff(day, now) > horizon_days), "invalid").when(day < now, "expired").otherwise("active")
