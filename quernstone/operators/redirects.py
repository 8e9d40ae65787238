"""Retired ids and their successors: an append-only log of records (seq, from, into).

``into`` is an array of ids: one successor, several, or none for a withdrawal.  The last record of an id
holds.  Chains are followed by joins over all ids at once, one round per hop.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.plans.lineage import Cut, cut

MOST_HOPS = 100


def last_records(log: DataFrame, skip_empty: bool = False) -> DataFrame:
    """(from, into): each id's last record; with ``skip_empty`` a later withdrawal doesn't clear a successor."""
    if skip_empty:
        log = log.where(F.size(F.coalesce("into", F.array())) > 0)
    return log.groupBy("from").agg(F.max_by("into", "seq").alias("into"))


def walk(ids: DataFrame, last: DataFrame, live: DataFrame, fan_out: bool) -> DataFrame:
    """(id, node, hops, end): where the walk from each id ends; end is live, withdrawn, unknown, split or cycle.

    Without ``fan_out`` a record with several successors ends the walk as split; with it all are followed.
    An id may end in several nodes.  Each path remembers its nodes, so cycles end.
    """
    alive = live.select(F.col("id").alias("node")).distinct().withColumn("alive", F.lit(True))
    steps = last.select(F.col("from").alias("node"), F.coalesce("into", F.array().cast(last.schema["into"].dataType)).alias("into")).withColumn("known", F.lit(True))
    frontier = ids.select("id", F.col("id").alias("node"), F.array("id").alias("path")).distinct()
    ends: list[Cut] = []
    for hop in range(MOST_HOPS):
        seen = frontier.join(alive, "node", "left").join(steps, "node", "left")
        end = (
            F.when(F.col("alive"), "live")
            .when(F.col("known").isNull(), "unknown")
            .when(F.size("into") == 0, "withdrawn")
            .when((F.size("into") > 1) & F.lit(not fan_out), "split")
        )
        now = Cut(seen.select("id", "node", "path", F.coalesce("into", F.array().cast(last.schema["into"].dataType)).alias("into"), end.alias("end")), "walk")
        ends.append(now)
        on = now.read().where("end IS NULL").select("id", F.explode("into").alias("node"), "path")
        if on.isEmpty():
            break
        looped = on.select("id", "node", F.when(F.array_contains("path", F.col("node")), "cycle").alias("end"), "path")
        cycles = Cut(looped.where("end IS NOT NULL").withColumn("into", F.array().cast(last.schema["into"].dataType)).select("id", "node", "path", "into", "end"), "walk")
        ends.append(cycles)
        frontier = looped.where("end IS NULL").select("id", "node", F.array_append("path", F.col("node")).alias("path"))
    else:
        raise RuntimeError("a chain of redirects is longer than the limit")
    whole = ends[0].read()
    for e in ends[1:]:
        whole = whole.unionByName(e.read())
    return whole.where("end IS NOT NULL").select("id", "node", (F.size("path") - 1).alias("hops"), "end")


def resolve(ids: DataFrame, log: DataFrame, live: DataFrame) -> DataFrame:
    """(id, target): the live id at the end of a chain of single successors, null if there is none."""
    ends = walk(ids, last_records(log), live, fan_out=False)
    return ends.groupBy("id").agg(F.max(F.when(F.col("end") == "live", F.col("node"))).alias("target"))


def resolve_groups(ids: DataFrame, log: DataFrame, live: DataFrame) -> DataFrame:
    """(id, targets): every live id reachable by following all successors, sorted."""
    ends = walk(ids, last_records(log), live, fan_out=True)
    return ends.groupBy("id").agg(F.array_sort(F.collect_set(F.when(F.col("end") == "live", F.col("node")))).alias("targets"))


def answer(ids: DataFrame, log: DataFrame, live: DataFrame) -> DataFrame:
    """(id, kind, targets): live, successor, group, withdrawn or unknown for each id.

    An id in no record is unknown; one whose every path ends in a removal, a gap or a cycle is withdrawn.
    """
    groups = resolve_groups(ids, log, live)
    alive = live.select("id").distinct().withColumn("alive", F.lit(True))
    known = log.select(F.col("from").alias("id")).distinct().withColumn("known", F.lit(True))
    kind: Column = F.when(F.col("alive"), "live").when(F.col("known").isNull(), "unknown").when(F.size("targets") == 0, "withdrawn").when(F.size("targets") == 1, "successor").otherwise("group")
    return groups.join(alive, "id", "left").join(known, "id", "left").select("id", kind.alias("kind"), "targets")


def canonical_release(release: str) -> str:
    """``2.3.0`` and ``v2.3.0`` as ``v2.3.0``; anything else is an error."""
    text = release.strip()
    text = text if text.startswith("v") else f"v{text}"
    if not re.fullmatch(r"v[0-9]+\.[0-9]+\.[0-9]+", text):
        raise ValueError(f"a release looks like v2.3.0, not like {release!r}")
    return text


def status(ids: DataFrame, log: DataFrame, live: DataFrame, release: str | None = None, untold: tuple[str, ...] = ()) -> DataFrame:
    """(id, status, successor, group, by_release, reason): how each id resolves, and why.

    ``log`` has beside seq, from and into a ``reason`` and ``releases``, null for records that hold in general.
    Scoped records tell what an id meant in the releases listed: for a ``release`` among them the record's
    successor is the start instead of the id.  The last record that names a successor holds; a later
    withdrawal doesn't clear it, but gives the reason.

    live: a current id.  successor: one live id at the end of single steps.  group: several steps, or steps
    that part; ``group`` has every live id reached, sorted.  release-dependent: scoped records exist and no
    release was given.  pre-tombstone: the last general record's reason is among ``untold``.  withdrawn: a
    record, but nothing live.  unknown: no general record, nothing live.
    """
    wanted = canonical_release(release) if release is not None else None
    asked = ids.select("id").distinct()
    alive = live.select("id").distinct().withColumn("alive", F.lit(True))
    scoped = log.where("releases IS NOT NULL").select(F.col("from").alias("id"), "seq", "into", "reason", F.explode("releases").alias("release"))
    last_scoped = scoped.groupBy("id", "release").agg(F.max_by(F.struct(F.get("into", F.lit(0)).alias("into"), "reason"), "seq").alias("r"))
    # A row for each release of an id that its log lists: short lists.
    by_release = last_scoped.groupBy("id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("release", F.col("r.into").alias("into"))))).alias("by_release"))
    general = log.where("releases IS NULL")
    reasons = general.groupBy(F.col("from").alias("id")).agg(F.max_by("reason", "seq").alias("last_reason"), F.lit(True).alias("known"))
    at = last_scoped.where(F.col("release") == F.lit(wanted)).select("id", F.col("r.into").alias("start"), F.col("r.reason").alias("scoped_reason"), F.lit(True).alias("covered"))
    rows = asked.join(alive, "id", "left").join(by_release, "id", "left").join(reasons, "id", "left").join(at, "id", "left")
    rows = cut(rows.withColumn("start", F.when(F.col("covered"), F.col("start")).otherwise(F.col("id"))), "asked")
    last = last_records(general, skip_empty=True)
    starts = rows.where("start IS NOT NULL").select(F.col("start").alias("id")).distinct()
    targets = lambda fan_out: walk(starts, last, live, fan_out).groupBy("id").agg(F.array_sort(F.collect_set(F.when(F.col("end") == "live", F.col("node")))).alias("targets"))
    one = targets(False).select(F.col("id").alias("start"), F.get("targets", F.lit(0)).alias("one"))
    every = targets(True).select(F.col("id").alias("start"), F.col("targets").alias("group"))
    both = rows.join(one, "start", "left").join(every, "start", "left").withColumn("group", F.coalesce("group", F.array().cast(every.schema["group"].dataType)))
    some = F.size("group") > 0
    covered = F.coalesce("covered", F.lit(False))
    told = F.coalesce(F.col("last_reason").isin(*untold), F.lit(False)) if untold else F.lit(False)
    dependent = F.col("by_release").isNotNull() & F.lit(wanted is None)
    kind = (
        F.when(F.col("alive"), "live")
        .when(covered, F.when(F.col("one").isNotNull(), "successor").when(some, "group").otherwise("withdrawn"))
        .when(dependent, "release-dependent")
        .when(told, "pre-tombstone")
        .when(F.col("one").isNotNull(), "successor")
        .when(some, "group")
        .when(F.col("known").isNull(), "unknown")
        .otherwise("withdrawn")
    )
    reason = F.when(F.col("alive"), F.lit(None)).when(covered, F.col("scoped_reason")).otherwise(F.col("last_reason"))
    answered = both.withColumn("status", kind)
    return answered.select("id", "status", F.when(F.col("status").isin("live", "successor"), F.col("one")).alias("successor"), "group", F.when(F.col("alive").isNull(), F.col("by_release")).alias("by_release"), reason.alias("reason"))


def dangling(log: DataFrame, live: DataFrame) -> DataFrame:
    """(from): ids of last records with successors of which not all lead to a live id or a recorded removal."""
    last = last_records(log)
    ids = last.where(F.size(F.coalesce("into", F.array())) > 0).select(F.col("from").alias("id"))
    ends = walk(ids, last, live, fan_out=True)
    return ends.where(F.col("end").isin("unknown", "cycle")).select(F.col("id").alias("from")).distinct()
