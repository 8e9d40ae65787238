"""Stable ids over rebuilds: keys, ordered merging, field-wise merge, id allocation and redirects."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.functions import arrays
from quernstone.plans.lineage import Cut, cut

#: Kinds of key in order of precedence.
KINDS = ("cve", "source", "url", "title")
MOST_ROUNDS = 100


def record_keys(rows: DataFrame) -> DataFrame:
    """(seq, kind, key) of rows with seq and the arrays cve, source, url and the string title; each once."""
    def named(kind: str) -> Column:
        return F.transform(arrays.strings(F.col(kind)), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("key")))

    per = F.array(*(named(k) for k in KINDS[:3]), F.when(F.col("title") != "", F.array(F.struct(F.lit("title").alias("kind"), F.col("title").alias("key")))))
    return rows.select("seq", F.explode(F.flatten(F.array_compact(per))).alias("k")).select("seq", "k.kind", "k.key").distinct()


def linked_sets(keys: DataFrame) -> DataFrame:
    """(seq, root): the least seq of all rows tied by any key, by least-label rounds with shortcuts.

    A key's rows get the key's least label, a partial aggregation whatever the number of rows.  Rows that
    share no key are left out.
    """
    shared = keys.groupBy("kind", "key").agg(F.count("*").alias("n")).where("n > 1").select("kind", "key")
    keys = cut(keys.join(shared, ["kind", "key"]), "keys")
    labels = Cut(keys.select("seq").distinct().withColumn("root", F.col("seq")), "labels")
    total = labels.read().agg(F.sum("root")).first()[0]
    for _ in range(MOST_ROUNDS):
        now = labels.read()
        per_key = keys.join(now, "seq").groupBy("kind", "key").agg(F.min("root").alias("low"))
        least = keys.join(per_key, ["kind", "key"]).groupBy("seq").agg(F.min("low").alias("root"))
        # A row's new label is hooked under its old label's row too, so that whole sets move at once.
        hooked = least.join(now.withColumnRenamed("root", "old"), "seq").select(F.explode(F.array(F.struct("seq", "root"), F.struct(F.col("old").alias("seq"), F.col("root")))).alias("h"))
        lower = hooked.select("h.*").groupBy("seq").agg(F.min("root").alias("root"))
        jump = lower.join(now.select(F.col("seq").alias("root"), F.col("root").alias("further")), "root").select("seq", F.least("root", "further").alias("root"))
        after = Cut(jump, "labels")
        before, total = total, after.read().agg(F.sum("root")).first()[0]
        labels.drop()
        labels = after
        if total == before:  # labels only ever fall
            return labels.read()
    raise RuntimeError("the links did not settle")


class _Record:
    """A record while rows are replayed: its first row, year, and all keys that it has gathered."""

    def __init__(self, row) -> None:
        self.seq, self.into = row.seq, None
        self.year = row.year if row.year == row.year else None
        self.keys = {kind: dict.fromkeys(getattr(row, kind)) for kind in KINDS[:3]}
        self.prior = set(getattr(row, "prior", None) if getattr(row, "prior", None) is not None else ())

    def live(self) -> _Record:
        record = self
        while record.into is not None:
            record = record.into
        return record

    def take(self, other: _Record) -> None:
        other.into = self
        self.year = other.year if self.year is None else self.year
        self.prior |= other.prior
        for kind, keys in other.keys.items():
            self.keys[kind].update(keys)

    def apart(self, other: _Record) -> bool:
        """Whether both have CVEs and share none."""
        mine, others = self.keys["cve"], other.keys["cve"]
        return bool(mine and others) and mine.keys().isdisjoint(others)

    def may_share(self, other: _Record, wide: bool) -> bool:
        """Whether a weak key may join the two; those that one published record held together always may."""
        return bool(self.prior & other.prior) or not (wide or self.apart(other))


def _fold(rows: pd.DataFrame) -> pd.DataFrame:
    """Replays the rows of one linked set in order; each row joins the first record that holds one of its keys.

    CVEs are tried before source ids, URLs and titles.  A URL or title is refused where both records have CVEs
    and share none, a round-up's URL always, unless both once lay in one published record; a title also needs
    years at most one apart.  A record that has gained keys draws in the records that hold them, CVEs and
    source ids always, URLs by the same rule, until it gains no more.
    """
    owner: dict[str, dict[str, _Record]] = {kind: {} for kind in KINDS}
    records: list[_Record] = []
    round_ups = set().union(*rows["wide"]) if "wide" in rows and len(rows) else set()

    def settle(record: _Record) -> None:
        before = -1
        while before != (before := sum(map(len, record.keys.values()))):
            for kind in KINDS[:3]:
                for key in list(record.keys[kind]):
                    other = owner[kind].setdefault(key, record).live()
                    if other is not record:
                        if kind == "url" and not record.may_share(other, key in round_ups):
                            continue
                        record.take(other)
                    owner[kind][key] = record

    for row in rows.sort_values("seq").itertuples():
        new = _Record(row)
        records.append(new)
        hit = next((owner[k][x].live() for k in ("cve", "source") for x in getattr(row, k) if x in owner[k]), None)
        if hit is None:
            found = ((owner["url"][x].live(), x) for x in row.url if x in owner["url"])
            hit = next((r for r, x in found if r.may_share(new, x in round_ups)), None)
        if hit is None and row.title and row.title in owner["title"]:
            other = owner["title"][row.title].live()
            near = other.year is not None and new.year is not None and abs(other.year - new.year) <= 1
            hit = other if near and other.may_share(new, False) else None
        if hit is not None:
            hit.take(new)
        settle(hit or new)
        if hit is None and row.title:
            owner["title"].setdefault(row.title, new)
    return pd.DataFrame({"seq": [r.seq for r in records], "survivor": [r.live().seq for r in records]}, dtype="int64")


def _fold_partition(batches):
    """Replays all linked sets of a partition at once: sets share no key, so they don't touch each other."""
    frames = list(batches)
    if frames:
        yield _fold(pd.concat(frames))


def ordered_merge(rows: DataFrame, round_ups: str | None = None, prior: DataFrame | None = None) -> DataFrame:
    """(seq, survivor): the row that stands for the record into which each row merges, decided in seq order.

    ``rows`` has seq, the arrays cve, source and url, title and year.  ``round_ups`` is a pattern of URLs that
    many unrelated rows cite; they join only rows of one published record.  ``prior`` is (key, id): the
    published record that held a CVE or source id.  Sets of rows that share no key but a round-up's URL
    cannot meet, so each set is replayed alone; only its keys travel.  Rows without keys stay alone.
    """
    wide = F.filter("url", lambda u: u.rlike(round_ups)) if round_ups else F.array().cast("array<string>")
    slim = rows.select("seq", *(arrays.strings(F.col(k)).alias(k) for k in KINDS[:3]), "title", F.col("year").cast("double").alias("year")).withColumn("wide", wide)
    if prior is not None:
        held = slim.select("seq", F.explode(F.concat("cve", "source")).alias("key")).join(prior.select("key", F.col("id").alias("_prior")), "key")
        slim = slim.join(held.groupBy("seq").agg(F.array_sort(F.collect_set("_prior")).alias("prior")), "seq", "left")
        slim = slim.withColumn("prior", F.coalesce("prior", F.array().cast(slim.schema["prior"].dataType)))
    else:
        slim = slim.withColumn("prior", F.array().cast("array<string>"))
    ties = record_keys(slim.withColumn("url", F.array_except("url", "wide")))
    # Rows of one published record may be joined by a round-up, so they are replayed together.
    ties = ties.unionByName(slim.select("seq", F.lit("prior").alias("kind"), F.explode(F.col("prior").cast("array<string>")).alias("key")))
    tied = linked_sets(ties)
    folded = slim.join(tied, "seq").repartition("root").mapInPandas(_fold_partition, "seq bigint, survivor bigint")
    alone = slim.select("seq").join(tied.select("seq"), "seq", "left_anti").select("seq", F.col("seq").alias("survivor"))
    return folded.unionByName(alone)


def largest_linked_set(rows: DataFrame, round_ups: str | None = None) -> int:
    """Rows of the largest set that ``ordered_merge`` replays in one task; 0 if no rows share a key."""
    wide = F.filter("url", lambda u: u.rlike(round_ups)) if round_ups else F.array().cast("array<string>")
    keys = record_keys(rows.withColumn("url", F.array_except("url", wide)))
    return linked_sets(keys).groupBy("root").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]


def merge_fields(rows: DataFrame, group: str, order: str, union: list[str], first: list[str], best: dict[str, Column]) -> DataFrame:
    """One row per group: sorted unions of arrays, first non-empty values in order, best values by rank.

    All parts are associative, so they run as partial aggregates.
    """
    empty = lambda c: F.col(c).isNull() | (F.col(c).cast("string") == "") if not isinstance(rows.schema[c].dataType, T.ArrayType) else F.size(F.col(c)) == 0
    exploded = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.size(arrays.strings(F.col(c))) > 0, F.array_sort(F.array_distinct(arrays.strings(F.col(c)))))))))
                .alias(c) for c in union]
    firsts = [F.min_by(F.when(~empty(c), F.col(c)), F.when(~empty(c), F.col(order))).alias(c) for c in first]
    bests = [F.max_by(F.col(c), F.struct(rank, -F.col(order))).alias(c) for c, rank in best.items()]
    return rows.groupBy(group).agg(*exploded, *firsts, *bests, F.count("*").alias("merged_rows"))


def allocate_ids(records: DataFrame, prior: DataFrame, next_number: int, prefix: str = "INC-", width: int = 8) -> DataFrame:
    """(seq, id, previous): an id for each record; a known one where its keys had one, else a new number.

    ``records`` is (seq, key), one row per key; ``prior`` is (key, id).  Of several records with claims on
    one id the first in order takes it; ``previous`` are all ids that the record's keys once had.
    """
    claims = records.join(prior, "key", "left").groupBy("seq").agg(F.array_sort(F.collect_set("id")).alias("previous"))
    wish = claims.withColumn("wish", F.array_min("previous"))
    takers = wish.where("wish IS NOT NULL").groupBy("wish").agg(F.min("seq").alias("taker"))
    kept = wish.join(takers.withColumnRenamed("wish", "w"), (F.col("wish") == F.col("w")) & (F.col("seq") == F.col("taker")), "left").select("seq", "previous", F.col("w").alias("id"))
    # New numbers follow seq order: ranks by counting, with one task per range of seq, not one for all.
    fresh = kept.where("id IS NULL").select("seq")
    numbered = ranked(fresh, "seq").select(F.col("seq").alias("s"), F.concat(F.lit(prefix), F.lpad((F.col("rank") + F.lit(next_number)).cast("string"), width, "0")).alias("fresh_id"))
    return kept.join(numbered, F.col("seq") == F.col("s"), "left").select("seq", F.coalesce("id", "fresh_id").alias("id"), "previous")


def ranked(df: DataFrame, column: str, parts: int | None = None) -> DataFrame:
    """The rows with ``rank`` from 0 in the column's order, distinct values assumed; no single-task sort."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = Cut(df.repartitionByRange(parts, column).withColumn("_part", F.spark_partition_id()), "ranked").read()
    sizes = {r[0]: r[1] for r in sorted_rows.groupBy("_part").count().collect()}
    before, offsets = 0, []
    for part in sorted(sizes):
        offsets.append((part, before))
        before += sizes[part]
    if not offsets:
        return sorted_rows.drop("_part").withColumn("rank", F.lit(0).cast("bigint"))
    table = F.broadcast(spark.createDataFrame(offsets, "_part int, _before bigint"))
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    return sorted_rows.withColumn("_place", place).join(table, "_part").withColumn("rank", F.col("_before") + F.col("_place")).drop("_part", "_place", "_before")


def redirects_of(allocated: DataFrame) -> DataFrame:
    """(from, into, reason): ids that records once had and don't have now, to the record that took them over."""
    live = allocated.select(F.col("id").alias("from"))
    lost = allocated.select("id", F.explode("previous").alias("from")).where("id <> from").join(live, "from", "left_anti")
    return lost.groupBy("from").agg(F.array_sort(F.collect_set("id")).alias("into")).withColumn("reason", F.when(F.size("into") > 1, "split").otherwise("merged"))
