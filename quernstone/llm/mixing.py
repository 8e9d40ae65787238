"""Mixing sources to target weights by Poisson replication.

Each text is used as often as a Poisson variable says, drawn by inverting its distribution at a hash of
seed, mix and text; the mean is such that the source reaches its share, given the cap on repeats.  The
draws need no shuffle; a last sort by hash mixes all sources.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.tokens import VOCABULARY, token_counts
from quernstone.plans.lineage import cut


def _chances(rate: float, most: int) -> list[float]:
    """P(Poisson(rate) = k) for k below ``most``, by logarithms, so that no rate is too large."""
    return [math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) for k in range(most)]


def capped_mean(rate: float, most: int) -> float:
    """Mean of min(Poisson(rate), most)."""
    chances = _chances(rate, most) if rate > 0 else [1.0] * min(most, 1)
    return sum(k * p for k, p in enumerate(chances)) + most * max(0.0, 1 - sum(chances))


def thresholds(mean: float, most: int) -> list[float]:
    """t[0] <= t[1] <= ... of which a uniform draw exceeds as many as there are copies, ``mean`` on average.

    A mean at or above the cap gives the cap for every draw.
    """
    if most <= 0 or mean <= 0:
        return []
    if mean >= most * (1 - 1e-9):
        return [0.0] * most
    low, high = 0.0, 1.0
    while capped_mean(high, most) < mean:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if capped_mean(middle, most) < mean else (low, middle)
    return [min(x, 1.0) for x in itertools.accumulate(_chances(high, most))]


def plan_mix(targets: list[tuple[str, float, int]], available: dict[str, int], total: float | None = None) -> dict[str, tuple[float, list[float]]]:
    """source -> (mean copies of a text, thresholds).

    Without ``total`` the mix is as large as it can be with every source that has tokens at its share and
    drawn at a Poisson rate of at most its cap.  With one, a source that can't reach its share even so is
    used up to its cap.
    """
    usable = [(s, w, r) for s, w, r in targets if w > 0 and r > 0 and available.get(s, 0) > 0]
    if not usable:
        return {}
    size = total if total is not None else min(capped_mean(r, r) * available[s] / w for s, w, r in usable)
    return {s: (min(w * size / available[s], float(r)), thresholds(min(w * size / available[s], float(r)), r)) for s, w, r in usable}


class Mix:
    """``draws`` (mix_name, source, id, copy, tokens, place) and the ``shares`` really reached."""

    def __init__(self, draws: DataFrame, shares: DataFrame) -> None:
        self.draws, self.shares = draws, shares


def mix_sources(
    df: DataFrame,
    targets: DataFrame,
    id_column: str,
    text_column: str,
    source_column: str,
    seed: int = 7,
    total_tokens: float | str | None = None,
    vocabulary: str = VOCABULARY,
) -> Mix:
    """Draws each mix of ``targets`` (mix_name, source, target_share, max_repeats) from the texts.

    A text is used at most ``max_repeats`` times in a mix.  Sources without tokens are reported with a
    share of 0; the others share the mix in their targets' proportion.  With ``total_tokens`` (a number, or
    "all" for as many as the texts have) the mix aims at that size instead of the largest one with all
    shares reached, and sources at their cap fall short.
    Null sources and texts of no tokens are never drawn; repeated rows are texts of their own; other
    columns are ignored, whatever their names.
    """
    spark = df.sparkSession
    sized = cut(token_counts(df, [F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source")], text_column, vocabulary), "tokens").where("source IS NOT NULL AND tokens > 0")
    # Targets are a configuration: a row for each mix and source in it.
    rows = [(str(r[0]), str(r[1]), float(r[2]), int(r[3])) for r in targets.select("mix_name", "source", "target_share", "max_repeats").dropna().collect()]
    named = spark.createDataFrame([(s,) for s in sorted({r[1] for r in rows})], "source string")
    available = {r[0]: r[1] for r in sized.join(F.broadcast(named), "source", "left_semi").groupBy("source").agg(F.sum("tokens")).collect()}
    if total_tokens == "all":
        total_tokens = float(sized.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0])
    plans = []
    for mix in sorted({r[0] for r in rows}):
        own = [(s, w, m) for name, s, w, m in rows if name == mix]
        plans += [(mix, s, mean, steps) for s, (mean, steps) in plan_mix(own, available, total_tokens).items()]
    plan = spark.createDataFrame(plans, "mix_name string, source string, mean_copies double, steps array<double>")
    uniform = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "mix_name", "id", "tokens"), 11) / F.lit(float(1 << 53))
    copies = sized.join(F.broadcast(plan), "source").withColumn("u", uniform).withColumn("copies", F.size(F.filter("steps", lambda t: F.col("u") >= t)))
    drawn = copies.where("copies > 0").select("mix_name", "source", "id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "tokens")
    place = F.xxhash64(F.lit(seed + 1), "mix_name", "id", "copy")
    draws = drawn.withColumn("place", place).orderBy("mix_name", "place", "id", "copy")
    sums = copies.groupBy("mix_name", "source").agg(F.sum(F.col("copies") * F.col("tokens")).alias("tokens"), F.max("copies").alias("most_repeats"))
    whole = sums.groupBy("mix_name").agg(F.sum("tokens").alias("mix_tokens"))
    target = spark.createDataFrame([(m, s, w, r) for m, s, w, r in rows], "mix_name string, source string, target_share double, max_repeats int")
    shares = target.join(sums, ["mix_name", "source"], "left").join(whole, "mix_name", "left")
    shares = shares.select("mix_name", "source", "target_share", "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.coalesce(F.col("tokens") / F.nullif(F.col("mix_tokens"), F.lit(0)), F.lit(0.0)).alias("actual_share"))
    return Mix(draws, shares)
