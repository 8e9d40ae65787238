"""Estimates from stratified samples: Wilson intervals, design weights, Kish's effective size, confusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The 97.5th percentile of the normal distribution.
Z95 = 1.959963984540054


def wilson(p: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """Bounds of the Wilson score interval for a share p of n, within 0 and 1; null where n is 0."""
    z2 = z * z
    middle = (p + z2 / (2 * n)) / (1 + z2 / n)
    half = z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    some = n > 0
    return F.when(some, F.greatest(F.lit(0.0), middle - half)), F.when(some, F.least(F.lit(1.0), middle + half))


def stratified(sample: DataFrame, populations: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Estimates of a share from a stratified sample, whole or for each value of ``by``.

    ``sample`` has stratum and y (0, 1 or null for undecided, which is left out); ``populations`` has
    stratum and size.  Each stratum's mean counts by its population; strata without a decided row are
    reported as unrepresented, not guessed.  The interval uses Kish's effective size of the weights.
    """
    by = by or []
    decided = sample.where("y IS NOT NULL").groupBy(*by, "stratum").agg(F.count("*").cast("double").alias("n"), F.sum(F.col("y").cast("double")).alias("hits"))
    weighted = decided.join(F.broadcast(populations.select("stratum", F.col("size").cast("double").alias("size"))), "stratum")
    w = F.col("size") / F.col("n")
    totals = weighted.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum(w * F.col("hits")).alias("weighted_hits"),
        F.sum("size").alias("population"),
        (F.pow(F.sum(w * F.col("n")), F.lit(2.0)) / F.sum(w * w * F.col("n"))).alias("effective_n"),
        F.count("*").alias("strata"),
    )
    p = F.col("weighted_hits") / F.col("population")
    low, high = wilson(p, F.col("effective_n"))
    return totals.select(*by, "strata", F.col("n").cast("bigint").alias("n"), "population", "effective_n", p.alias("estimate"), low.alias("low"), high.alias("high"))


def unrepresented(sample: DataFrame, populations: DataFrame) -> DataFrame:
    """Strata with a population but no decided row."""
    return populations.join(sample.where("y IS NOT NULL").select("stratum").distinct(), "stratum", "left_anti")


def confusion(df: DataFrame, predicted: Column, actual: Column, by: list[str] | None = None) -> DataFrame:
    """True and false positives and negatives, precision and recall with their intervals."""
    by = by or []
    t = df.select(*by, predicted.alias("p"), actual.alias("a")).groupBy(*by).agg(
        F.count_if(F.col("p") & F.col("a")).alias("tp"), F.count_if(F.col("p") & ~F.col("a")).alias("fp"), F.count_if(~F.col("p") & F.col("a")).alias("fn"), F.count_if(~F.col("p") & ~F.col("a")).alias("tn")
    )
    out = [*by, "tp", "fp", "fn", "tn"]
    for name, whole in (("precision", F.col("tp") + F.col("fp")), ("recall", F.col("tp") + F.col("fn"))):
        share = F.when(whole > 0, F.col("tp") / whole)
        low, high = wilson(share, whole.cast("double"))
        out += [share.alias(name), low.alias(f"{name}_low"), high.alias(f"{name}_high")]
    return t.select(*out)
