"""Histograms, ranks and quality summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def histogram(df: DataFrame, value: Column, start: float, width: float, bins: int) -> DataFrame:
    """bin, n, freq for all bins; the last holds all that lies above."""
    at = F.least(F.lit(bins - 1), F.floor((value - start) / F.lit(float(width))).cast("int"))
    counts = df.select(at.alias("bin")).filter(F.col("bin") >= 0).groupBy("bin").agg(F.count("*").alias("n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = spine.join(counts, "bin", "left").na.fill(0)
    total = out.agg(F.sum("n").alias("total"))
    return out.crossJoin(F.broadcast(total)).select("bin", "n", F.try_divide(F.col("n").cast("double"), F.col("total").cast("double")).alias("freq"))


def scaled_histogram(df: DataFrame, keys: list[str], value: str, low: float, high: float, bins: int) -> DataFrame:
    """keys, bin, n, height: counts in equal bins of [low, high], the last closed; heights scaled to a largest of 1 in each key."""
    v = F.col(value)
    inside = df.filter(v.isNotNull() & (v >= low) & (v <= high))
    counts = inside.groupBy(*keys, F.least(F.lit(bins - 1), F.floor((v - low) * bins / (high - low)).cast("int")).alias("bin")).agg(F.count("*").alias("n"))
    return counts.withColumn("height", F.col("n") / F.max("n").over(Window.partitionBy(*keys)).cast("double"))


def auc(df: DataFrame, score: str, positive: str, keys: list[str]) -> DataFrame:
    """Area under the ROC curve by the rank sum, ties at their mean rank.

    Scores are counted first, so the window runs over distinct scores.
    """
    p = F.col(positive).cast("long")
    counts = df.filter(F.col(score).isNotNull()).groupBy(*keys, score).agg(F.count("*").alias("n"), F.sum(p).alias("pos"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = counts.withColumn("rank", before + (F.col("n") + 1) / F.lit(2.0))
    out = ranked.groupBy(*keys).agg(F.sum(F.col("rank") * F.col("pos")).alias("r"), F.sum("pos").cast("double").alias("np"), F.sum(F.col("n") - F.col("pos")).cast("double").alias("nn"))
    return out.select(*keys, F.try_divide(F.col("r") - F.col("np") * (F.col("np") + 1) / 2, F.col("np") * F.col("nn")).alias("auc"))
