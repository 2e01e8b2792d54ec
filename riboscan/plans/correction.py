"""Targets corrected by the variants that most of their reads show."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riboscan.operators.depth import coverage
from riboscan.operators.reads import merge_adjacent
from riboscan.operators.targets import correct_sequence
from riboscan.plans.profiling import runs


def count_variants(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rna, left, right, seq, n) of all records' mutations, whatever their category, and (rna, pos, depth) of their effective depths."""
    found = records.select("rna", F.explode("mutations").alias("m")).groupBy("rna", F.col("m.left").alias("left"), F.col("m.right").alias("right"), F.col("m.seq").alias("seq")).agg(F.count("*").alias("n"))
    return found, coverage(runs(records, "depth"), ["rna"])


def keep_variants(variants: DataFrame, depths: DataFrame, min_depth: int = 50, min_freq: float = 0.6, longest: int = 1000) -> DataFrame:
    """Variants with the depth at their ends (the lower one), freq and status: ``keep``, or ``warn`` from a frequency of 0.1 on.

    A place before the target's first base has the depth of its last covered one.
    """
    last = depths.groupBy("rna").agg(F.max_by("depth", "pos").alias("depth")).select("rna", F.lit(-1).alias("pos"), "depth")
    at = depths.unionByName(last)
    x = variants.join(at.select("rna", F.col("pos").alias("left"), F.col("depth").alias("_dl")), ["rna", "left"]).join(at.select("rna", F.col("pos").alias("right"), F.col("depth").alias("_dr")), ["rna", "right"])
    x = x.withColumn("depth", F.least("_dl", "_dr")).withColumn("freq", F.try_divide(F.col("n").cast("double"), F.col("depth").cast("double")))
    good = (F.col("right") - F.col("left") - 1 <= longest) & (F.length("seq") <= longest) & (F.col("depth") >= min_depth) & (F.col("freq") >= 0.1)
    return x.filter(good).select("rna", "left", "right", "seq", "n", "depth", "freq", F.when(F.col("freq") >= min_freq, "keep").otherwise("warn").alias("status"))


def corrected_targets(records: DataFrame, targets: DataFrame, min_depth: int = 50, min_freq: float = 0.6) -> DataFrame:
    """rna, seq, n_corrections of targets (rna, seq), from records of ``process_reads`` with ``variant``.

    Of variants with one left end the most frequent stays.
    """
    kept = keep_variants(*count_variants(records), min_depth, min_freq).filter("status = 'keep'")
    first = F.row_number().over(Window.partitionBy("rna", "left").orderBy(F.desc("freq"), "right", "seq"))
    best = kept.withColumn("_k", first).filter("_k = 1").drop("_k")
    return correct_sequence(targets, merge_adjacent(best, ["rna"]))


def joined_targets(parts: list[DataFrame]) -> DataFrame:
    """Corrected targets of several runs in one table."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
