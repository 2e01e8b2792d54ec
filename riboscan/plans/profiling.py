"""From mutation records of up to three samples to normalised profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riboscan.functions.mutations import CLASSES
from riboscan.functions.profile import good_nucleotide, rate, rate_stderr, reactivity
from riboscan.functions.reads import pair_mates, process_reads
from riboscan.operators.depth import coverage
from riboscan.operators.normalize import boxplot_factor
from riboscan.sources.text import read_sam

#: In this order; the first is needed, the third needs the second.
SAMPLES = ("modified", "untreated", "denatured")
DEPTHS = ("read_depth", "effective_depth", "off_target_mapped_depth", "low_mapq_mapped_depth", "mapped_depth")


def runs(records: DataFrame, bits: str) -> DataFrame:
    """rna, left, right of each run of set places in an array that begins at the record's ``left``; one row a run, not a base."""
    at = lambda i: F.coalesce(F.get(F.col(bits), i), F.lit(False))
    places = F.when(F.size(bits) > 0, F.sequence(F.lit(0), F.size(bits) - 1)).otherwise(F.array().cast("array<int>"))
    first, last = F.filter(places, lambda i: at(i) & ~at(i - 1)), F.filter(places, lambda i: at(i) & ~at(i + 1))
    return records.select("rna", F.col("left").alias("_at"), F.explode(F.arrays_zip(first.alias("a"), last.alias("b"))).alias("r")).select("rna", (F.col("_at") + F.col("r.a")).alias("left"), (F.col("_at") + F.col("r.b")).alias("right"))


def count_records(records: DataFrame, targets: DataFrame) -> DataFrame:
    """rna, pos, a column per class and five depths, for each place of each target (rna, seq); zeros filled.

    A mutation counts at its last changed place. Classes and the read and
    effective depths are of INCLUDED records; the read depth covers the gap
    between mates, the mapped depths don't. Counts are summed before each
    shuffle, and depths are differences of runs.
    """
    good = records.filter("category = 'INCLUDED'")
    found = good.select("rna", F.explode("mutations").alias("m")).select("rna", (F.col("m.right") - 1).alias("pos"), F.col("m.tag").alias("tag"))
    tables = [found.groupBy("rna", "pos").agg(*[F.count(F.when(F.col("tag") == t, 1)).alias(t) for t in CLASSES])]
    spans = [good.select("rna", "left", "right"), runs(good, "depth"), *[runs(records.filter(F.col("category") == c), "mapped_depth") for c in ("OFF_TARGET", "LOW_MAPQ", "INCLUDED")]]
    tagged = reduce(DataFrame.union, [s.withColumn("_kind", F.lit(k)) for k, s in zip(DEPTHS, spans, strict=True)])
    depth = coverage(tagged, ["rna", "_kind"])
    tables.append(depth.groupBy("rna", "pos").agg(*[F.sum(F.when(F.col("_kind") == k, F.col("depth"))).alias(k) for k in DEPTHS]))
    spine = targets.filter(F.length("seq") > 0).select("rna", F.explode(F.sequence(F.lit(0), F.length("seq") - 1)).alias("pos"))
    return reduce(lambda a, b: a.join(b, ["rna", "pos"], "left"), tables, spine).na.fill(0)


def profile(counts: dict[str, DataFrame], targets: DataFrame, max_background: float = 0.05, min_depth: int = 5000, pooled: bool = True) -> DataFrame:
    """rna, pos, nt, mutations, depth and rate of each sample, reactivity, its error, both where the place is good, and both normalised.

    ``counts`` has tables of ``count_records`` by sample. One factor serves
    all targets if ``pooled``, else one each; without a factor the normalised
    columns are null.
    """
    if not counts or set(counts) != set(SAMPLES[: len(counts)]):
        raise ValueError("samples are modified, then untreated, then denatured")
    names = SAMPLES[: len(counts)]
    total = reduce(lambda a, b: a + b, [F.col(f"`{t}`") for t in CLASSES])
    # one row per place and sample, then one per place: no join of the samples
    rows = reduce(DataFrame.union, [counts[s].select("rna", "pos", F.lit(s).alias("_s"), total.alias("m"), F.col("effective_depth").alias("d")) for s in names])
    wide = rows.groupBy("rna", "pos").agg(*[F.sum(F.when(F.col("_s") == s, F.col(c))).alias(f"{s}_{n}") for s in names for c, n in (("m", "mutations"), ("d", "depth"))])
    bases = targets.select("rna", F.posexplode(F.filter(F.split("seq", ""), lambda c: c != "")).alias("pos", "nt")).withColumn("nt", F.translate("nt", "Tt", "Uu"))
    x = bases.join(wide, ["rna", "pos"])
    pairs = {s: (F.col(f"{s}_mutations"), F.col(f"{s}_depth")) for s in names}
    value, error = reactivity(*pairs.values())
    x = x.select("*", *[f(*p).alias(f"{s}_{n}") for s, p in pairs.items() for f, n in ((rate, "rate"), (rate_stderr, "stderr"))], value.alias("reactivity"), error.alias("stderr"))
    fit = good_nucleotide(F.col("nt"), F.col("untreated_rate") if "untreated" in names else None, [F.col(f"{s}_depth") for s in names], max_background, min_depth) & F.col("reactivity").isNotNull()
    x = x.select("*", F.when(fit, F.col("reactivity")).alias("hq_profile"), F.when(fit, F.col("stderr")).alias("hq_stderr"))
    factor = boxplot_factor(x, "hq_profile", [] if pooled else ["rna"]).drop("n")
    x = x.join(F.broadcast(factor), F.lit(True), "left") if pooled else x.join(factor, "rna", "left")  # pooled: a single row
    return x.select("*", F.try_divide("hq_profile", "factor").alias("norm_profile"), F.try_divide("hq_stderr", "factor").alias("norm_stderr")).drop("factor")


def from_sam(spark: SparkSession, paths: dict[str, str], targets: DataFrame, min_mapq: int = 10, max_background: float = 0.05, min_depth: int = 5000, pooled: bool = True, **steps) -> DataFrame:
    """The profile of alignments by sample; ``steps`` go to ``process_reads``."""
    records = {s: process_reads(pair_mates(read_sam(spark, p, min_mapq)), **steps) for s, p in paths.items()}
    return profile({s: count_records(r, targets) for s, r in records.items()}, targets, max_background, min_depth, pooled)
