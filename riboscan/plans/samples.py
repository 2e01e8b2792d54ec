"""The supplied tables in the roles of profiling data.

lineitem: return flag R, A, N are the modified, untreated and denatured sample;
line status is the RNA, part key mod 100 the position, a row is a read there,
and a discount over 0.05 is a mutation of class line number. orders: a row is a
read whose interval, flags and quality come from its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riboscan.functions.profile import good_nucleotide, rate, reactivity

SAMPLES = {"R": "modified", "A": "untreated", "N": "denatured"}
LENGTH, MAX_BACKGROUND, MIN_DEPTH = 100, 0.48, 10
PRIMERS = [(10, 29, 150, 169), (100, 119, 260, 279), (200, 219, 380, 399), (300, 319, 470, 489), (400, 419, 590, 609)]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rna, sample, pos, mutated, class: a row per read and position."""
    flag = F.col("l_returnflag")
    sample = F.when(flag == "R", "modified").when(flag == "A", "untreated").when(flag == "N", "denatured")
    return read(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("rna"), sample.alias("sample"), (F.col("l_partkey") % LENGTH).cast("int").alias("pos"), (F.col("l_discount") > 0.05).alias("mutated"), F.col("l_linenumber").alias("class"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rna, pos, nt and each sample's mutations and depth: one aggregation, samples side by side."""
    of = lambda s, c: F.count(F.when((F.col("sample") == s) & c, 1))
    cols = [x for s in SAMPLES.values() for x in (of(s, F.col("mutated")).alias(f"{s}_mutations"), of(s, F.lit(True)).alias(f"{s}_depth"))]
    nt = F.substring(F.lit("ACGU"), F.col("pos") % 4 + 1, 1)
    out = calls(spark, sf_dir).groupBy("rna", "pos").agg(*cols)
    return out.withColumn("nt", F.when(F.col("pos") < 5, F.lower(nt)).otherwise(nt))


def pair(sample: str):
    return F.col(f"{sample}_mutations"), F.col(f"{sample}_depth")


def profile(spark: SparkSession, sf_dir: str, samples: int = 3) -> DataFrame:
    names = list(SAMPLES.values())[:samples]
    value, err = reactivity(*[pair(s) for s in names])
    return wide(spark, sf_dir).select("*", value.alias("reactivity"), err.alias("std_err"))


def hq(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = good_nucleotide(F.col("nt"), rate(*pair("untreated")), [F.col(f"{s}_depth") for s in SAMPLES.values()], MAX_BACKGROUND, MIN_DEPTH)
    return profile(spark, sf_dir).withColumn("hq", F.when(good, F.col("reactivity"))).withColumn("hq_err", F.when(good, F.col("std_err")))


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id, left, right, mapq, reverse, pair: a row per order."""
    o = read(spark, sf_dir, "orders")
    left = (F.col("o_custkey") % 500).cast("int")
    return o.select(F.col("o_orderkey").alias("read_id"), F.expr("o_orderkey DIV 2").alias("pair"), left.alias("left"), (left + 20 + (F.col("o_orderkey") % 130).cast("int")).alias("right"), (F.col("o_custkey") % 60).cast("int").alias("mapq"), (F.col("o_custkey") % 2 == 1).alias("reverse"))


def mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """read_id, left, right: distinct mutated places of an order; the nearest unchanged positions lie at both sides."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("read_id"), (F.col("l_partkey") % 500).cast("int").alias("left")).distinct().withColumn("right", F.col("left") + 2)


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rna, left, right, seq: a variant per line item with a discount over 0.05."""
    li = read(spark, sf_dir, "lineitem").filter("l_discount > 0.05")
    left = (F.col("l_partkey") % LENGTH).cast("int")
    seq = F.substring(F.lit("ACGTACGT"), F.col("l_linenumber"), 2)
    return li.select(F.col("l_linestatus").alias("rna"), left.alias("left"), (left + 1 + F.col("l_linenumber") % 3).cast("int").alias("right"), F.when(F.col("l_linenumber") % 2 == 0, F.lit("")).otherwise(seq).alias("seq"))
