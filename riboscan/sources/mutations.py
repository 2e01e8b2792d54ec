"""Parsed-mutation records and count tables as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for no primer pair in the text.
NO_PRIMER = -999


def _bits(c: str) -> Column:
    return F.array_join(F.transform(c, lambda b: b.cast("int").cast("string")), "")


def ga_records(records: DataFrame) -> DataFrame:
    """The G-to-A channel of ``dms`` records, as records of their own."""
    return records.select(*[F.col(f"{c}_ga").alias(c) if f"{c}_ga" in records.columns else F.col(c) for c in records.columns if not c.endswith("_ga")])


def write_mutations(records: DataFrame, path: str) -> None:
    """Ten tab-separated fields a line (``functions.reads.RECORD`` but for rna); an ambiguous mutation's class ends in ``_ambig``."""
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    one = lambda m: F.concat_ws(" ", m["left"].cast("string"), m["right"].cast("string"), quoted(m["seq"]), quoted(m["qual"]), quoted(F.concat(m["tag"], F.when(m["ambig"], "_ambig").otherwise(""))))
    line = F.concat_ws("\t", "read_type", "read_id", F.col("left").cast("string"), F.col("right").cast("string"), "category", F.coalesce("primer", F.lit(NO_PRIMER)).cast("string"), _bits("mapped_depth"), _bits("depth"), _bits("count"), F.array_join(F.transform("mutations", one), " "))
    records.select(line).write.text(path)


def read_mutations(spark: SparkSession, path) -> DataFrame:
    """The records of ``write_mutations``, without rna; a line with fewer than ten fields or a broken mutation list is an error.

    Qualities may hold quotes and blanks don't occur in them, so the list is split at blanks.
    """
    f = F.split("value", "\t")
    lines = spark.read.text(path).filter(F.trim("value") != "")
    lines = lines.select(F.when(F.size(f) >= 10, f).otherwise(F.raise_error(F.concat(F.lit("short mutation line: "), "value"))).alias("f"))
    at = lambda i: F.col("f")[i]
    bits = lambda i: F.transform(F.filter(F.split(at(i), ""), lambda c: c != ""), lambda c: c == "1")
    parts = lines.withColumn("_p", F.when(at(9) == "", F.array().cast("array<string>")).otherwise(F.split(at(9), " ")))
    whole = F.when(F.size("_p") % 5 == 0, (F.size("_p") / 5).cast("int")).otherwise(F.raise_error(F.concat(F.lit("broken mutation list: "), at(9))).cast("int"))
    bare = lambda c: F.substring(c, F.lit(2), F.length(c) - 2)
    p = lambda i, k: F.get(F.col("_p"), i * 5 + k)
    one = lambda i: F.struct(p(i, 0).cast("int").alias("left"), p(i, 1).cast("int").alias("right"), bare(p(i, 2)).alias("seq"), bare(p(i, 3)).alias("qual"), F.regexp_replace(bare(p(i, 4)), "_ambig$", "").alias("tag"), bare(p(i, 4)).endswith("_ambig").alias("ambig"))
    found = F.transform(F.filter(F.sequence(F.lit(0), F.greatest(whole, F.lit(1)) - 1), lambda i: i * 5 < F.size("_p")), one)
    return parts.select(at(0).alias("read_type"), at(1).alias("read_id"), at(2).cast("int").alias("left"), at(3).cast("int").alias("right"), at(4).alias("category"), F.nullif(at(5).cast("int"), F.lit(NO_PRIMER)).alias("primer"), bits(6).alias("mapped_depth"), bits(7).alias("depth"), bits(8).alias("count"), found.alias("mutations"))


def write_counts(counts: DataFrame, path: str) -> None:
    """A table of one target and sample with a header, a line per position in order; ``pos`` orders the lines and isn't written."""
    names = [c for c in counts.columns if c != "pos"]
    counts.orderBy("pos").select(names).coalesce(1).write.option("sep", "\t").option("header", True).csv(path)
