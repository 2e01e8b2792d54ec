"""Amplicon primers: off-target reads, depths by pair, files of primers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riboscan.operators.depth import coverage
from riboscan.operators.reads import nearest_primer


def off_target_pair(fw: Column, rv: Column, need_fw: bool = True, need_rv: bool = True) -> Column:
    """Pairs: with both primers needed only different ones are off target (two missing ones are equal); else the needed one is missing."""
    if need_fw and need_rv:
        return ~fw.eqNullSafe(rv)
    return fw.isNull() if need_fw else rv.isNull() if need_rv else F.lit(False)


def off_target_mate(fw: Column, rv: Column, reverse: Column, need_fw: bool = True, need_rv: bool = True) -> Column:
    """A mate left alone: a forward read needs its forward primer only, a reverse one its reverse primer."""
    return F.when(reverse, rv.isNull() if need_rv else F.lit(False)).otherwise(fw.isNull() if need_fw else F.lit(False))


def with_primers(reads: DataFrame, primers: Column, offset: int = 10, need_fw: bool = True, need_rv: bool = True) -> DataFrame:
    """Rows of ``functions.reads.pair_mates`` with ``primer`` (index), ``primers`` (its places) and OFF_TARGET reads told apart.

    A fragment's ends are its mates' outer ends. Reads of low mapping quality
    stay LOW_MAPQ.
    """
    end = lambda left, cigar: F.expr(f"{left} + aggregate(transform(regexp_extract_all({cigar}, '([0-9]+)[MDNP=X]', 1), x -> cast(x AS int)), 0, (a, x) -> a + x) - 1")
    first = F.least("left", F.coalesce("left2", "left"))
    last = F.greatest(end("left", "cigar"), F.coalesce(end("left2", "cigar2"), F.lit(-1)))
    x = reads.drop("primer", "primers").withColumn("_fw", nearest_primer(first, primers, "fw_left", offset)).withColumn("_rv", nearest_primer(last, primers, "rv_right", offset))
    fw, rv = F.col("_fw"), F.col("_rv")
    single = F.lit(False)
    if need_fw:
        single = single | fw.isNull()
    if need_rv:
        single = single | rv.isNull()
    if need_fw and need_rv:
        single = single | F.coalesce(fw != rv, F.lit(False))
    off = F.when(F.col("left2").isNotNull(), off_target_pair(fw, rv, need_fw, need_rv)).when(F.col("read_type") == "MERGED", single).otherwise(off_target_mate(fw, rv, F.col("reverse"), need_fw, need_rv))
    x = x.withColumn("category", F.when((F.col("category") == "INCLUDED") & off, "OFF_TARGET").otherwise(F.col("category")))
    index = F.when(F.col("category") == "INCLUDED", F.coalesce(fw, rv))
    x = x.withColumn("primer", index.cast("int"))
    one = F.element_at(F.filter(primers, lambda p: p["idx"] == F.col("primer")), 1)
    places = F.when(F.col("primer").isNotNull(), F.array(*[one[c].cast("int") for c in ("fw_left", "fw_right", "rv_left", "rv_right")]))
    return x.withColumn("primers", places).drop("_fw", "_rv")


def depth_label(category: Column, primer: Column) -> Column:
    """The mapped depth that a read counts for: by why it is left out, else by its pair (from 1), else plain."""
    pair = F.concat(F.lit("primer_pair_"), (primer + 1).cast("string"), F.lit("_mapped_depth"))
    return F.when(category == "OFF_TARGET", "off_target_mapped_depth").when(category == "LOW_MAPQ", "low_mapq_mapped_depth").when(primer.isNotNull(), pair).otherwise("mapped_depth")


def mapped_depths(reads: DataFrame, keys: list[str], pairs: int) -> DataFrame:
    """keys, pos and a column for each label of (left, right, category, primer); zeros filled."""
    names = ["mapped_depth", *[f"primer_pair_{i + 1}_mapped_depth" for i in range(pairs)], "off_target_mapped_depth", "low_mapq_mapped_depth"]
    long = coverage(reads.withColumn("_label", depth_label(F.col("category"), F.col("primer"))), [*keys, "_label"])
    return long.groupBy(*keys, "pos").agg(*[F.coalesce(F.sum(F.when(F.col("_label") == n, F.col("depth"))), F.lit(0)).alias(n) for n in names])


def repeated_pairs(primers: DataFrame) -> DataFrame:
    """rna, fw_seq, rv_seq, n of primer pairs that a target has more than once."""
    return primers.groupBy("rna", "fw_seq", "rv_seq").agg(F.count("*").alias("n")).filter("n > 1")


def inside_amplicon(pos: Column, fw_right: Column, rv_left: Column) -> Column:
    return (fw_right < pos) & (pos < rv_left)


def present_samples(df: DataFrame, depths: list[str]) -> DataFrame:
    """sample, present: whether a sample's depth columns sum to more than 0."""
    total = F.lit(0)
    for d in depths:
        total = total + F.coalesce(F.col(d), F.lit(0))
    return df.groupBy("sample").agg((F.sum(total) > 0).alias("present"))


def primer_lines(primers: DataFrame) -> DataFrame:
    """rna, idx, text: two lines a pair, its sequences and its places."""
    text = F.concat_ws("\n", F.concat_ws(" ", "fw_seq", "rv_seq"), F.concat_ws(" ", *[F.col(c).cast("string") for c in ("fw_left", "fw_right", "rv_left", "rv_right")]))
    return primers.select("rna", "idx", text.alias("text"))


def write_primers(primers: DataFrame, path: str) -> None:
    """A file of primer places: ``>`` and the target's name, then its pairs in order. Targets' pairs are few."""
    body = primer_lines(primers).groupBy("rna").agg(F.array_sort(F.collect_list(F.struct("idx", "text"))).alias("p"))
    body.orderBy("rna").select(F.concat(F.lit(">"), "rna", F.lit("\n"), F.array_join(F.col("p.text"), "\n"))).coalesce(1).write.text(path)


def _sections(spark: SparkSession, path) -> DataFrame:
    """rna ('' before the first header) and ``line``, in order, of files of sections that begin with ``>``; primer files are small."""
    whole = spark.read.text(path, wholetext=True).select(F.concat(F.lit("\n"), F.regexp_replace("value", "\r\n?", "\n")).alias("v"))
    parts = whole.select(F.posexplode(F.split("v", "\n>")).alias("s", "v"))
    lines = parts.select(F.when(F.col("s") == 0, "").otherwise(F.trim(F.regexp_extract("v", "^([^\n]*)", 1))).alias("rna"), F.when(F.col("s") == 0, F.col("v")).otherwise(F.regexp_replace("v", "^[^\n]*", "")).alias("v"))
    return lines.select("rna", F.posexplode(F.split("v", "\n")).alias("line", "v")).filter(F.trim("v") != "")


def read_primer_sequences(spark: SparkSession, path) -> DataFrame:
    """rna, idx, fw_seq, rv_seq; pairs before any header have the rna '' and are for all targets. A line without two words is an error."""
    f = F.split(F.trim("v"), r"\s+")
    rows = _sections(spark, path).withColumn("f", F.when(F.size(f) == 2, f).otherwise(F.raise_error(F.concat(F.lit("no primer pair: "), "v"))))
    number = F.expr("row_number() OVER (PARTITION BY rna ORDER BY line) - 1")
    return rows.select("rna", number.cast("int").alias("idx"), F.upper(F.col("f")[0]).alias("fw_seq"), F.upper(F.col("f")[1]).alias("rv_seq"))


def read_primer_places(spark: SparkSession, path) -> DataFrame:
    """rna, idx, fw_left, fw_right, rv_left, rv_right of the lines of numbers; a line without four is an error."""
    rows = _sections(spark, path).filter(F.trim("v").rlike("^-?[0-9]"))
    f = F.split(F.trim("v"), r"\s+")
    rows = rows.withColumn("f", F.when(F.size(f) == 4, f).otherwise(F.raise_error(F.concat(F.lit("no primer places: "), "v"))))
    number = F.expr("row_number() OVER (PARTITION BY rna ORDER BY line) - 1")
    return rows.select("rna", number.cast("int").alias("idx"), *[F.col("f")[i].cast("int").alias(c) for i, c in enumerate(("fw_left", "fw_right", "rv_left", "rv_right"))])
