"""Text tables at the ends of the chain: profiles, variants, counts, depths, abundances, histograms, debug reads, input folders."""

from __future__ import annotations

import os
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riboscan.functions.mutations import CLASSES
from riboscan.sources.text import read_profile

SAMPLES = ("Modified", "Untreated", "Denatured")


def decimal(c: Column) -> Column:
    """Six decimals; ``nan`` for null."""
    return F.when(c.isNull(), F.lit("nan")).otherwise(F.format_string("%.6f", c))


def profile_fields(df: DataFrame) -> list[Column]:
    """The fields of a profile's line, named as in its header, from pos, nt, <sample>_mutations, _read_depth, _depth and _rate, reactivity, stderr, hq_profile, hq_stderr and, if there, norm_profile and norm_stderr; what a sample lacks is ``nan``."""
    whole = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("nan")) if c in df.columns else F.lit("nan")
    real = lambda c: decimal(F.col(c).cast("double")) if c in df.columns else F.lit("nan")
    out = [(F.col("pos") + 1).cast("string").alias("Nucleotide"), F.col("nt").alias("Sequence")]
    for s in SAMPLES:
        low = s.lower()
        out += [whole(f"{low}_mutations").alias(f"{s}_mutations"), whole(f"{low}_read_depth").alias(f"{s}_read_depth"), whole(f"{low}_depth").alias(f"{s}_effective_depth"), real(f"{low}_rate").alias(f"{s}_rate")]
    out += [real("reactivity").alias("Reactivity_profile"), real("stderr").alias("Std_err"), real("hq_profile").alias("HQ_profile"), real("hq_stderr").alias("HQ_stderr")]
    if "norm_profile" in df.columns:
        out += [real("norm_profile").alias("Norm_profile"), real("norm_stderr").alias("Norm_stderr")]
    return out


def write_profile(df: DataFrame, path: str) -> None:
    """One target's profile as a tab-separated table with a header, a line per position in order; without norm columns they are left out."""
    fields = profile_fields(df)
    df.orderBy("pos").select(*fields).coalesce(1).write.option("sep", "\t").option("header", True).option("quote", "").csv(path)


def with_norm(df: DataFrame, factors: DataFrame, keys: list[str]) -> DataFrame:
    """Adds norm_profile and norm_stderr from ``factors`` (keys, factor), in place of any that are there; null without a factor."""
    out = df.drop("norm_profile", "norm_stderr").join(factors.select(*keys, F.col("factor").alias("_factor")), keys, "left")
    up = F.col("nt").rlike("^[A-Z]$")
    return out.withColumn("norm_profile", F.when(up, F.try_divide("hq_profile", "_factor"))).withColumn("norm_stderr", F.when(up, F.try_divide("hq_stderr", "_factor"))).drop("_factor")


def empty_columns(df: DataFrame) -> list[str]:
    """Columns without any value: samples that a profile lacks."""
    n = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns]).first()
    return [c for c in df.columns if n[c] == 0]


def read_export(spark: SparkSession, path) -> DataFrame:
    """pos, value, stderr, nt (uppercase) of a profile table: its norm columns, or the others where it has none."""
    t = read_profile(spark, path)
    kind = ("Norm_profile", "Norm_stderr") if "Norm_profile" in t.columns else ("HQ_profile", "HQ_stderr")
    return t.select((F.col("Nucleotide").cast("int") - 1).alias("pos"), F.col(kind[0]).alias("value"), F.col(kind[1]).alias("stderr"), F.upper("Sequence").alias("nt"))


def variant_lines(variants: DataFrame, depths: DataFrame) -> DataFrame:
    """rna, pos, line: a place's depth and, in brackets, the variants (rna, left, right, seq, n) whose first changed place it is, in order."""
    one = F.concat(F.lit("("), F.col("left").cast("string"), F.lit("-"), F.col("right").cast("string"), F.lit(', "'), "seq", F.lit('", '), F.col("n").cast("string"), F.lit(")"))
    own = variants.withColumn("_one", one).groupBy("rna", F.col("left").alias("pos")).agg(F.array_sort(F.collect_list(F.struct("left", "right", "seq", "_one"))).alias("v"))
    text = F.coalesce(F.array_join(F.col("v._one"), ""), F.lit(""))
    return depths.join(own, ["rna", "pos"], "left").select("rna", "pos", F.concat(F.col("depth").cast("string"), F.lit(" "), text).alias("line"))


def write_variants(lines: DataFrame, path: str) -> None:
    """One target's ``variant_lines`` as text, in order of position."""
    lines.orderBy("pos").select("line").coalesce(1).write.text(path)


def variants_of(line: str) -> Column:
    """Array of (left, right, seq, n) of a line; a line that isn't made of a depth and bracketed variants is an error."""
    good = F.col(line).rlike(r'^\d+ ?(\(-?\d+--?\d+, "[^"]*", \d+\) ?)*$')
    text = F.when(good, F.col(line)).otherwise(F.raise_error(F.concat(F.lit("malformed variant line: "), F.col(line))))
    part = lambda i: F.regexp_extract_all(text, F.lit(r'\((-?\d+)-(-?\d+), "([^"]*)", (\d+)\)'), F.lit(i))
    return F.transform(F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("c"), part(4).alias("d")), lambda x: F.struct(x["a"].cast("int").alias("left"), x["b"].cast("int").alias("right"), x["c"].alias("seq"), x["d"].cast("long").alias("n")))


def read_variants(spark: SparkSession, path) -> DataFrame:
    """left, right, seq, n, a row per variant."""
    return spark.read.text(path).filter(F.trim("value") != "").select(F.explode(variants_of("value")).alias("v")).select("v.*")


def read_counts(spark: SparkSession, path) -> DataFrame:
    """A count table's columns as numbers and ``mutations``, the sum of its classes; a missing class or depth is an error."""
    t = spark.read.option("sep", "\t").option("header", True).csv(path)
    if lacking := [c for c in (*CLASSES, "read_depth", "effective_depth") if c not in t.columns]:
        raise ValueError(f"columns missing in {path}: {lacking}")
    t = t.select(*[F.col(f"`{c}`").cast("long").alias(c) for c in t.columns])
    return t.withColumn("mutations", reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in CLASSES]))


def read_mapped_depths(spark: SparkSession, path) -> DataFrame:
    """pos, sample, kind (``included``, ``pair_<i>``, ``off_target``, ``low_mapq``), depth: the mapped depths of a profile table, by the names of its columns."""
    t = read_profile(spark, path)
    rows = []
    for c in t.columns:
        if m := re.fullmatch(r"(Modified|Untreated|Denatured)_(?:(off_target|low_mapq)_|primer_pair_(\d+)_)?mapped_depth", c):
            kind = m[2] or (f"pair_{m[3]}" if m[3] else "included")
            rows.append(F.struct(F.lit(m[1].lower()).alias("sample"), F.lit(kind).alias("kind"), F.col(f"`{c}`").cast("long").alias("depth")))
    if not rows:
        raise ValueError(f"no mapped depths in {path}")
    return t.select((F.col("Nucleotide").cast("int") - 1).alias("pos"), F.explode(F.array(*rows)).alias("d")).select("pos", "d.*")


def abundance_lines(depths: DataFrame) -> DataFrame:
    """sample, idx, line of the largest depth (sample, idx, fw_seq, fw_left, fw_right, rv_seq, rv_left, rv_right, max_depth) near each primer pair."""
    name = F.concat(F.lit("Primer_pair_"), (F.col("idx") + 1).cast("string"))
    return depths.select("sample", "idx", F.concat_ws("\t", name, "fw_seq", *[F.col(c).cast("string") for c in ("fw_left", "fw_right")], "rv_seq", *[F.col(c).cast("string") for c in ("rv_left", "rv_right", "max_depth")]).alias("line"))


def histogram_lines(table: DataFrame, start: int, width: int, bins: int, ranges: bool = False) -> DataFrame:
    """bin, line of a histogram table (bin, freq): its left end, or its range, and its frequency."""
    left = F.col("bin") * width + start
    label = left.cast("string")
    if ranges:
        label = F.when(F.col("bin") < bins - 1, F.concat(F.lit("["), label, F.lit(","), (left + width - 1).cast("string"), F.lit("]"))).otherwise(F.concat(F.lit(">="), label))
    return table.select("bin", F.concat_ws("\t", label, F.format_string("%.6f", "freq")).alias("line"))


def write_lengths(targets: DataFrame, path: str) -> None:
    """Names and lengths of targets (name, len), tab-separated."""
    targets.orderBy("name").select(F.concat_ws("\t", "name", F.col("len").cast("string"))).coalesce(1).write.text(path)


def read_debug(spark: SparkSession, path) -> DataFrame:
    """read_type, left, right, reverse, category, primer, seq, qual of the lines marked [read]; empty types and pairs are null."""
    f = F.split("value", "\t")
    at = lambda i: F.get(F.col("f"), F.lit(i))
    rows = spark.read.text(path).filter(F.col("value").startswith("[read]")).select(f.alias("f"))
    return rows.select(F.nullif(at(1), F.lit("")).alias("read_type"), at(2).cast("int").alias("left"), at(3).cast("int").alias("right"), F.when(at(4) == "+", False).when(at(4) == "-", True).alias("reverse"), at(5).alias("category"), F.nullif(at(6).cast("int"), F.lit(-999)).alias("primer"), at(7).alias("seq"), at(8).alias("qual"))


FASTQ = (".fastq", ".fq", ".fastq.gz")


def unpaired_files(names: list[str]) -> list[str]:
    """The read files among ``names``, in order; none is an error."""
    found = sorted(n for n in names if n.endswith(FASTQ))
    if not found:
        raise ValueError("no reads")
    return found


def paired_files(names: list[str]) -> list[tuple[str, str]]:
    """Files of first and second mates: R1 and R2 stand alone between ``_`` or ``.`` in names that differ in one letter at most."""
    mates: dict[str, list[str]] = {"R1": [], "R2": []}
    for n in unpaired_files(names):
        fields = os.path.splitext(n)[0].replace(".", "_").split("_")
        mate = next((m for m in mates if m in fields or m.lower() in fields), None)
        if mate is None:
            raise ValueError(f"neither R1 nor R2: {n}")
        mates[mate].append(n)
    if len(mates["R1"]) != len(mates["R2"]):
        raise ValueError("numbers of R1 and R2 files differ")
    pairs = list(zip(*mates.values(), strict=True))
    for a, b in pairs:
        if len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) > 1:
            raise ValueError(f"no pair: {a}, {b}")
    return pairs
