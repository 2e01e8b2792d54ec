"""Readers and writers of the text formats: FASTA, FASTQ, SAM, counts and profiles, ``.shape`` and ``.map``."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riboscan.functions.sequence import read_type, right_target_pos, to_rna


def read_fasta(spark: SparkSession, path, rna: bool = False) -> DataFrame:
    """name, seq, len; white space inside sequences goes. Duplicate names are an error when rows are read."""
    parts = spark.read.option("lineSep", ">").text(path).filter(F.trim("value") != "")
    name = F.regexp_extract("value", r"^\s*([^\s]+)", 1)
    body = F.regexp_replace(F.regexp_extract("value", r"(?s)^[^\r\n]*[\r\n]+(.*)$", 1), r"\s+", "")
    out = parts.select(name.alias("name"), (to_rna(body) if rna else body).alias("seq"))
    n = out.groupBy("name").agg(F.count("*").alias("n"), F.first("seq").alias("seq"))
    checked = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("duplicate sequence name "), "name"))).otherwise(F.col("seq"))
    return n.select("name", checked.alias("seq")).withColumn("len", F.length("seq"))


def write_fasta(df: DataFrame, path: str) -> None:
    """Corrected sequences: df has name and seq; T for U, lines of 81 characters."""
    seq = F.regexp_replace(F.translate("seq", "U", "T"), "(.{81})(?=.)", "$1\n")
    df.orderBy("name").select(F.concat(F.lit(">"), "name", F.lit("\n"), seq)).coalesce(1).write.text(path)


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """read_id, seq, qual. A file is read as a whole, since its four-line records have no mark to split at; empty part files give nothing."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lines = (gzip.decompress(content) if name.endswith(".gz") else content).decode().splitlines()
                while lines and not lines[-1].strip():
                    lines.pop()
                if len(lines) % 4:
                    raise ValueError(f"{name} isn't made of four-line records")
                for i in range(0, len(lines), 40_000):
                    rows = [lines[j : j + 4] for j in range(i, min(i + 40_000, len(lines)), 4)]
                    if any(r[0][:1] != "@" or r[2][:1] != "+" or len(r[1]) != len(r[3]) for r in rows):
                        raise ValueError(f"{name} has a malformed record")
                    yield pa.record_batch([pa.array(c, pa.string()) for c in ([r[0][1:].split()[0] for r in rows], [r[1] for r in rows], [r[3] for r in rows])], names=["read_id", "seq", "qual"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, "read_id string, seq string, qual string")


def write_fastq(df: DataFrame, path: str) -> None:
    df.select(F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual")).write.option("compression", "gzip").text(path)


def read_sam(spark: SparkSession, path, min_mapq: int = 10) -> DataFrame:
    """Alignments with flags split, 0-based ``left`` and ``right``, tags as a map (the last of a repeated tag), and their category.

    Unmapped reads are UNMAPPED before mapping quality is looked at; lines
    with fewer than 11 fields are an error.
    """
    f = F.split("value", "\t")
    lines = spark.read.text(path).filter(~F.col("value").startswith("@") & (F.trim("value") != ""))
    lines = lines.select(F.when(F.size(f) >= 11, f).otherwise(F.raise_error(F.concat(F.lit("short SAM line: "), "value"))).alias("f"))
    at = lambda i: F.col("f")[i]
    tags = F.when(F.size("f") > 11, F.expr("""map_from_entries(transform(array_distinct(transform(slice(f, 12, size(f)), x -> substring(x, 1, 2))),
        k -> struct(k, substring(element_at(filter(slice(f, 12, size(f)), x -> startswith(x, concat(k, ':'))), -1), 6))))"""))
    out = lines.select(at(0).alias("read_id"), at(1).cast("int").alias("flag"), at(2).alias("rna"), (at(3).cast("int") - 1).alias("left"), at(4).cast("int").alias("mapq"), at(5).alias("cigar"), at(9).alias("seq"), at(10).alias("qual"), tags.alias("tags"))
    category = F.when(F.col("rna") == "*", "UNMAPPED").when(F.col("mapq") < min_mapq, "LOW_MAPQ").otherwise("INCLUDED")
    right = F.when(F.col("cigar") != "*", right_target_pos(F.col("left"), F.col("cigar")))
    return out.select("*", right.alias("right"), read_type(F.col("flag")).alias("read_type"), ((F.col("flag").bitwiseAND(F.lit(16))) != 0).alias("reverse"), category.alias("category"))


def read_profile(spark: SparkSession, path) -> DataFrame:
    """A tab-separated table with a header; ``nan`` and infinities become null, numbers doubles."""
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    text = {"Sequence", "sequence"}
    return raw.select(*[F.col(c) if c in text else F.when(~F.lower(c).isin("nan", "inf", "-inf"), F.col(c)).cast("double").alias(c) for c in raw.columns])


def _six(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("nan")).otherwise(F.format_string("%.6f", c))


def write_shape(df: DataFrame, path: str) -> None:
    """``.shape``: 1-based position and value, -999 for missing; df has pos and value."""
    df.orderBy("pos").select(F.concat_ws("\t", (F.col("pos") + 1).cast("string"), F.when(F.col("value").isNull(), "-999").otherwise(_six(F.col("value"))))).coalesce(1).write.text(path)


def write_map(df: DataFrame, path: str) -> None:
    """``.map``: position, value, standard error (0 where the value is missing) and base; df has pos, value, stderr, nt."""
    missing = F.col("value").isNull()
    line = F.concat_ws("\t", (F.col("pos") + 1).cast("string"), F.when(missing, "-999").otherwise(_six(F.col("value"))), F.when(missing, "0").otherwise(_six(F.col("stderr"))), F.upper("nt"))
    df.orderBy("pos").select(line).coalesce(1).write.text(path)


def read_shape(spark: SparkSession, path) -> DataFrame:
    f = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).filter(F.trim("value") != "").select((f[0].cast("int") - 1).alias("pos"), F.when(f[1].cast("double") > -999, f[1].cast("double")).alias("value"))


def read_map(spark: SparkSession, path) -> DataFrame:
    """pos (0-based), value, stderr, nt (U for T); numbers under -990 and ``nan`` become null, lines with fewer than four fields are an error."""
    f = F.split(F.trim("value"), "\t")
    rows = spark.read.text(path).select(F.when(F.size(f) >= 4, f).otherwise(F.raise_error(F.concat(F.lit("short .map line: "), "value"))).alias("f"))
    at = lambda i: F.col("f")[i]
    number = lambda i: F.when((at(i).cast("double") >= -990) & ~F.isnan(at(i).cast("double")), at(i).cast("double"))
    return rows.select((at(0).cast("int") - 1).alias("pos"), number(1).alias("value"), number(2).alias("stderr"), F.translate(at(3), "T", "U").alias("nt"))


def read_ct(spark: SparkSession, path) -> DataFrame:
    """pos (0-based), nt, paired of a pairing table; its first line is a header."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).filter(F.size(f) >= 6).select(F.try_to_number(f[0], F.lit("999999999")).cast("int").alias("i"), f[1].alias("nt"), f[4].alias("pair"))
    return rows.filter(F.col("i").isNotNull() & F.length("nt").eqNullSafe(1)).select((F.col("i") - 1).alias("pos"), "nt", (F.col("pair") != "0").alias("paired"))
