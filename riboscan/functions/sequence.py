"""Sequence, quality and alignment-field expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    """Complement of the reversed sequence; letters other than ACGT become N."""
    return F.regexp_replace(F.translate(F.reverse(F.upper(seq)), "ACGT", "TGCA"), "[^ACGT]", "N")


def to_rna(seq: Column) -> Column:
    return F.translate(seq, "Tt", "Uu")


def sanitize_name(name: Column) -> Column:
    """Characters outside ``[A-Za-z0-9.\\-_+:]`` become underscores."""
    return F.regexp_replace(name, r"[^A-Za-z0-9.\-_+:]", "_")


def hamming(a: Column, b: Column) -> Column:
    """Number of differing places; 1 for unequal lengths."""
    same = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda d: d))
    return F.when(F.length(a) != F.length(b), F.lit(1)).otherwise(same)


def phred(qual: Column) -> Column:
    """Quality string to scores (ASCII minus 33)."""
    return F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33)


def cigar_ops(cigar: Column) -> Column:
    """Array of (op, len)."""
    n = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIDNSHP=X]"), F.lit(1)), lambda x: x.cast("int"))
    return F.zip_with(F.regexp_extract_all(cigar, F.lit(r"\d+([MIDNSHP=X])"), F.lit(1)), n, lambda o, k: F.struct(o.alias("op"), k.alias("len")))


def right_target_pos(left: Column, cigar: Column) -> Column:
    """The last target position that an alignment from ``left`` covers."""
    used = F.filter(cigar_ops(cigar), lambda x: x["op"].isin("M", "D", "N", "P", "=", "X"))
    return left + F.aggregate(used, F.lit(0), lambda a, x: a + x["len"]) - 1


def md_ops(md: Column) -> Column:
    """Array of (op, len, seq): match, mismatch or deletion; empty matches are dropped."""
    parts = F.filter(F.regexp_extract_all(md, F.lit(r"(\d+|\^[A-Z]+|[A-Z]+)"), F.lit(1)), lambda x: ~x.rlike("^0+$"))

    def op(x: Column) -> Column:
        number, gap = x.rlike("^[0-9]"), x.startswith("^")
        kind = F.when(number, F.lit("match")).when(gap, F.lit("deletion")).otherwise(F.lit("mismatch"))
        size = F.when(number, x.try_cast("int")).when(gap, F.length(x) - 1).otherwise(F.length(x))
        seq = F.when(number, F.lit("")).when(gap, F.regexp_replace(x, r"^\^", "")).otherwise(x)
        return F.struct(kind.alias("op"), size.alias("len"), seq.alias("seq"))

    return F.transform(parts, op)


def flag_bit(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(1 << bit)) != 0


def read_type(flag: Column) -> Column:
    """MERGED without the paired bit; else by first or second mate, UNPAIRED if the mate is unmapped."""
    return (
        F.when(~flag_bit(flag, 0), F.lit("MERGED"))
        .when(flag_bit(flag, 3), F.lit("UNPAIRED"))
        .when(flag_bit(flag, 6), F.lit("PAIRED_R1"))
        .otherwise(F.lit("PAIRED_R2"))
    )
