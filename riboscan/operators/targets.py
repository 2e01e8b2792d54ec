"""Operators on target sequences: primers, corrected sequences, the FASTA checker."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riboscan.functions.sequence import reverse_complement


def only_place(seq: Column, part: Column) -> Column:
    """0-based place of ``part`` in ``seq``; null unless there is exactly one, overlapping ones counted."""
    first = F.instr(seq, part)
    again = F.instr(F.substring(seq, first + 1, F.length(seq)), part)
    return F.when((first > 0) & (again == 0), first - 1)


def locate_primers(targets: DataFrame, primers: DataFrame, strict: bool = True) -> DataFrame:
    """Places of primer pairs (rna, idx, fw_seq, rv_seq) in targets (rna, seq): fw_left, fw_right, rv_left, rv_right, inclusive.

    The reverse primer is looked for as its reverse complement. A primer
    without exactly one place is an error if ``strict``, else its places are
    null. The join is on rna; Catalyst chooses its kind by the tables' sizes.
    """
    both = primers.join(targets.select("rna", F.upper("seq").alias("_seq")), "rna")
    fw, rv = only_place(F.col("_seq"), F.col("fw_seq")), only_place(F.col("_seq"), reverse_complement(F.col("rv_seq")))
    if strict:
        say = lambda side: F.raise_error(F.concat(F.lit(f"no single place of a {side} primer in "), F.col("rna"))).cast("int")
        fw, rv = F.coalesce(fw, say("forward")), F.coalesce(rv, say("reverse"))
    out = both.withColumn("fw_left", fw).withColumn("rv_left", rv)
    return out.select("rna", "idx", "fw_seq", "rv_seq", "fw_left", (F.col("fw_left") + F.length("fw_seq") - 1).alias("fw_right"), "rv_left", (F.col("rv_left") + F.length("rv_seq") - 1).alias("rv_right"))


def lowercase_primers(targets: DataFrame) -> DataFrame:
    """Primer pairs from the lowercase ends of targets (rna, seq); a target without both ends is an error."""
    n, head, tail = F.length("seq"), F.regexp_extract("seq", "^[a-z]+", 0), F.regexp_extract("seq", "[a-z]+$", 0)
    fail = F.raise_error(F.concat(F.lit("no lowercase primer ends in "), F.col("rna"))).cast("string")
    fw = F.when((head != "") & (tail != ""), F.upper(head)).otherwise(fail)
    return targets.select("rna", F.lit(0).alias("idx"), fw.alias("fw_seq"), reverse_complement(tail).alias("rv_seq"), F.lit(0).alias("fw_left"), (F.length(head) - 1).alias("fw_right"), (n - F.length(tail)).alias("rv_left"), (n - 1).alias("rv_right"))


def with_reference(variants: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds ``ref``, the target's own bases where a variant (rna, left, right, seq) lies."""
    own = F.expr("substring(_seq, left + 2, right - left - 1)")
    return variants.join(targets.select("rna", F.col("seq").alias("_seq")), "rna").withColumn("ref", own).drop("_seq")


def correct_sequence(targets: DataFrame, variants: DataFrame) -> DataFrame:
    """Targets (rna, seq) with their variants (rna, left, right, seq) applied, as DNA: rna, seq, n_corrections.

    A variant replaces what lies between the unchanged places left and right.
    Touching variants are to be merged before (``merge_adjacent``). Variants
    that overlap, touch or have the same places are an error. Variants are gathered
    per target, so a target's variants must fit one row.
    """
    found = variants.groupBy("rna").agg(F.array_sort(F.collect_list(F.struct("left", "right", F.col("seq").alias("new")))).alias("_v"))
    start = F.struct(F.lit("").alias("out"), F.lit(-1).alias("at"))

    def step(acc: Column, v: Column) -> Column:
        clash = F.when(v["left"] < acc["at"], F.raise_error(F.lit("conflicting variants")).cast("string"))
        at = F.greatest(acc["at"], F.lit(0))
        kept = F.substring(F.col("seq"), at + 1, v["left"] + 1 - at)
        return F.struct(F.concat(F.coalesce(clash, acc["out"]), kept, v["new"]).alias("out"), v["right"].cast("int").alias("at"))

    end = lambda acc: F.concat(acc["out"], F.substring(F.col("seq"), F.greatest(acc["at"], F.lit(0)) + 1, F.length("seq")))
    none = F.array().cast("array<struct<left:int,right:int,new:string>>")
    all_v = F.coalesce(F.col("_v").cast("array<struct<left:int,right:int,new:string>>"), none)
    out = targets.select("rna", "seq").join(found, "rna", "left")
    return out.select("rna", F.translate(F.aggregate(all_v, start, step, end), "U", "T").alias("seq"), F.size(all_v).alias("n_corrections"))


def merge_mate_bases(left1: Column, seq1: Column, qual1: Column, left2: Column, seq2: Column, qual2: Column) -> tuple[Column, Column]:
    """Bases and qualities of a pair over its whole fragment.

    The second mate's base wins where both have one, and the higher quality
    does. Places of neither are ``_`` and ``~``.
    """
    last = F.greatest(left1 + F.length(seq1), left2 + F.length(seq2)) - 1
    places = F.sequence(F.least(left1, left2), last)

    def char(text: Column, left: Column, p: Column) -> Column:
        return F.when((p >= left) & (p < left + F.length(text)), F.substring(text, p - left + 1, F.lit(1)))

    def best(p: Column) -> Column:
        a, b = (F.coalesce(char(q, x, p), F.lit("~")) for q, x in ((qual1, left1), (qual2, left2)))
        return F.when(a == "~", b).when(b == "~", a).otherwise(F.greatest(a, b))

    bases = F.transform(places, lambda p: F.coalesce(char(seq2, left2, p), char(seq1, left1, p), F.lit("_")))
    return F.array_join(bases, ""), F.array_join(F.transform(places, best), "")


class FastaCheck(NamedTuple):
    text: str
    mended: list[str]
    fatal: list[str]


def check_fasta(text: str) -> FastaCheck:
    """Mends line ends, U and spaces of a target file's text; lists what can't be mended.

    A target file holds a few sequences, so its text is taken as one string.
    """
    lines = re.split(r"\r\n|\r|\n", text)
    if lines[-1] == "":
        lines.pop()
    heads = [i for i, x in enumerate(lines) if x.startswith(">")]
    bodies = [(i, x) for i, x in enumerate(lines) if not x.startswith(">")]
    with_bases = {max((h for h in heads if h < i), default=-1) for i, x in bodies if x.strip()}
    names = [lines[i][1:].rstrip() for i in heads]
    mended = {"line_ends": "\r" in text, "uracil": any(re.search("[uU]", x) for _, x in bodies), "spaces": any(" " in x for _, x in bodies)}
    fatal = {
        "too_short": len(lines) < 2,
        "missing_header": -1 in with_bases,
        "missing_sequence": any(h not in with_bases for h in heads),
        "not_letters": any(not c.isalpha() for i, x in bodies if heads and i > heads[0] for c in x.rstrip() if c != " "),
        "duplicate_names": len(set(names)) < len(names),
    }
    fixed = [x.strip() if x.startswith(">") else x.rstrip().translate(str.maketrans("uU", "tT", " ")) for x in lines]
    return FastaCheck("\n".join(fixed) + "\n", [k for k, v in mended.items() if v], [k for k, v in fatal.items() if v])
