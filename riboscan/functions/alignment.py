"""Mutations of an aligned read from its CIGAR and MD fields; plain Python, run inside Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame


class Mutation(NamedTuple):
    left: int
    right: int
    seq: str
    qual: str


def target_bases(cigar: str, md: str, seq: str) -> list[tuple[int, str, int]]:
    """Columns of the alignment: (target offset, target base, read index).

    An insertion has target base ``-``, a deletion read index -1. Soft-clipped
    bases have no column.
    """
    known: list[str] = []  # for each aligned or deleted target place: "" where the read agrees
    for n, gap, change in re.findall(r"(\d+)|\^([A-Za-z]+)|([A-Za-z]+)", md):
        known += [""] * int(n) if n else list(gap or change)
    out, place, at = [], 0, 0
    for size, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
        for _ in range(int(size)):
            if op in "M=X":
                out.append((place, known[place] or seq[at], at))
                place, at = place + 1, at + 1
            elif op in "DN":
                out.append((place, known[place] if op == "D" else "N", -1))
                place += 1
            elif op == "I":
                out.append((place, "-", at))
                at += 1
            elif op == "S":
                at += 1
    return out


def locate_mutations(left: int, cigar: str, md: str, seq: str, qual: str) -> tuple[list[Mutation], str]:
    """Mutations in order, each a single mismatch or a whole insertion or deletion, and the target's bases under the read."""
    columns = target_bases(cigar, md, seq)
    found: list[Mutation] = []
    target = "".join(b for _, b, _ in columns if b != "-")
    i = 0
    while i < len(columns):
        place, base, at = columns[i]
        if base == "-" or at < 0:
            j = i
            while j < len(columns) and (columns[j][1] == "-") == (base == "-") and (columns[j][2] < 0) == (at < 0):
                j += 1
            end = columns[j - 1][0]
            bases = [c[2] for c in columns[i:j] if c[2] >= 0]
            right = place if base == "-" else end + 1
            found.append(Mutation(left + place - 1, left + right, "".join(seq[x] for x in bases), "".join(qual[x] for x in bases)))
            i = j
        else:
            if seq[at] != base:
                found.append(Mutation(left + place - 1, left + place + 1, seq[at], qual[at]))
            i += 1
    return found, target


def collapse(mutations: list[Mutation], left: int, target: str, gap: int) -> list[Mutation]:
    """Joins mutations with at most ``gap`` unchanged bases between them; those bases join the sequence."""
    out: list[Mutation] = []
    for m in mutations:
        if out and m.left - (out[-1].right - 1) <= gap:
            p = out[-1]
            between = target[p.right - left : m.left + 1 - left]
            out[-1] = Mutation(p.left, m.right, p.seq + between + m.seq, p.qual + "~" * len(between) + m.qual)
        else:
            out.append(m)
    return out



def with_mutations(reads: DataFrame, gap: int | None = None) -> DataFrame:
    """read_id, rna, left, right, target and mutations of aligned reads (see ``read_sam``); reads without an MD tag are an error."""
    kind = pa.list_(pa.struct([("left", pa.int32()), ("right", pa.int32()), ("seq", pa.string()), ("qual", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            targets, found = [], []
            for left, cigar, md, seq, qual in zip(*[batch.column(c).to_pylist() for c in ("left", "cigar", "md", "seq", "qual")], strict=True):
                if md is None:
                    raise ValueError("a read has no MD tag")
                m, target = locate_mutations(left, cigar, md, seq, qual)
                targets.append(target)
                found.append([x._asdict() for x in (m if gap is None else collapse(m, left, target, gap))])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("read_id", "rna", "left", "right")], pa.array(targets, pa.string()), pa.array(found, kind)], names=["read_id", "rna", "left", "right", "target", "mutations"])

    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    item = T.StructType([T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()), T.StructField("seq", T.StringType()), T.StructField("qual", T.StringType())])
    schema = T.StructType([T.StructField("read_id", T.StringType()), T.StructField("rna", T.StringType()), T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()), T.StructField("target", T.StringType()), T.StructField("mutations", T.ArrayType(item))])
    mapped = reads.filter("category = 'INCLUDED'").select("read_id", "rna", "left", "right", "cigar", F.col("tags")["MD"].alias("md"), "seq", "qual")
    return mapped.mapInArrow(scan, schema)
