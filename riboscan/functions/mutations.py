"""Mutation classes over (left, right, seq): the nearest unchanged target positions and the read's bases between them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the classes and their groups
SINGLE_MISMATCHES = ("AT", "AG", "AC", "TA", "TG", "TC", "GA", "GT", "GC", "CA", "CT", "CG")
MULTI_MISMATCHES = ("A_multinuc_mismatch", "C_multinuc_mismatch", "G_multinuc_mismatch", "T_multinuc_mismatch", "N_multinuc_mismatch")
DELETIONS = ("A-", "T-", "G-", "C-")
INSERTIONS = ("-A", "-T", "-G", "-C", "-N")
LONG_INDELS = ("multinuc_deletion", "multinuc_insertion")
COMPLEX = ("complex_deletion", "complex_insertion")
CLASSES = DELETIONS + INSERTIONS + SINGLE_MISMATCHES + LONG_INDELS + MULTI_MISMATCHES + COMPLEX
TYPES = {
    "mismatch": SINGLE_MISMATCHES + MULTI_MISMATCHES,
    "insert": INSERTIONS,
    "insert_multi": ("multinuc_insertion",),
    "gap": DELETIONS,
    "gap_multi": ("multinuc_deletion",),
    "complex": COMPLEX,
    "dms": tuple(t for t in SINGLE_MISMATCHES if t != "GA") + ("A_multinuc_mismatch", "C_multinuc_mismatch", "T_multinuc_mismatch"),
}


def span(left: Column, right: Column) -> Column:
    """How many target bases are changed."""
    return right - left - 1


def is_ambiguous(left: Column, right: Column, seq: Column) -> Column:
    """An indel that has other placements, recorded with the bases it may slide over."""
    d, n = span(left, right), F.length(seq)
    return ((d > n) & (n > 0)) | ((d < n) & (d > 0))


def classify(left: Column, right: Column, seq: Column, target: Column, target_pos: Column) -> Column:
    """The class of a mutation; ``target`` is target sequence from position ``target_pos`` on."""
    d, n = span(left, right), F.length(seq)
    base = lambda at: F.substring(target, at - target_pos + 1, 1)
    last = base(right - 1)
    return (
        F.when((d == 1) & (n == 0), F.concat(base(left + 1), F.lit("-")))
        .when((d == 0) & (n == 1), F.concat(F.lit("-"), seq))
        .when((d == 1) & (n == 1), F.when(seq == "N", F.lit("N_match")).otherwise(F.concat(base(left + 1), seq)))
        .when((d > 1) & (n == 0), F.lit("multinuc_deletion"))
        .when((d == 0) & (n > 1), F.lit("multinuc_insertion"))
        .when(d == n, F.concat(F.when(last.isin("A", "C", "G", "T"), last).otherwise(F.lit("N")), F.lit("_multinuc_mismatch")))
        .when(n < d, F.lit("complex_deletion"))
        .otherwise(F.lit("complex_insertion"))
    )


def of_type(tag: Column, kind: str) -> Column:
    """Whether a class counts under a mutation type; every class does for the empty type."""
    return tag.isin(*TYPES[kind]) if kind else F.lit(True)
