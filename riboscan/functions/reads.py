"""From aligned reads and pairs to countable mutations: one Arrow pass, no shuffle after mates are joined.

Steps on a read: indels widened over their equal placements, mates resolved,
ends and primers left out, ambiguous indels placed, neighbours joined, classes,
quality filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riboscan.functions.alignment import target_bases
from riboscan.functions.quality import Tagged, quality_filter
from riboscan.operators.reads import concordant


class Change(NamedTuple):
    left: int
    right: int
    seq: str
    qual: str
    ambig: bool = False


class Mapped(NamedTuple):
    """``target`` (``_`` where no mate lies), ``qual`` and ``depth`` by target place, from ``left`` on."""

    left: int
    target: str
    qual: str
    depth: list[bool]
    mutations: list[Change]


def aligned(left: int, cigar: str, md: str, seq: str, qual: str) -> Mapped:
    """A read by target place; each indel spans all its equal placements and carries the read's bases there.

    An indel of p bases moves on by one place as long as the base it takes in
    equals the base p columns away; it stops at another indel and at the
    read's ends. Mismatches under it become part of it, and indels whose spans
    meet become one.
    """
    columns = target_bases(cigar, md, seq)
    n = len(columns)
    paired = [base != "-" and at >= 0 for _, base, at in columns]
    letter = [seq[at] if base == "-" else base for _, base, at in columns]
    spans: list[list[int]] = []
    i = 0
    while i < n:
        if paired[i]:
            i += 1
            continue
        j = i + 1
        while j < n and not paired[j] and (columns[j][1] == "-") == (columns[i][1] == "-"):
            j += 1
        low, high, period = i, j, j - i
        while high < n and paired[high] and letter[high] == letter[high - period]:
            high += 1
        while low > 0 and paired[low - 1] and letter[low - 1] == letter[low - 1 + period]:
            low -= 1
        if spans and low < spans[-1][1]:
            spans[-1] = [min(low, spans[-1][0]), max(high, spans[-1][1])]
        else:
            spans.append([low, high])
        i = j
    covered = {c for low, high in spans for c in range(low, high)}
    spans += [[c, c + 1] for c in range(n) if paired[c] and c not in covered and seq[columns[c][2]] != columns[c][1]]
    found = []
    for low, high in sorted(spans):
        at = [c[2] for c in columns[low:high] if c[2] >= 0]
        last, base, _ = columns[high - 1]
        found.append(Change(left + columns[low][0] - 1, left + last + (base != "-"), "".join(seq[x] for x in at), "".join(qual[x] for x in at)))
    places = [c for c in columns if c[1] != "-"]
    return Mapped(left, "".join(c[1] for c in places), "".join(qual[c[2]] if c[2] >= 0 else "!" for c in places), [True] * len(places), found)


def resolve_mates(a: Mapped, b: Mapped) -> Mapped:
    """One read of two mates: in each group of overlapping mutations the mate with the higher mean quality says what is there; ``a`` of equals.

    A group's quality is that of its bases and their neighbours, or of the
    mate's bases over the group where it has no mutation. What the other mate
    claimed leaves that mate's depth.
    """
    left, right = min(a.left, b.left), max(r.left + len(r.target) for r in (a, b))
    depths = [list(a.depth), list(b.depth)]

    def at(r: Mapped, p: int, field: str, gap: str) -> str:
        return field[p - r.left] if 0 <= p - r.left < len(field) else gap

    def mean(r: Mapped, own: list[Change], low: int, high: int) -> float:
        if own:
            scores = [ord(c) for m in own for c in m.qual + at(r, m.left, r.qual, "") + at(r, m.right, r.qual, "")]
        elif low >= r.left and high < r.left + len(r.qual):
            scores = [ord(c) for c in r.qual[low - r.left : high + 1 - r.left]]
        else:
            scores = []
        return sum(scores) / len(scores) if scores else 0.0

    groups: list[tuple[int, int, tuple[list[Change], list[Change]]]] = []
    for _, side, m in sorted(((m.left, side, m) for side, r in enumerate((a, b)) for m in r.mutations), key=lambda x: x[:2]):
        if groups and m.left < groups[-1][1]:
            low, high, sides = groups[-1]
            groups[-1] = (low, max(high, m.right), sides)
        else:
            groups.append((m.left, m.right, ([], [])))
        groups[-1][2][side].append(m)
    kept: list[Change] = []
    for low, high, sides in groups:
        winner = int(mean(b, sides[1], low, high) > mean(a, sides[0], low, high))
        kept += sides[winner]
        if lost := sides[1 - winner]:
            start = (a, b)[1 - winner].left
            for p in range(min(m.left for m in lost) + 1, max(m.right for m in lost)):
                if 0 <= p - start < len(depths[1 - winner]):
                    depths[1 - winner][p - start] = False
    span = range(left, right)
    target = "".join(x if (x := at(a, p, a.target, "_")) != "_" else at(b, p, b.target, "_") for p in span)
    marks = [[q for r in (a, b) if (q := at(r, p, r.qual, "~")) != "~"] for p in span]
    covered = [any(0 <= p - r.left < len(d) and d[p - r.left] for r, d in zip((a, b), depths, strict=True)) for p in span]
    return Mapped(left, target, "".join(max(q, default="~") for q in marks), covered, kept)


def without_end(r: Mapped, n: int, reverse: bool = False) -> Mapped:
    """Leaves out ``n`` places of random primer: mutations at the right end, or at the left end of a ``reverse`` read; depth always at the right end."""
    size = len(r.depth)
    stays = (lambda m: m.left + 1 >= r.left + n) if reverse else (lambda m: m.right <= r.left + size - n)
    return r._replace(mutations=[m for m in r.mutations if stays(m)], depth=[d and i < size - n for i, d in enumerate(r.depth)])


def without_primers(r: Mapped, primers: tuple[int, int, int, int], pad: int = 0) -> Mapped:
    """Leaves out what touches the primer pair (fw_left, fw_right, rv_left, rv_right), or lies within ``pad`` of it (3 for dms)."""
    _, fw, rv, _ = primers
    end = r.left + len(r.depth) - 1
    outside = lambda p: (fw < r.left or p > fw + pad) and (rv > end or p < rv - pad)
    return r._replace(mutations=[m for m in r.mutations if m.left > fw + pad and m.right < rv - pad], depth=[d and outside(r.left + i) for i, d in enumerate(r.depth)])


def place_indels(r: Mapped, right_gaps: bool = False, right_inserts: bool = False) -> Mapped:
    """Puts each ambiguous indel at the left, or right, end of its span; bases beside it that differ from the target become mismatches."""
    out: list[Change] = []
    for m in r.mutations:
        d, n = m.right - m.left - 1, len(m.seq)
        beside = min(d, n)
        if d == n or not beside:
            out.append(m._replace(ambig=False))
            continue
        to_right = right_gaps if n < d else right_inserts
        first = m.left + 1 if to_right else m.right - beside
        cut = slice(0, beside) if to_right else slice(n - beside, n)
        rest = slice(beside, n) if to_right else slice(0, n - beside)
        changed = [Change(first + i - 1, first + i + 1, c, q, True) for i, (c, q) in enumerate(zip(m.seq[cut], m.qual[cut], strict=True)) if r.target[first + i - r.left : first + i + 1 - r.left] != c]
        indel = Change(m.left + beside if to_right else m.left, m.right if to_right else m.right - beside, m.seq[rest], m.qual[rest], True)
        out += [*changed, indel] if to_right else [indel, *changed]
    return r._replace(mutations=out)


def join_nearby(r: Mapped, most: int) -> Mapped:
    """Joins mutations with at most ``most`` unchanged places between them, but not across the gap between mates; then takes equal bases off both ends."""
    target = lambda a, b: r.target[a - r.left : b - r.left]
    out: list[Change] = []
    for m in r.mutations:
        p = out[-1] if out else None
        if p is None or m.left - (p.right - 1) > most or "_" in target(p.right, m.left + 1):
            out.append(m)
        else:
            out[-1] = Change(p.left, m.right, p.seq + target(p.right, m.left + 1) + m.seq, p.qual + r.qual[p.right - r.left : m.left + 1 - r.left] + m.qual, p.ambig or m.ambig)
    for i, m in enumerate(out):
        while m.seq and m.right - m.left > 1 and m.left + 1 >= r.left and m.seq[0] == target(m.left + 1, m.left + 2):
            m = m._replace(left=m.left + 1, seq=m.seq[1:], qual=m.qual[1:])
        while m.seq and m.right - m.left > 1 and m.right - 1 >= r.left and m.seq[-1] == target(m.right - 1, m.right):
            m = m._replace(right=m.right - 1, seq=m.seq[:-1], qual=m.qual[:-1])
        out[i] = m
    return r._replace(mutations=sorted(out, key=lambda m: m[:4]))


def tag_of(m: Change, target: str, left: int) -> str:
    """The class of a mutation, as ``mutations.classify`` gives it for columns."""
    d, n = m.right - m.left - 1, len(m.seq)
    was = target[m.left + 1 - left : m.right - left]
    if d == n == 1:
        return "N_match" if m.seq == "N" else was + m.seq
    if d == n:
        return (was[-1:] if was[-1:] in ("A", "C", "G", "T") else "N") + "_multinuc_mismatch"
    if not n:
        return was + "-" if d == 1 else "multinuc_deletion"
    if not d:
        return "-" + m.seq if n == 1 else "multinuc_insertion"
    return "complex_deletion" if n < d else "complex_insertion"


RECORD = "read_type string, read_id string, rna string, left int, right int, category string, primer int, mapped_depth array<boolean>, depth array<boolean>, count array<boolean>, mutations array<struct<left:int,right:int,seq:string,qual:string,tag:string,ambig:boolean>>"


def process_reads(reads: DataFrame, least: int = 30, kind: str = "", separation: int = 7, random_primer: int = 0, right_gaps: bool = False, right_inserts: bool = False, variant: bool = False) -> DataFrame:
    """A parsed-mutation record per row of ``reads``.

    Columns: read_type, read_id, rna, category, reverse, primer (index or
    null), primers (its four places or null), and left, cigar, md, seq, qual of
    the read and, with a 2 behind the name, of its mate (null without one).
    Reads that aren't INCLUDED keep their mapped depth and raw mutations only.
    For ``dms`` the record has the G-to-A channel as well: depth_ga, count_ga
    and mutations_ga.
    """
    own = ("left", "cigar", "md", "seq", "qual")
    names = ["read_type", "read_id", "rna", "category", "reverse", "primer", "primers", *own, *[f"{c}2" for c in own]]
    item = pa.struct([("left", pa.int32()), ("right", pa.int32()), *[(c, pa.string()) for c in ("seq", "qual", "tag")], ("ambig", pa.bool_())])
    kinds = [*[pa.string()] * 3, pa.int32(), pa.int32(), pa.string(), pa.int32(), *[pa.list_(pa.bool_())] * 3, pa.list_(item)]
    fields = [c.split()[0] for c in RECORD.split(", ")]
    schema = RECORD
    if kind == "dms":
        channel = ("depth", "count", "mutations")
        kinds += [kinds[fields.index(c)] for c in channel]
        schema += "".join(f", {c}_ga {RECORD[RECORD.index(f' {c} ') + len(c) + 2 :].split(', ')[0]}" for c in channel)
        fields = [*fields, *[f"{c}_ga" for c in channel]]

    def one(x: dict) -> tuple:
        if x["md"] is None or (x["left2"] is not None and x["md2"] is None):
            raise ValueError(f"read {x['read_id']} has no MD tag")
        r = aligned(*[x[c] for c in own])
        if x["left2"] is not None:
            r = resolve_mates(r, aligned(*[x[f"{c}2"] for c in own]))
        mapped = [b != "_" for b in r.target]
        ga = ([False] * len(mapped), [False] * len(mapped), [])
        depth, count, kept = [False] * len(mapped), [False] * len(mapped), [(*m[:4], tag_of(m, r.target, r.left), m.ambig) for m in r.mutations]
        if x["category"] == "INCLUDED":
            if x["primers"] is not None:
                r = without_primers(r, tuple(x["primers"]), 3 if kind == "dms" else 0)
            elif random_primer:
                r = without_end(r, random_primer + 1, x["reverse"])
            if not variant:
                r = join_nearby(place_indels(r, right_gaps, right_inserts), separation - 1)
            tagged = [Tagged(*m[:4], tag_of(m, r.target, r.left)) for m in r.mutations]
            ambig = {t: m.ambig for t, m in zip(tagged, r.mutations, strict=True)}
            out = quality_filter(tagged, r.qual, r.depth, r.left, least, kind, variant)
            depth, count, kept = out.depth, out.count, [(*m, ambig[m]) for m in out.kept]
            ga = (out.ga_depth, out.ga_count, [(*m, ambig[m]) for m in out.ga])
        parts = ("left", "right", "seq", "qual", "tag", "ambig")
        told = lambda found: [dict(zip(parts, m, strict=True)) for m in found]
        main = (x["read_type"], x["read_id"], x["rna"], r.left, r.left + len(mapped) - 1, x["category"], x["primer"], mapped, depth, count, told(kept))
        return (*main, *ga[:2], told(ga[2])) if kind == "dms" else main

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(x) for x in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=fields)

    return reads.select(names).mapInArrow(scan, schema)


def pair_mates(sam: DataFrame, most: int = 800) -> DataFrame:
    """Rows for ``process_reads`` from alignments (``read_sam``): concordant mates in one row, all other mapped reads in a row each.

    Mates meet by rna and name, in whatever order they come. A pair with a
    mate of low mapping quality is LOW_MAPQ.
    """
    c = F.col
    own = ("left", "cigar", "md", "seq", "qual")
    base = sam.filter("category <> 'UNMAPPED'").select("rna", "read_id", "flag", F.struct("read_type", "category", "reverse", "right", "left", "cigar", c("tags")["MD"].alias("md"), "seq", "qual").alias("r"))
    bit = lambda b: c("flag").bitwiseAND(F.lit(b)) != 0
    mate = bit(1) & ~bit(8) & (bit(64) != bit(128))
    both = base.filter(mate & bit(64)).select("rna", "read_id", c("r").alias("a")).join(base.filter(mate & bit(128)).select("rna", "read_id", c("r").alias("b")), ["rna", "read_id"], "full_outer")
    ends = lambda r: {"left": c(r)["left"], "right": c(r)["right"], "reverse": c(r)["reverse"], "mapped": c(r).isNotNull()}
    together = F.coalesce(concordant(ends("a"), ends("b"), most), F.lit(False))

    def row(r: str, other: Column | None = None) -> Column:
        low = c(r)["category"] if other is None else F.when((c(r)["category"] == "LOW_MAPQ") | (other["category"] == "LOW_MAPQ"), "LOW_MAPQ").otherwise(c(r)["category"])
        kind = c(r)["read_type"] if other is None else F.lit("PAIRED")
        far = [(F.lit(None).cast("int" if x == "left" else "string") if other is None else other[x]).alias(f"{x}2") for x in own]
        return F.struct(kind.alias("read_type"), low.alias("category"), c(r)["reverse"].alias("reverse"), *[c(r)[x].alias(x) for x in own], *far)

    pairs = both.select("rna", "read_id", F.explode(F.when(together, F.array(row("a", c("b")))).otherwise(F.filter(F.array(row("a"), row("b")), lambda x: x["left"].isNotNull()))).alias("x"))
    rows = pairs.select("read_id", "rna", "x.*").unionByName(base.filter(~mate).select("read_id", "rna", row("r").alias("x")).select("read_id", "rna", "x.*"))
    return rows.withColumn("primer", F.lit(None).cast("int")).withColumn("primers", F.lit(None).cast("array<int>"))
