"""The steps from alignments to mutation records, on small cases and by brute force."""

import random

from pyspark.sql import functions as F

from riboscan.functions.mutations import classify
from riboscan.functions.reads import Change, Mapped, aligned, join_nearby, pair_mates, place_indels, process_reads, resolve_mates, tag_of, without_end, without_primers
from riboscan.sources.mutations import read_mutations, write_counts, write_mutations
from riboscan.sources.text import read_sam


def mapped(target, qual=None, left=0, mutations=()):
    return Mapped(left, target, qual or "I" * len(target), [True] * len(target), list(mutations))


def applied(r):
    """The read's bases that its mutations make of the target."""
    out, place = "", r.left
    for m in sorted(r.mutations, key=lambda m: m[:2]):
        out += r.target[place - r.left : m.left + 1 - r.left] + m.seq
        place = m.right
    return out + r.target[place - r.left :]


def test_indels_span_their_placements():
    # target GCAAAT, read GCAAT: any of the three A may be the missing one
    assert aligned(10, "2M1D3M", "2^A3", "GCAAT", "ABCDE").mutations == [Change(11, 15, "AA", "CD")]
    assert aligned(10, "4M1D1M", "4^A1", "GCAAT", "ABCDE").mutations == [Change(11, 15, "AA", "CD")]
    # inserted CA beside CA
    assert aligned(0, "1M2I4M", "5", "GCACATT", "ABCDEFG").mutations == [Change(0, 3, "CACA", "BCDE")]
    assert aligned(0, "1M1D2M", "1^C2", "GAT", "ABC").mutations == [Change(0, 2, "", "")]


def test_steps_keep_the_read():
    rng = random.Random(5)
    for _ in range(3000):
        cigar, md, seq, run, last = "", "", "", 0, ""
        for k in range(rng.randrange(3, 9)):
            op = "M" if k % 2 == 0 else rng.choice("ID")
            n = rng.randrange(1, 5)
            cigar += f"{n}{op}"
            bases = "".join(rng.choices("AC", k=n))
            if op == "D":
                md, run = md + f"{run}^{bases}", 0
                continue
            for c in bases:
                seq += c
                if op == "M" and rng.random() < 0.15:
                    md, run = md + f"{run}{'C' if c == 'A' else 'A'}", 0
                elif op == "M":
                    run += 1
        if cigar[-1] != "M":
            cigar, seq, run = cigar + "1M", seq + "A", run + 1
        md += str(run)
        r = aligned(7, cigar, md, seq, "I" * len(seq))
        assert applied(r) == seq
        for to_right in (False, True):
            placed = place_indels(r, to_right, to_right)
            assert applied(placed) == seq
            assert applied(join_nearby(placed, 6)) == seq
            assert not any(m.seq and m.right - m.left > 1 and m.seq[0] == r.target[m.left + 1 - 7] for m in join_nearby(placed, 6).mutations)


def test_placing_and_joining():
    r = mapped("GCAAAT", mutations=[Change(1, 5, "AA", "CD")])
    assert place_indels(r).mutations == [Change(1, 3, "", "", True)]
    assert place_indels(r, right_gaps=True).mutations == [Change(3, 5, "", "", True)]
    r = mapped("GCACATT", mutations=[Change(0, 3, "CACA", "BCDE")])
    assert place_indels(r).mutations == [Change(0, 1, "CA", "BC", True)]
    assert place_indels(r, right_inserts=True).mutations == [Change(2, 3, "CA", "DE", True)]
    two = [Change(0, 2, "T", "1"), Change(4, 6, "G", "2")]
    r = mapped("ACGTACGT", "abcdefgh", mutations=two)
    assert join_nearby(r, 3).mutations == [Change(0, 6, "TGTAG", "1cde2")]
    assert join_nearby(r, 2).mutations == two
    assert join_nearby(mapped("AC__ACGT", mutations=two), 6).mutations == two


def test_mates_by_quality():
    low, high = Change(2, 4, "T", "#"), Change(2, 4, "G", "I")
    a, b = mapped("ACGTAC", "II###I", mutations=[low]), mapped("GTACGT", left=2, mutations=[high])
    out = resolve_mates(a, b)
    assert (out.left, out.target, out.mutations) == (0, "ACGTACGT", [high]) and all(out.depth)
    assert resolve_mates(b._replace(mutations=[high]), a).mutations == [high]
    same = resolve_mates(mapped("ACGTAC", mutations=[Change(2, 4, "T", "I")]), b)
    assert same.mutations == [Change(2, 4, "T", "I")]  # the first mate of equals
    # a gap between mates, and a loser alone on its places
    apart = resolve_mates(mapped("ACG"), mapped("TTT", left=5))
    assert (apart.target, apart.qual, apart.depth) == ("ACG__TTT", "III~~III", [True] * 3 + [False] * 2 + [True] * 3)
    lost = resolve_mates(mapped("ACGTA", "IIIII"), mapped("CGTA", "####", 1, [Change(1, 4, "", "")]))
    assert lost.mutations == [] and all(lost.depth)


def test_ends_and_primers():
    r = mapped("A" * 10, left=5, mutations=[Change(5, 7, "C", "I"), Change(9, 11, "C", "I"), Change(11, 13, "C", "I")])
    right = without_end(r, 3)
    assert right.mutations == r.mutations[:2] and right.depth == [True] * 7 + [False] * 3
    assert without_end(r, 3, reverse=True).mutations == r.mutations[1:]
    inside = without_primers(r, (5, 6, 13, 14))
    assert inside.mutations == [r.mutations[1]] and inside.depth == [False] * 2 + [True] * 6 + [False] * 2
    assert without_primers(r, (5, 6, 13, 14), 3).mutations == [] and sum(without_primers(r, (5, 6, 13, 14), 3).depth) == 0


def test_tags_as_columns(spark):
    target = "ACGTNACGT"
    found = [Change(a, b, s, "I" * len(s)) for a in range(8) for b in range(a + 1, min(a + 4, 9)) for s in ("", "A", "N", "CT", "CTG") if b > a + 1 or s]
    df = spark.createDataFrame([tuple(m[:3]) for m in found], "l int, r int, s string")
    got = [x[0] for x in df.coalesce(1).select(classify(F.col("l"), F.col("r"), F.col("s"), F.lit(target), F.lit(0))).collect()]
    assert got == [tag_of(m, target, 0) for m in found]


def test_alignments_to_records_and_back(spark, tmp_path):
    q = "I" * 8
    lines = [
        f"p\t99\tt\t1\t30\t8M\t=\t5\t12\tACGTACGT\t{q}\tMD:Z:8",
        f"far\t99\tt\t1\t30\t8M\t=\t5\t12\tACGTACGT\t{q}\tMD:Z:8",
        f"low\t0\tt\t1\t2\t8M\t*\t0\t0\tACGTACGT\t{q}\tMD:Z:8",
        f"p\t147\tt\t5\t30\t8M\t=\t1\t-12\tACGTTCGT\t{q}\tMD:Z:4A3",
        f"far\t147\tt\t2001\t30\t8M\t=\t1\t-12\tACGTACGT\t{q}\tMD:Z:8",
        f"none\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII",
        f"one\t0\tt\t1\t30\t2M1D5M\t*\t0\t0\tACTACGT\t{q[:7]}\tMD:Z:2^G5",
    ]
    (tmp_path / "a.sam").write_text("\n".join(lines) + "\n")
    rows = pair_mates(read_sam(spark, str(tmp_path / "a.sam")))
    records = process_reads(rows)
    got = {(r.read_id, r.left): r for r in records.collect()}
    assert sorted(got) == [("far", 0), ("far", 2000), ("low", 0), ("one", 0), ("p", 0)]
    p = got["p", 0]
    assert (p.read_type, p.right, p.category) == ("PAIRED", 11, "INCLUDED")
    assert [(m.left, m.right, m.seq, m.tag) for m in p.mutations] == [(7, 9, "T", "AT")] and [i for i, c in enumerate(p["count"]) if c] == [8]
    assert [m.tag for m in got["one", 0].mutations] == ["G-"]
    assert got["low", 0].category == "LOW_MAPQ" and not any(got["low", 0].depth) and all(got["low", 0].mapped_depth)
    write_mutations(records, str(tmp_path / "m"))
    back = read_mutations(spark, str(tmp_path / "m"))
    assert sorted(map(str, back.collect())) == sorted(map(str, records.drop("rna").collect()))
    line = next(r.value for r in spark.read.text(str(tmp_path / "m")).collect() if "\tp\t" in r.value)
    assert line == 'PAIRED\tp\t0\t11\tINCLUDED\t-999\t' + "1" * 12 + "\t" + "1" * 12 + "\t000000001000\t" + '7 9 "T" "I" "AT"'
    assert process_reads(rows.limit(0)).count() == 0


def test_counts_table(spark, tmp_path):
    write_counts(spark.createDataFrame([(1, 5, 6), (0, 3, 4)], "pos int, `A-` int, depth int"), str(tmp_path / "c"))
    assert [r.value for r in spark.read.text(str(tmp_path / "c")).collect()] == ["A-\tdepth", "3\t4", "5\t6"]
