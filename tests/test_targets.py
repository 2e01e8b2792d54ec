"""Quality filter, primers, corrected sequences, FASTA checks and the streaming counter on small cases."""

import pytest

from riboscan.functions.quality import Tagged, filter_by_quality, quality_filter
from riboscan.operators.targets import check_fasta, correct_sequence, locate_primers, lowercase_primers, with_reference
from riboscan.streaming.depth import sorted_depth

GAP = [Tagged(7, 10, "", "", "multinuc_deletion")]


def bits(x):
    return "".join("01"[b] for b in x)


@pytest.mark.parametrize("variant, depth", [(False, "1111111101111111"), (True, "1" * 16)])
def test_deletion_is_counted_at_its_last_place(variant, depth):
    out = quality_filter(GAP, "HHHHHHHH!!HHHHHH", [True] * 16, 0, 30, variant=variant)
    assert (bits(out.depth), bits(out.count), out.kept) == (depth, "0000000001000000", GAP)


def test_low_qualities_take_their_neighbours():
    assert bits(quality_filter([], "HHH!HHHH", [True] * 8, 5, 30).depth) == "11000111"
    out = quality_filter(GAP, "HHHHHHH#!!HHHHHH", [True] * 16, 0, 30)  # the base before the gap is low
    assert (bits(out.depth), out.kept) == ("1111110000011111"[:16], [])


def test_kinds_and_the_g_to_a_channel():
    found = [Tagged(0, 2, "A", "H", "GA"), Tagged(3, 5, "T", "H", "AT")]
    out = quality_filter(found, "H" * 7, [True] * 7, 0, 30, "dms")
    assert (out.kept, out.ga) == (found[1:], found[:1])
    assert (bits(out.depth), bits(out.ga_depth)) == ("1011111", "1111011")
    assert quality_filter(found, "H" * 7, [True] * 7, 0, 30, "gap").kept == []


def test_quality_filter_over_rows(spark):
    reads = spark.createDataFrame([("r", "x", 0, "HHHHHHHH!!HHHHHH", [True] * 16, [GAP[0]]), ("s", "x", 3, "", [], [])], "read_id string, rna string, left int, qual string, depth array<boolean>, mutations array<struct<left:int,right:int,seq:string,qual:string,tag:string>>")
    got = {r.read_id: r for r in filter_by_quality(reads).collect()}
    assert bits(got["r"]["count"]) == "0000000001000000" and len(got["r"].mutations) == 1 and got["s"].depth == []


def test_primers(spark):
    targets = spark.createDataFrame([("a", "acgTTTTGGGGcat"), ("b", "AAAA")], "rna string, seq string")
    p = lowercase_primers(targets.filter("rna = 'a'"))
    assert p.collect() == locate_primers(targets, p).select(p.columns).collect()
    assert tuple(p.first())[2:] == ("ACG", "ATG", 0, 2, 11, 13)
    twice = spark.createDataFrame([("b", 0, "AA", "T")], "rna string, idx int, fw_seq string, rv_seq string")
    assert locate_primers(targets, twice, strict=False).first().fw_left is None
    for bad in (lambda: locate_primers(targets, twice).collect(), lambda: lowercase_primers(targets).collect()):
        with pytest.raises(Exception, match="primer"):
            bad()


def test_corrected_sequence(spark):
    targets = spark.createDataFrame([("a", "AACCGGUU"), ("b", "ACGU")], "rna string, seq string")
    rows = "rna string, left int, right int, seq string"
    v = spark.createDataFrame([("a", 5, 6, "TT"), ("a", 1, 4, "G"), ("a", -1, 1, "")], rows)
    assert {tuple(r) for r in correct_sequence(targets, v).collect()} == {("a", "AGGGTTTT", 3), ("b", "ACGT", 0)}
    assert {r.ref for r in with_reference(v, targets).collect()} == {"", "CC", "A"}
    for bad in ([("a", 1, 4, "G"), ("a", 2, 5, "T")], [("a", 2, 3, "T"), ("a", 2, 3, "C")]):
        with pytest.raises(Exception, match="conflicting"):
            correct_sequence(targets, spark.createDataFrame(bad, rows)).collect()


def test_fasta_check():
    assert check_fasta(">a\nACGT\n") == (">a\nACGT\n", [], [])
    assert check_fasta(">a\r\nAC GU\r\n") == (">a\nACGT\n", ["line_ends", "uracil", "spaces"], [])
    assert check_fasta("ACGT\nAC\n").fatal == ["missing_header"]
    assert check_fasta(">a\n>b\nAC\n").fatal == ["missing_sequence"]
    assert check_fasta(">a\nA1\n>a\nC\n").fatal == ["not_letters", "duplicate_names"]
    assert check_fasta("").fatal == ["too_short"]


def test_sorted_depth_closes_positions(spark, tmp_path):
    kind = "rna string, sample string, left int, right int"
    batches = [[("x", "m", 3, 5), ("x", "m", 2, 4), ("y", "m", 0, 1)], [("x", "m", 5, 6), ("x", "m", 1, 5)], [("x", "m", None, None), ("y", "m", None, None)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, kind).coalesce(1).write.json(str(tmp_path / f"in/{i}"))
    reads = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).json(str(tmp_path / "in"))
    q = sorted_depth(reads).writeStream.format("memory").queryName("depths").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    got = {(r.rna, r.pos): r.depth for r in spark.table("depths").collect()}
    # the read from 1 on counts from 3 on only: positions below 3 were closed by the first batch
    assert got == {("x", 2): 1, ("x", 3): 3, ("x", 4): 3, ("x", 5): 3, ("x", 6): 1, ("y", 0): 1, ("y", 1): 1}
