from pyspark.sql import functions as F

from riboscan.functions import mutations as M
from riboscan.functions.alignment import Mutation, collapse, locate_mutations, with_mutations
from riboscan.operators.depth import coverage, dense_counts
from riboscan.sources.text import read_ct, read_fasta, read_fastq, read_profile, read_sam, read_shape, write_fastq, write_map, write_shape


def test_fasta_and_duplicates(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one x\nACGT\nac gt\n>two\nTTT\n")
    assert sorted(tuple(r) for r in read_fasta(spark, str(tmp_path / "a.fa"), rna=True).collect()) == [("one", "ACGUacgu", 8), ("two", "UUU", 3)]
    (tmp_path / "b.fa").write_text(">one\nA\n>one\nC\n")
    try:
        read_fasta(spark, str(tmp_path / "b.fa")).collect()
        raise AssertionError("duplicates passed")
    except Exception as e:
        assert "duplicate sequence name one" in str(e)


def test_fastq_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("r1", "ACGT", "IIII"), ("r2", "A", "#")], "read_id string, seq string, qual string")
    write_fastq(df, str(tmp_path / "q"))
    assert sorted(map(tuple, read_fastq(spark, str(tmp_path / "q/*.gz")).collect())) == sorted(map(tuple, df.collect()))


def test_locate_mutations():
    q = "I" * 20
    assert locate_mutations(10, "4M", "4", "ACGT", q) == ([], "ACGT")
    assert locate_mutations(10, "4M", "1A2", "ACGT", q) == ([Mutation(10, 12, "C", "I")], "AAGT")
    assert locate_mutations(0, "2M2D2M", "2^GG2", "ACTT", q) == ([Mutation(1, 4, "", "")], "ACGGTT")
    assert locate_mutations(5, "1S2M2I2M", "4", "GACTTGA", q) == ([Mutation(6, 7, "TT", "II")], "ACGA")
    m = [Mutation(1, 3, "A", "I"), Mutation(4, 6, "C", "I"), Mutation(15, 17, "G", "I")]
    assert collapse(m, 0, "ACGTACGTACGTACGTACGT", 5) == [Mutation(1, 6, "ATAC", "I~~I"), m[2]]


def test_sam_to_counts(spark, tmp_path):
    lines = ["@HD\tVN:1", "r1\t0\trna\t3\t30\t4M\t*\t0\t0\tACGT\tIIII\tMD:Z:1A2", "r2\t16\trna\t4\t30\t2M1D2M\t*\t0\t0\tGTCC\tIIII\tNM:i:1\tMD:Z:2^A2", "r3\t0\t*\t0\t0\t*\t*\t0\t0\tA\tI", "r4\t0\trna\t1\t3\t1M\t*\t0\t0\tA\tI\tMD:Z:1"]
    (tmp_path / "x.sam").write_text("\n".join(lines) + "\n")
    sam = read_sam(spark, str(tmp_path / "x.sam"))
    assert {r.read_id: r.category for r in sam.collect()} == {"r1": "INCLUDED", "r2": "INCLUDED", "r3": "UNMAPPED", "r4": "LOW_MAPQ"}
    muts = with_mutations(sam)
    tags = muts.select("rna", "left", "target", F.explode("mutations").alias("m")).select("rna", F.col("m.right").alias("right"), M.classify(F.col("m.left"), F.col("m.right"), F.col("m.seq"), F.col("target"), F.col("left")).alias("tag"))
    counts = dense_counts(tags, ["rna"], F.col("right") - 1, F.col("tag"), list(M.CLASSES), 10)
    got = {r.pos: (r["AC"], r["A-"]) for r in counts.collect()}
    assert got == {i: (int(i == 3), int(i == 5)) for i in range(10)}
    assert {r.pos: r.depth for r in coverage(muts, ["rna"]).collect()} == {2: 1, 3: 2, 4: 2, 5: 2, 6: 1, 7: 1}


def test_profile_files(spark, tmp_path):
    (tmp_path / "p.txt").write_text("Nucleotide\tSequence\tHQ_profile\n1\tA\tnan\n2\tC\t0.5\n")
    p = read_profile(spark, str(tmp_path / "p.txt"))
    assert [tuple(r) for r in p.collect()] == [(1.0, "A", None), (2.0, "C", 0.5)]
    df = p.select((F.col("Nucleotide") - 1).cast("int").alias("pos"), F.col("HQ_profile").alias("value"), F.lit(0.1).alias("stderr"), F.lower("Sequence").alias("nt"))
    write_shape(df, str(tmp_path / "s"))
    write_map(df, str(tmp_path / "m"))
    assert sorted(map(tuple, read_shape(spark, str(tmp_path / "s")).collect())) == [(0, None), (1, 0.5)]
    assert [r.value for r in spark.read.text(str(tmp_path / "m")).collect()] == ["1\t-999\t0\tA", "2\t0.500000\t0.100000\tC"]
    (tmp_path / "c.ct").write_text("3 name\n1 G 0 2 3 1\n2 A 1 3 0 2\n3 C 2 4 1 3\n")
    assert sorted(tuple(r) for r in read_ct(spark, str(tmp_path / "c.ct")).collect()) == [(0, "G", True), (1, "A", False), (2, "C", True)]


def test_off_target_coverage_of_nothing(spark):
    assert coverage(spark.createDataFrame([], "rna string, left int, right int"), ["rna"]).count() == 0


def test_repeated_and_many_tags(spark, tmp_path):
    line = ["r", "0", "x", "1", "30", "4M", "*", "0", "0", "ACGT", "IIII", "MD:Z:4", "AS:i:1", "AS:i:2"] + [f"{a}{b}:i:{i}" for i, (a, b) in enumerate((a, b) for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP")]
    path = tmp_path / "a.sam"
    path.write_text("\t".join(line) + "\n")
    tags = read_sam(spark, str(path)).first().tags
    assert tags["AS"] == "2" and tags["MD"] == "4" and tags["zP"] == str(26 * 42 - 1) and len(tags) == 2 + 26 * 42
