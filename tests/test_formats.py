import pytest

from riboscan.sources.text import read_fasta, read_map, write_fasta, write_map


def test_map_files(spark, tmp_path):
    df = spark.createDataFrame([(0, None, None, "a"), (1, 0.5, 0.25, "T"), (2, -0.5, 0.0, "g")], "pos int, value double, stderr double, nt string")
    write_map(df, str(tmp_path / "m"))
    assert sorted(map(tuple, read_map(spark, str(tmp_path / "m")).collect())) == [(0, None, 0.0, "A"), (1, 0.5, 0.25, "U"), (2, -0.5, 0.0, "G")]
    (tmp_path / "n.map").write_text("1\t-999.000\t-999\tA\n2\tnan\t1e-1\tC\n")
    assert sorted(map(tuple, read_map(spark, str(tmp_path / "n.map")).collect())) == [(0, None, None, "A"), (1, None, 0.1, "C")]
    (tmp_path / "short.map").write_text("1\t0.5\t0.1\n")
    with pytest.raises(Exception, match="short .map line"):
        read_map(spark, str(tmp_path / "short.map")).collect()


def test_fasta_round_trip(spark, tmp_path):
    rows = [("a", "ACGU" * 50), ("b", "A" * 81), ("c", "UuG")]
    write_fasta(spark.createDataFrame(rows, "name string, seq string"), str(tmp_path / "f"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "f")).collect()]
    assert lines[0] == ">a" and [len(x) for x in lines[1:4]] == [81, 81, 38] and lines[4:] == [">b", "A" * 81, ">c", "TuG"]
    got = {r.name: r.seq for r in read_fasta(spark, str(tmp_path / "f/*.txt")).collect()}
    assert got == {n: s.replace("U", "T") for n, s in rows}
