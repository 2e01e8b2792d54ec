"""The trim query over whole texts."""

import re

import duckdb
from pyspark.sql import functions as F

from riboscan.operators.reads import trim_quality, trim_quality_strings
from riboscan.plans.queries import QUERIES, SQL


def brute(text):
    seq = re.sub("[^ -~]", "", text)
    cut = next((i for i in range(len(seq) - 5) if sum(ord(c) % 42 for c in seq[i : i + 5]) < 14 * 5), None)
    return "N" if len(seq) < 5 or (cut is not None and cut < 25) else seq[:cut]


def test_whole_texts_are_trimmed(spark, tmp_path):
    good, low = "SPQRO" * 200, "*+*+*+"  # scores of 41, 38, 39, 40, 37 and of 0, 1
    texts = [good, good + low + good, good[:300] + low, good[:24] + low, good[:25] + low + "x", "", "abcd", "abcde", low, "é" * 200 + good, good[:149] + "é" + low + good]
    rows = [*enumerate(texts), (99, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.trimmed for r in QUERIES["quality_trim"](spark, str(tmp_path)).collect()}
    assert got == {i: None if t is None else brute(t) for i, t in rows}
    assert len(got[0]) == 1000 and 990 < len(got[1]) < 1000


def test_long_texts_match_the_sql(spark, sf_dir):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = dict(c.execute(SQL["quality_trim"]).fetchall())
    got = {r.doc_id: r.trimmed for r in QUERIES["quality_trim"](spark, sf_dir).collect()}
    assert got == want and max(len(x or "") for x in got.values()) > 150


def test_both_trims_agree(spark):
    rows = [(1, "ACGT" * 20, "I" * 40 + "#" * 40), (2, "ACGT" * 3, "#" * 12), (3, "ACG", "III"), (4, "ACGTA", "#####"), (5, "A" * 40, "I" * 40), (6, None, None)]
    df = spark.createDataFrame(rows, "id int, seq string, qual string")
    q = df.withColumn("q", F.transform(F.split("qual", ""), lambda c: F.ascii(c) - 33))
    want = {r.id: r.trimmed for r in trim_quality(q, "seq", "q").collect()}
    assert {r.id: r.trimmed for r in trim_quality_strings(df, "seq", "qual", lambda b: b.astype("int64") - 33).collect()} == want
