"""Linear work on long texts, columns of any name, and odd rows through all stages."""

import base64
import datetime
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riboscan.llm.core import free_name
from riboscan.llm.decontaminate import drop_leaks, find_leaks
from riboscan.llm.divergence import judge
from riboscan.llm.licenses import scan_licences
from riboscan.llm.near_dedup import drop_near_duplicates, near_duplicates
from riboscan.llm.packing import pack
from riboscan.llm.pseudonyms import Pseudonyms, luhn, op10_feistel_pseudonyms, pseudonymise
from riboscan.llm.quality import keep_good
from riboscan.llm.secrets import find_secrets, redact_secrets, scanner
from riboscan.llm.urls import judge_urls

LONG = 5_000_000
NAMES = ["_h", "_stats", "_kinds", "_deal", "found", "spans", "n_tokens", "batch", "slot", "score", "word", "words", "sig", "fp", "keys", "comp", "n", "h", "_y", "w", "hits", "cosine", "item_id", "at", "block"]


def long_texts():
    noise = base64.b64encode(np.random.default_rng(1).bytes(LONG * 3 // 4)).decode()
    return {"eyJ": "eyJ" * (LONG // 3), "letters": "a" * LONG + "1", "base64": noise, "digits": "1" * LONG, "at": "a@" * (LONG // 2), "dots": "a." * (LONG // 2) + "@", "keys": "-----BEGIN PRIVATE " * (LONG // 19), "tokens": "eyJa.eyJb.c" * (LONG // 11)}


@pytest.mark.parametrize("name", list(long_texts()))
def test_long_texts_take_linear_time(name):
    text = long_texts()[name]
    data = np.frombuffer(text.encode(), np.uint8)
    scanner()
    began = time.process_time()
    scanner().scan(data, np.array([0, len(data)]))
    middle = time.process_time()
    Pseudonyms(b"k").replace(text)
    assert middle - began < 10 and time.process_time() - middle < 10


def clashing(spark, rows):
    """(doc_id, text) with a column of every inner name; each holds its row's number times its own."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row long, doc_id long, text string")
    return df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), *[(F.col("row") * (j + 1)).alias(n) for j, n in enumerate(NAMES)])


TEXTS = ["A plain text of some words that says little, and then a bit more.", 'The token = "abcdefgh1234" is here, in the open.', "Call +1 (988) 555-2485 or 28.02.2021.", "", None]


def test_columns_of_any_name_come_through(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1]), (None, TEXTS[0]), (7, TEXTS[0] + " x")]
    docs = clashing(spark, rows)
    plain = {(r.doc_id, r.text, *[r[n] for n in NAMES]) for r in docs.collect()}
    bench = spark.createDataFrame([(1, "no such words as these are anywhere in it at all, or are they. None of them.")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    same = {"quality": keep_good(spark, docs, labels), "leaks": drop_leaks(spark, docs, bench)}
    for name, out in same.items():
        assert out.columns == docs.columns, name
        assert {(r.doc_id, r.text, *[r[n] for n in NAMES]) for r in out.collect()} == plain, name
    out = drop_near_duplicates(spark, docs)
    assert out.columns == docs.columns and {(r.doc_id, r.text, *[r[n] for n in NAMES]) for r in out.collect()} == plain - {p for p in plain if p[0] == 7}
    for name, out in {"secrets": redact_secrets(docs), "pseudonyms": pseudonymise(docs, b"k").select(docs.columns)}.items():
        assert out.columns == docs.columns, name
        assert sorted(str((r.doc_id, *[r[n] for n in NAMES])) for r in out.collect()) == sorted(str((p[0], *p[2:])) for p in [(r.doc_id, r.text, *[r[n] for n in NAMES]) for r in docs.collect()]), name
    assert pseudonymise(docs, b"k").columns == [*docs.columns, "__kinds"] and free_name(["a", "_A"], "a") == "__a"
    packed = pack(spark, docs, carry=("text", "batch", "n_tokens"))
    assert packed.columns[-3:] == ["text", "_batch", "_n_tokens"] and {(r.doc_id, r.text, r._batch) for r in packed.collect()} == {(p[0], p[1], p[2 + NAMES.index("batch")]) for p in plain}
    for out in (near_duplicates(spark, docs), judge(spark, docs), scan_licences(docs), find_secrets(docs), pack(spark, docs)):
        assert out.count() == len(rows)
    assert find_leaks(spark, docs, bench).count() == 0
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), "_h", "score").withColumn("verdict", F.lit(1)).withColumn("_listed", F.lit(1))
    assert judge_urls(spark, pages, pages.select("url")).count() == len(rows)


def test_pipeline_takes_odd_rows(spark, tmp_path):
    words = [f"w{i}x" for i in range(400)]
    rows = [(i, " ".join(words[i : i + 60])) for i in range(0, 300, 30)] + [(500, None), (501, ""), (502, "long é text " * 60000), (None, "Some words without any number of their own."), (None, None), (0, " ".join(words[:60])), (503, 'token = "abcdefgh1234" ' + " ".join(words[350:])), (504, " ".join(words[30:89]))]
    docs = clashing(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, None), (2, ""), (3, " ".join(words[95:130])), (None, "x")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(0, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = [r.doc_id for r in got]
    # 504 nearly repeats 30; 60 and 90 hold (most of) the passage, 120 ten words of it; both rows of 0 stay
    assert sorted(x for x in ids if x is not None) == [0, 0, 30, *range(120, 300, 30), 500, 501, 502, 503] and ids.count(None) == 2
    texts = {r.doc_id: r.text for r in got}
    assert texts[503].startswith("[assign]") and texts[500] is None and texts[501] == "" and len(texts[502]) == 720000
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == clashing(spark, rows).columns


def test_session_settings_stay(spark, sf_dir):
    before = dict(spark.conf.getAll)
    corpus_pipeline.run(spark, sf_dir).count()
    assert dict(spark.conf.getAll) == before


def test_one_day_has_one_pseudonym():
    p = Pseudonyms(b"key")
    for day in (datetime.date(1999, 12, 31), datetime.date(2001, 2, 3), datetime.date(2012, 6, 13)):
        out = set()
        for form in ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y", *(["%d/%m/%Y"] if day.day > 12 else [])):
            text, kinds = p.replace(f"x {day.strftime(form)}.")
            assert kinds == ["date"] and p.replace(text, back=True)[0] == f"x {day.strftime(form)}."
            out.add(datetime.datetime.strptime(text[2:-1], form).date())
        assert len(out) == 1 and day not in out


def test_values_inside_refused_ones():
    p = Pseudonyms(b"key")
    for text, kinds in (("AB12 4111111111111111", ["card"]), ("x@y a.b@c.org@d.de", ["email"]), ("a@b@c.org", ["email"]), ("(030) 123-4567.me@x.org", ["phone", "email"]), ("12.12.2020-me@x.org", ["email"])):
        out, found = p.replace(text)
        assert found == kinds and p.replace(out, back=True)[0] == text


def test_pseudonyms_query_against_brute_force(spark, sf_dir):
    """Kinds and places by simple patterns of the kinds that the table holds; the text around values stays."""
    shapes = {"email": r"[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "phone": r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}", "ip": r"\d+\.\d+\.\d+\.\d+", "card": r"\d{16}"}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").collect()}
    seen, total = {}, 0
    for r in op10_feistel_pseudonyms(spark, sf_dir.replace("0.001", "0.01")).collect():
        text, at = texts[r.doc_id], 0
        assert (text is None) == (r.text is None)
        found = {k: [] for k in shapes}
        for m in re.finditer("|".join(f"(?P<{k}>(?<!\\w){s}(?!\\w))" for k, s in shapes.items()), text or ""):
            k, value = m.lastgroup, m[0]
            if k == "card" and (value[0] == "0" or luhn(value[:-1]) != int(value[-1])) or k == "ip" and max(map(int, value.split("."))) > 255:
                continue
            found[k].append(m.span())
        for k, spans in found.items():
            assert r[f"n_{k}"] == len(spans), (r.doc_id, k)
        assert r.n_found == sum(map(len, found.values()))
        if len(r.text or "") == len(text or ""):
            for k, spans in found.items():
                for a, b in spans:
                    assert seen.setdefault((k, text[a:b]), r.text[a:b]) == r.text[a:b]
                    total += 1
            for a, b in [*sorted(s for x in found.values() for s in x), (len(text or ""), 0)]:
                assert (text or "")[at:a] == (r.text or "")[at:a]
                at = b
        if text:
            assert Pseudonyms(b"pseudonym key of the query").replace(r.text, back=True)[0] == text
    assert total > 20 and len(set(seen.values())) == len(seen)
