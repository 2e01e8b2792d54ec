import itertools
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riboscan.llm import decontaminate, packing
from riboscan.llm.decontaminate import drop_leaks, find_leaks, lcs, place_masks, randomised_svd
from riboscan.llm.divergence import op5_distribution_divergence
from riboscan.llm.licenses import WORD, op9_license_positions, scan_licences
from riboscan.llm.packing import op2_length_buckets, optimal_bounds, pack
from riboscan.llm.pseudonyms import Permutation, Pseudonyms, luhn, pseudonymise
from riboscan.llm.quality import FEATURES, RuleEnsemble, held_out, keep_good, op3_rule_ensemble, score_quality
from riboscan.llm.urls import OP7_SQL, judge_urls, op7_bloom_url_filter
from riboscan.llm.warc import OP1_SQL, LoserTree, archive_and_index, key_of, op1_warc_index_merge, url_key

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, batch long, words string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    rows = [(1, None, None, None, None, None, None, None), (2, "", "en", "s", 0, 1.0, 1, "w"), (3, "Plain words, and the end.", "en", "s", 25, 1.0, 1, "w")]
    rows += [rows[2], (None, "The of and to. " * 30, "xx", "s", 450, 0.0, 2, "w"), (5, "long é text " * 60000, "fr", "s", 720000, 0.0, 3, "w")]
    return spark.createDataFrame(rows, DOCS)


def sql(sf_dir, text, *tables):
    c = duckdb.connect()
    for t in tables:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    out = c.execute(text)
    names = [x[0] for x in out.description]
    return sorted((dict(zip(names, r, strict=True)) for r in out.fetchall()), key=str)


def rows(df, names):
    return sorted(({n: r[n] for n in names} for r in df.collect()), key=str)


# 1: archives


def test_archives_match_sql(spark, sf_dir):
    want = sql(sf_dir, OP1_SQL, "pages")
    assert rows(op1_warc_index_merge(spark, sf_dir), list(want[0])) == want


def test_archives_of_odd_pages_are_in_order(spark):
    pages = [(1, "http://b.org/x", "a\r\n\r\nWARC/1.1\r\n\r\nb", 5, "e"), (2, None, None, None, "e"), (3, "http://a.org/?q=\r\nX: y", "", 9, "e"), (4, "http://b.org/x", "é" * 50000, 1, "e"), (4, "http://b.org/x", "é" * 50000, 1, "e"), (None, "::", "é" * 50000, 2, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, captured long, archive string")
    got = archive_and_index(spark, df).collect()
    assert [key_of(tuple(r)) for r in got] == sorted(key_of(tuple(r)) for r in got) and len(got) == 6
    by = {(r.page_id, r.record_type): r for r in got}
    assert by[3, "response"].payload_bytes == 0 and by[2, "revisit"].refers_to == 3
    assert by[None, "revisit"].refers_to == 4 and by[None, "revisit"].payload_bytes == 100000 and by[None, "revisit"].payload_digest == by[4, "response"].payload_digest
    assert archive_and_index(spark, df.limit(0)).count() == 0
    assert url_key("HTTP://www.B.org:80/x/?q=1#z") == "org,b)/x?q=1"


def test_loser_tree_merges_any_runs():
    rng = random.Random(2)
    for k in range(9):
        runs = [sorted(((rng.choice("abc"), "1", rng.choice([None, 1, 2, 3])) for _ in range(rng.randint(0, 6))), key=key_of) for _ in range(k)]
        assert [key_of(r) for r in LoserTree(runs)] == sorted(key_of(r) for run in runs for r in run)


# 2: packing


def test_bounds_are_optimal():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 9)
        at, count, b = np.array(sorted(rng.sample(range(60), n))), np.array([rng.randint(1, 9) for _ in range(n)]), rng.randint(1, 4)
        cost = lambda bounds: sum(int(c) * (min(x for x in bounds if x >= v) - int(v)) for v, c in zip(at, count, strict=True))
        best = min(cost([*c, int(at[-1])]) for r in range(min(b, n)) for c in itertools.combinations(at[:-1].tolist(), r))
        got = optimal_bounds(at, count, b)
        assert len(got) <= b and got == sorted(got) and cost(got) == best


def test_batches_keep_the_budget(spark, sf_dir, odd, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 40)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = pack(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), budget=3000, buckets=4).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    batches: dict = {}
    for r in got:
        assert r.n_tokens == len(texts[r.doc_id].encode().split()) and r.padding == r.bucket_tokens - r.n_tokens >= 0
        batches.setdefault((r.bucket, r.shard, r.batch), []).append(r)
    for b in batches.values():
        assert len(b) == 1 or len(b) * b[0].bucket_tokens <= 3000
        assert sorted(r.slot for r in b) == list(range(len(b)))
    assert pack(spark, odd).count() == 6 and pack(spark, odd.limit(0)).count() == 0
    assert op2_length_buckets(spark, sf_dir).count() == len(texts)


# 3: quality


def test_quality_on_held_out_rows(spark, sf_dir, odd):
    d = sf_dir.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = op3_rule_ensemble(spark, d).join(labels, "doc_id").filter("held_out").toPandas()
    assert len(got) > 100 and (got.predicted == got.quality).mean() >= 0.95
    out = score_quality(spark, odd, labels.limit(0)).collect()
    assert len(out) == 6 and {r.score for r in out} == {0.5}
    assert score_quality(spark, odd.limit(0), labels).count() == 0
    assert keep_good(spark, odd, labels).columns == odd.columns
    assert {r.doc_id: r.h for r in spark.range(3).select(F.col("id").alias("doc_id"), held_out("id").alias("h")).collect()} == {i: __import__("zlib").crc32(str(i).encode()) % 3 == 1 for i in range(3)}


def test_rules_as_columns_score_as_in_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((600, len(FEATURES)))
    y = ((x[:, 3] > 0.5) & (x[:, 7] < 0.6)).astype(float)
    model = RuleEnsemble(trees=10).fit(x, y)
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.97 and 0 < len(model.rules) < 100
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["i", *FEATURES]).select("i", F.struct(*FEATURES).alias("_stats"))
    got = np.array([r.s for r in df.select("i", model.column().alias("s")).orderBy("i").collect()])
    assert np.allclose(got, model.score(x))


# 5: divergence


def test_base_counts_match_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in op5_distribution_divergence(spark, sf_dir).collect():
        t = texts[r.doc_id]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        five = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        seen = {x: five.count(x) for x in set(five)}
        covered = {j for i, x in enumerate(five) if seen[x] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        assert r.base_failed == failed and not (failed and r.kept)


def test_divergence_rules_out_junk_and_keeps_odd_rows(spark, odd):
    from riboscan.llm.divergence import judge

    good = [f"the {a} and the {b} of a {c} is in that {a} to {c}." for a in ("house", "river", "field") for b in ("stone", "cloud") for c in ("bird", "road", "song", "wall")]
    junk = [" ".join(f"{w}### $$${w.upper()}" for w in g.split()) for g in good[:3]]
    docs = spark.createDataFrame([(i, " ".join(dict.fromkeys(t.split() + good[i % 7].split() + good[(i + 11) % 24].split() + good[(i * 5) % 24].split())), "en") for i, t in enumerate(good + junk)], "doc_id long, text string, lang string")
    kept = {r.doc_id: (r.kept, r.base_failed) for r in judge(spark, docs, least_words=10).collect()}
    assert all(kept[i] == (True, False) for i in range(24)) and not any(kept[i][0] for i in range(24, 27))
    assert judge(spark, odd).count() == 6 and judge(spark, odd.limit(0)).count() == 0


# 7: urls


def test_urls_match_sql(spark, sf_dir):
    for d in (sf_dir, sf_dir.replace("0.001", "0.01")):
        want = sql(d, OP7_SQL, "pages")
        assert rows(op7_bloom_url_filter(spark, d), list(want[0])) == want


def test_odd_urls(spark):
    urls = [None, "", "x", "://", "http://", "HTTP://A.Net/de/1", "http://net/de/", "http://xnet/de/", "http://example.net/de/81", "http://example.com/en/7?a", "http://B.example.com/en/8", "a://h?x://y/z", "http://é.Ä/p\nq"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls + [urls[-1]])], "page_id long, url string, host string, rule string")
    listed = spark.createDataFrame([("https://www.é.Ä/p\nq/",), (None,), ("junk",)], "url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(spark, pages, listed).collect()}
    assert [got[i] for i in range(5)] == [("", "", None, "allow")] * 5
    assert got[5] == ("a.net", "/de/1", "net/de/", "allow") and got[6][2] == "net/de/" and got[7][2] is None
    assert got[8][2:] == ("example.net/de/8", "block") and got[9][2:] == ("example.com/en/7", "allow") and got[10][2:] == ("com/en/", "block")
    assert got[11][:2] == ("h", "") and got[12] == got[13] == ("é.Ä", "/p\nq", None, "block")
    assert judge_urls(spark, pages.limit(0), listed).count() == 0 and judge_urls(spark, pages, listed.limit(0)).count() == 14


# 8: decontamination


def test_leaks_are_found_and_clean_documents_left(spark, odd, monkeypatch):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abdegiklmnoprstu", k=rng.randint(3, 9)))
    common = ["the", "of", "and", "to", "in"]
    prose = lambda n: [rng.choice(common) if rng.random() < 0.4 else word() for _ in range(n)]
    items = [" ".join(prose(rng.choice([16, 30, 55]))) + ". " + " ".join(prose(8)) + "." for _ in range(12)]
    texts, want = [], set()
    for i in range(150):
        w = prose(rng.randint(40, 400))
        if i % 3 == 0:
            item = i % 12
            part = items[item].split()
            if i % 2:  # a paraphrase: every eighth word is another
                part = [word() if j % 8 == 3 else x for j, x in enumerate(part)]
            at = rng.randrange(len(w))
            w[at:at] = [x.upper() for x in part]
            want.add((i, item))
        texts.append((i, " ".join(w), "en", "s", 1, 0.0, 1, "w"))
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, "two words"), (None, "x")], "item_id long, text string")
    docs = spark.createDataFrame(texts, DOCS).union(odd)
    assert {(r.doc_id, r.item_id) for r in find_leaks(spark, docs, bench).collect()} == want
    left = drop_leaks(spark, docs, bench)
    assert left.columns == docs.columns and left.count() == 156 - len(want)
    monkeypatch.setattr(decontaminate, "ITEMS", 5)
    assert {(r.doc_id, r.item_id) for r in find_leaks(spark, docs, bench).collect()} == want
    assert find_leaks(spark, docs.limit(0), bench).count() == 0 and find_leaks(spark, docs, bench.limit(0)).count() == 0


def test_subsequence_and_svd(spark):
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(1, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        assert lcs(place_masks(a), b, len(a)) == t[-1][-1]
    gen = np.random.default_rng(2)
    docs = [gen.integers(0, 30, gen.integers(0, 90)).astype(np.uint16) for _ in range(60)]
    df = spark.createDataFrame([(d.tobytes(),) for d in docs], "words binary")
    idf = np.zeros(decontaminate.FEATURES)
    idf[:30] = gen.random(30) + 0.5
    vectors, values = randomised_svd(df, idf, rank=5, extra=25)
    a = []
    for d in docs:
        blocks = [np.bincount(d[i : i + 16], minlength=30) for i in range(0, len(d), 16)]
        a += [x + y for x, y in zip(blocks, blocks[1:], strict=False)] if len(blocks) > 1 else blocks
    u = np.linalg.svd(np.array(a) * idf[:30])
    assert np.allclose(values, u[1][:5], rtol=1e-3) and np.allclose(np.abs((vectors * u[2][:5].T).sum(0)), 1, atol=1e-2)


# 9: licences


def test_licences_match_brute_force(spark, sf_dir, odd):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    d = sf_dir.replace("0.001", "0.01")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in op9_license_positions(spark, d).collect():
        w = re.findall(WORD, texts[r.doc_id].translate(low))
        at = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None)) and 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert scan_licences(odd).count() == 6 and scan_licences(odd.limit(0)).count() == 0
    notice = spark.createDataFrame([(1, "x. Permission is hereby granted, free of charge, to any person obtaining a copy of this software"), (2, "CC BY-NC 4.0 cc. by")], "doc_id long, text string")
    got = {r.doc_id: r for r in scan_licences(notice).collect()}
    assert got[1].labels == "mit" and got[1].base_labels == "" and got[2].labels == "cc-by,cc-by-nc" and got[2].n_base == 2


# 10: pseudonyms


def test_permutation_is_one_to_one_and_undone():
    for size in (1, 2, 7, 100, 997):
        p = Permutation(b"k", "t", size)
        assert sorted(p(x) for x in range(size)) == list(range(size)) and all(p(p(x), True) == x for x in range(size))
    even = Permutation(b"k", "t", 1000, lambda x: x % 2 == 0)
    assert sorted(even(x) for x in range(0, 1000, 2)) == list(range(0, 1000, 2))


@pytest.mark.parametrize("value", ["und.34@mail7.example.com", "+1 (988) 555-2485", "4845168114407329", "4845 1681 1440 7329", "97.51.17.173", "2021-02-28", "28.02.2021", "12/31/1999", "123-45-6789", "DE89 3704 0044 0532 0130 00", "é.Long" * 40 + "@x.org"])
def test_values_keep_their_format(value):
    p = Pseudonyms(b"key")
    text = f"Aé {value}, and {value} again"
    out, kinds = p.replace(text)
    assert len(kinds) == 2 and value not in out and len(set(out.removeprefix("Aé ").removesuffix(" again").split(", and "))) == 1
    assert p.replace(out, back=True)[0] == text and Pseudonyms(b"other").replace(text)[0] != out
    if value.startswith("4845"):
        digits = re.sub(r"\D", "", out.split(",")[0])
        assert luhn(digits[:-1]) == int(digits[-1])


def test_invalid_values_stay(spark, odd):
    for text in ("4845168114407320", "256.1.1.1", "1.2.3.4.5", "2021-02-30", "000-12-3456", "DE00 3704 0044 0532 0130 00", "version 1.2.3", "@", "x@y", "12345"):
        assert Pseudonyms(b"key").replace(text) == (text, [])
    out = pseudonymise(odd, b"k")
    assert out.count() == 6 and out.drop("_kinds").exceptAll(odd).count() == 0 and pseudonymise(odd.limit(0), b"k").count() == 0


# the pipeline


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_dir)
        assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in packed} == ids and 50 < len(ids) < docs.count()
    leaks = {r.doc_id for r in find_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert leaks and not ids & leaks


def test_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
