import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riboscan.llm import near_dedup
from riboscan.llm.bloom import BlockedBloom
from riboscan.llm.core import Workspace
from riboscan.llm.near_dedup import OP6_SQL, components, drop_near_duplicates, near_duplicates, op6_minhash_components
from riboscan.llm.textkit import NOT_ALNUM, Words, hash_word, text_bytes


def brute(texts, k, percent):
    """doc_id -> (set size, smallest doc_id reachable), by all pairs."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in texts:
        w = (t or "").translate(low).encode().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, comp long, key string")


@pytest.mark.parametrize("k", [2, 5])
def test_components_match_all_pairs(spark, k, monkeypatch):
    monkeypatch.setattr(near_dedup, "HOT", 4)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):  # drifting copies: chains whose ends aren't linked
        w = rng.choices(words, k=rng.choice([8, 40, 120]))
        for _ in range(rng.choice([1, 4, 14])):
            texts.append(" ".join(w))
            w = list(w)
            for _ in range(max(1, len(w) // 40)):
                w[rng.randrange(len(w))] = rng.choice(words)
    texts += ["", None, "One", "one", "ONE  \n", "a b", "A B", texts[0], texts[0], "é É", "x " * 3000, "x " * 2999]
    rng.shuffle(texts)
    rows = [(i * 7 % 1009, t, 5, "k") for i, t in enumerate(texts)]
    want = brute([(r[0], r[1]) for r in rows], k, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark, frame(spark, rows), k, 80).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}


def test_odd_rows(spark):
    rows = [(None, "same words here", 1, None), (4, "same words here", 1, None), (4, "same words here", 1, None), (2, "same words here", None, "x"), (9, None, 1, "y")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(spark, frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, None, True), (4, 2, False), (4, 2, False), (2, 2, True), (9, 9, True)], key=str)
    left = drop_near_duplicates(spark, frame(spark, rows))
    assert sorted((r.doc_id for r in left.collect()), key=str) == [2, 9, None] and left.columns == ["doc_id", "text", "comp", "key"]
    assert near_duplicates(spark, frame(spark, rows).limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 130)] + [(200, 201), (203, 202), (201, 202)]
    out = components(spark, Workspace(spark, "test"), spark.createDataFrame(links, "a long, b long"), "x")
    got = {r.id: r.comp for r in out.collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 130)} | {i: 200 for i in range(200, 204)}


def test_rows_of_hot_keys_pass_one_join(spark):
    """No join beside the one that gives a row its key's columns, whether a table has hot keys or not."""
    ws = Workspace(spark, "test")
    for name, shares in (("hot", [(-7, 900), (5, 800)]), ("even", [])):
        ids = iter(range(10**6))
        listed = [(k, next(ids)) for k, n in [*shares, *[(100 + j, 3) for j in range(1100)]] for _ in range(n)]
        rows = ws.keep(spark.createDataFrame(listed, "key long, doc_id long"), f"rows-{name}")
        keys = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).filter("key <> 103")
        out = near_dedup._with_key(ws, rows, keys, f"keys-{name}")
        got = sorted(tuple(r) for r in out.select("key", "doc_id", "n", "least").collect())
        assert got == sorted(tuple(r) for r in rows.join(keys, "key").select("key", "doc_id", "n", "least").collect())
        assert len(got) == len(listed) - 3
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" not in plan and plan.count("Join Inner") == (2 if shares else 1)


def test_links_of_blocks_join_components_only(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    ws = Workspace(spark, "test")
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[:-1], f"x{i}"]) for i in range(120)]  # all linked with all, in two components of 60 so far
    texts += [" ".join([*words[:40], *[f"y{i}-{j}" for j in range(20)]]) for i in range(20)]  # linked with none
    texts += [f"{texts[130]} z", f"{texts[3]} z"]  # linked with one of those, and with all of the first
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    comp = F.when(F.col("doc_id") < 120, F.col("doc_id") % 2).otherwise(F.col("doc_id"))
    hot = docs.select("doc_id", comp.alias("comp"), F.lit(0).cast("long").alias("least"))
    links = near_dedup._linked_blocks(spark, ws, hot, docs, 2, 80).collect()
    want = brute(list(enumerate(texts)), 2, 80)
    assert {want[r.a][1] == want[r.b][1] for r in links} == {True}
    top = {i: i % 2 if i < 120 else i for i in range(len(texts))}
    for r in links:
        x, y = sorted((top[r.a], top[r.b]))
        top = {i: x if c == y else c for i, c in top.items()}
    assert top == {i: c for i, (_, c) in want.items()}
    # two components of eight parts each: 64 groups join them, and one or two rows for each of the 17 parts that 140 and 141 meet
    assert len(links) <= 64 + 2 * 2 * 19


def test_query_matches_sql(spark, sf_dir):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(map(tuple, c.execute(OP6_SQL).fetchall()))
    assert sorted(tuple(r) for r in op6_minhash_components(spark, sf_dir).collect()) == want


def test_bloom_never_misses(spark):
    ids = spark.range(5000).select((F.col("id") * 3).alias("id"))
    bloom = BlockedBloom.of_ids(ids)
    every = spark.range(15000).withColumnRenamed("id", "x")
    hits = {r.x for r in bloom.maybe(every, "x").collect()}
    assert set(range(0, 15000, 3)) <= hits and len(hits) < 5400
    assert {r.x for r in bloom.maybe(every, "x", hit=False).collect()} == set(range(15000)) - hits


def test_words_match_bytes_split():
    import pyarrow as pa

    rng = random.Random(1)
    texts = ["".join(rng.choices(["a", "B", "é", " ", "\n", "\t", "\x0b", "\x1c", ".", "7"], k=rng.randint(0, 30))) for _ in range(300)]
    data, off = text_bytes(pa.array([*texts, None]))
    w = Words(data, off)
    h = w.hashes()
    for i, t in enumerate(texts):
        parts = [x for x in t.encode().lower().replace(b"\x1c", b"\xff").split()]
        assert [hash_word(p.replace(b"\xff", b"\x1c").decode()) for p in parts] == h[w.of[i] : w.of[i + 1]].tolist()
    assert w.of[-1] == w.of[-2]
    data = np.frombuffer("Ab-c é9_x".encode(), np.uint8)
    w = Words(data, np.array([0, len(data)]), NOT_ALNUM)
    assert [bytes(data[a:b]).decode() for a, b in zip(w.start, w.end, strict=True)] == ["Ab", "c", "é9", "x"]
