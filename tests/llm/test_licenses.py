"""The licence query against every template at every place, in plain Python."""

import math
import re

import duckdb
from pyspark.sql import functions as F

from riboscan.llm.divergence import OP5_SQL, judge, op5_distribution_divergence
from riboscan.llm.licenses import AGREE, ANCHORS, TEMPLATES, WORD, op9_license_positions, scan_licences

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts):
    words = [re.findall(WORD, (t or "").translate(LOW)) for t in texts]
    vocabulary = {w for t in TEMPLATES for w in t.text.split()}
    df = {w: sum(w in set(x) for x in words) for w in vocabulary}
    idf = {w: math.log((len(texts) + 1) / (n + 1)) + 1 for w, n in df.items()}
    out = []
    for x in words:
        base, labels, score = [], set(), 0.0
        for t in TEMPLATES:
            own = t.text.split()
            size = ANCHORS if t.least < 1 else max(1, min(3, len(own) - 1))
            at = sorted(range(len(own)), key=lambda i: (-idf[own[i]], i))[:size]  # noqa: B023
            need = len(at) if t.least == 1 else AGREE
            for s in range(-len(own), len(x)):
                here = lambda i: x[s + i] if 0 <= s + i < len(x) else None  # noqa: B023, E731
                if sum(here(i) == own[i] for i in at) < need:
                    continue
                keys = [(j, k.split()) for k in t.keys for j in [next(j for j in range(len(own)) if own[j : j + len(k.split())] == k.split())]]
                if not all(here(j + i) == w for j, k in keys for i, w in enumerate(k)):
                    continue
                share = round(sum(idf[w] for i, w in enumerate(own) if here(i) == w) / sum(idf[w] for w in own), 6)
                score = max(score, share)
                if share >= t.least - 1e-9:
                    labels.add(t.label)
                if t.base:
                    base.append((s, t.label))
        first, last = (min(base)[0], max(base)[0]) if base else (None, None)
        out.append((len(x), len(base), first, last, ",".join(sorted({b for _, b in base})), ",".join(sorted(labels)), score))
    return out


def same(got, want):
    assert got[:6] == want[:6] and abs(got[6] - want[6]) < 2e-6, (got, want)


def cells(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)


def test_query_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = dict(zip(docs, brute(list(docs.values())), strict=True))
    got = op9_license_positions(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs) and any(w[1] for w in want.values())
    for r in got:
        same(cells(r), want[r.doc_id])


def test_whole_and_changed_licences(spark):
    full = [t for t in TEMPLATES if len(t.text.split()) > 30]
    texts = [f"Intro words. {t.text.title()}, and the end" for t in full]
    texts += [" ".join(w for i, w in enumerate(t.text.split()) if i != 5) for t in full]  # a word is missing
    texts += [t.text.replace(t.keys[0], "other words") for t in full] + ["cc by cc by CC-BY", "", None, "license " * 500, "gnu general public license " * 200]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").withColumn("w", F.lit(1)).withColumn("hits", F.lit(2)).withColumn("places", F.lit(2))
    got = {r.doc_id: cells(r) for r in scan_licences(df).collect()}
    for i, w in enumerate(brute(texts)):
        same(got[i], w)
    for i, t in enumerate(full):
        assert t.label in got[i][5].split(",") and got[i][6] == 1.0


def test_divergence_matches_its_sql(spark, sf_dir):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    out = c.execute(OP5_SQL)
    names = [x[0] for x in out.description]
    want = {r[0]: dict(zip(names, r, strict=True)) for r in out.fetchall()}
    got = {r.doc_id: r.asDict() for r in op5_distribution_divergence(spark, sf_dir).collect()}
    assert got == want and len({r["kept"] for r in got.values()}) == 2


def test_any_language_has_its_reference(spark):
    text = "the {} and the {} of a {} is in that {} to {} with more words here and there, and so on."
    words = [f"w{i}" for i in range(40)]
    docs = [(i, text.format(*(words[(i * 3 + j) % 40] for j in range(5))), "xx" if i % 2 else None) for i in range(120)]
    docs += [(500, "@@@ ### 123 456 789 000 111 222 333 444 555 666 777 888 999 " + " ".join(str(i) * 7 for i in range(30)), "xx"), (501, docs[0][1] + " 1", "only")]
    got = {r.doc_id: r for r in judge(spark, spark.createDataFrame(docs, "doc_id long, text string, lang string"), least_words=10).collect()}
    assert all(got[i].kept for i in range(120)) and not got[500].kept and got[501].kept and got[501].class_distance < 1e-6
    assert got[0].class_distance is None and got[1].class_distance is not None
