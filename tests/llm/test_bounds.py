import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riboscan.llm import packing
from riboscan.llm.packing import optimal_bounds, pack


@pytest.mark.parametrize("exact", [packing.EXACT, 70])
def test_bounds_are_lengths_that_occur(spark, monkeypatch, exact):
    monkeypatch.setattr(packing, "EXACT", exact)
    rng = random.Random(2)
    lengths = [rng.randint(1025, 9000) for _ in range(60)] + [rng.randint(1, 1024) for _ in range(20)]
    docs = spark.createDataFrame([(i, "w " * n) for i, n in enumerate(lengths)], "doc_id long, text string")
    got = pack(spark, docs, buckets=4).collect()
    assert sorted(r.n_tokens for r in got) == sorted(lengths)
    bounds = sorted({r.bucket_tokens for r in got})
    assert len(bounds) == 4 and set(bounds) <= set(lengths) and bounds[-1] == max(lengths)
    for b in bounds:
        assert min(r.padding for r in got if r.bucket_tokens == b) == 0
    assert all(r.n_tokens <= r.bucket_tokens for r in got)
    if exact > len(lengths):
        assert bounds == optimal_bounds(*np.unique(lengths, return_counts=True), 4)


def all_splits(at, n, buckets):
    """Least sum of padded tokens, every split of every prefix tried."""
    total = np.concatenate([[0], np.cumsum(n)])
    cost = np.where(np.arange(len(at) + 1) > 0, np.inf, 0.0)
    for _ in range(buckets):
        cost = np.array([0.0, *[(cost[:j] + (total[j] - total[:j]) * at[j - 1]).min() for j in range(1, len(at) + 1)]])
    return int(cost[-1])


def padded(at, n, bounds):
    return int((np.array(bounds)[np.searchsorted(bounds, at)] * n).sum())


def test_bounds_stay_optimal_with_any_number_of_lengths(spark):
    rng = np.random.default_rng(5)
    lengths = np.concatenate([rng.permutation(np.arange(1, 70000))[: packing.EXACT + 2000], rng.integers(1, 3000, 4000)])
    docs = spark.createDataFrame([(i, str(n)) for i, n in enumerate(lengths.tolist())], "doc_id long, text string")
    got = pack(spark, docs, buckets=3, tokens=lambda text: F.col(text).cast("long")).select("n_tokens", "bucket_tokens", "padding").toPandas()
    at, n = np.unique(lengths, return_counts=True)
    assert len(at) > packing.EXACT and len(got) == len(lengths) and (got.bucket_tokens - got.n_tokens == got.padding).all()
    assert got.bucket_tokens.sum() == all_splits(at, n, 3)


def test_bounds_do_not_depend_on_the_slice(monkeypatch):
    rng = np.random.default_rng(6)
    for m in (1, 2, 9, 300):
        at, n = np.sort(rng.permutation(4 * m)[:m]), rng.integers(1, 4, m)
        want = optimal_bounds(at, n, 5)
        assert padded(at, n, want) == all_splits(at, n, 5)
        for exact in (1, 7, 299):
            monkeypatch.setattr(packing, "EXACT", exact)
            assert optimal_bounds(at, n, 5) == want
        monkeypatch.undo()


def test_pipeline_bounds_have_no_switch(spark, monkeypatch):
    monkeypatch.setattr(packing, "EXACT", 70)
    rng = np.random.default_rng(8)
    lengths = np.concatenate([rng.permutation(np.arange(1025, 6000))[:1500], rng.integers(1, 1025, 100)])
    docs = spark.createDataFrame([(i, "w " * n) for i, n in enumerate(lengths.tolist())], "doc_id long, text string")
    got = corpus_pipeline.packing(spark, docs, "").select("doc_id", "text", "n_tokens", "bucket_tokens").toPandas().sort_values("doc_id")
    assert got.n_tokens.tolist() == lengths.tolist() and got.text.tolist() == ["w " * n for n in lengths.tolist()]
    assert got.bucket_tokens.sum() == all_splits(*np.unique(lengths, return_counts=True), 8)


PLACE = ["bucket", "batch", "slot"]


def places(got):
    """doc_ids in the order of their places."""
    return got.sort_values(PLACE).doc_id.tolist()


def test_pipeline_places_have_no_switch_at_a_number_of_documents(spark):
    docs = spark.range(packing.SHARD + 1).select(F.col("id").alias("doc_id"), F.lit("w w").alias("text"))
    more = corpus_pipeline.packing(spark, docs, "").toPandas()
    less = corpus_pipeline.packing(spark, docs.where(F.col("doc_id") < packing.SHARD), "").toPandas()
    assert places(less) == [i for i in places(more) if i != packing.SHARD] and len(more) == packing.SHARD + 1
    for got in (less, more):  # 16,384 rows of two tokens fill a batch
        assert got.groupby(["bucket", "shard", "batch"]).size().tolist() == [16384, len(got) - 16384]


def test_places_do_not_depend_on_shards_and_cells(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(docs.select(*[F.lit(None).cast("long").alias(c) if c == "doc_id" else c for c in docs.columns]))
    want = None
    for shard, parts in ((20000, 4096), (40, 4096), (40, 2), (1, 16)):
        monkeypatch.setattr(packing, "SHARD", shard)
        monkeypatch.setattr(packing, "PARTS", parts, raising=False)
        got = pack(spark, docs, budget=3000, buckets=3, carry=("text",)).toPandas()
        for (_, bound), rows in got.groupby(["bucket", "bucket_tokens"]):
            per = max(1, 3000 // max(bound, 1))
            assert sorted(zip(rows.batch, rows.slot, strict=True)) == [(i // per, i % per) for i in range(len(rows))]
            assert rows.groupby("shard").size().max() <= max(shard, per)
            assert rows.groupby("batch").shard.nunique().max() == 1 and sorted(rows.shard.unique()) == list(range(rows.shard.max() + 1))
        line = got.sort_values(PLACE)[[*PLACE, "doc_id", "text"]].fillna(-1).values.tolist()
        assert want is None or line == want
        want = line
