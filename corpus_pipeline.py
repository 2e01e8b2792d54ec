"""A training corpus from raw documents: five operators, each stage written and read again.

Quality rules out bad documents; of each group of near duplicates one stays;
documents with benchmark passages go; secrets are replaced in the texts; the
rest is packed into batches, texts and all. Every stage takes null, empty and
very long texts, repeated rows, null doc_ids, empty tables and columns of any
name; what becomes of them stands in the stage's docstring. A stage bounds the
rows of an Arrow batch in a session without a bound of its own, since its result
runs later; ``run`` leaves the session's settings as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riboscan.llm.core import Workspace, bound_batches, small_batches, table
from riboscan.llm.decontaminate import drop_leaks
from riboscan.llm.near_dedup import drop_near_duplicates
from riboscan.llm.packing import pack
from riboscan.llm.quality import keep_good
from riboscan.llm.secrets import redact_secrets


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.5 or more.

    Null texts score as empty ones; repeated rows and null doc_ids are scored
    like any other. Without labels every document stays.
    """
    bound_batches(spark)
    return keep_good(spark, docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a five-word shingle similarity of 0.8 or more: that with the smallest doc_id.

    Rows that repeat a kept doc_id all stay, as do null doc_ids.
    """
    bound_batches(spark)
    return drop_near_duplicates(spark, docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. Null and empty texts hold none; repeated rows share their fate."""
    bound_batches(spark)
    return drop_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind in brackets and ``n_chars`` following; null and empty texts stay as they are."""
    bound_batches(spark)
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's text and where it lies in batches of 32,768 tokens.

    Null and empty texts have 0 tokens and a slot; repeated rows take one each.
    """
    return pack(spark, docs, carry=("text",))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("packing", packing)]

#: The stages hold a trained model, a latent space and an automaton: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):
        for i, (name, stage) in enumerate(STAGES):
            docs = ws.keep(stage(spark, docs, sf_dir), f"{i}-{name}")
            if i:
                ws.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return docs
