"""Packing into batches of a token budget, inside optimal length buckets.

The histogram of lengths over all documents is exact at any size: a corpus of T
tokens has at most sqrt(2 T) distinct lengths, 16 bytes each on the driver.
Dynamic programming over it chooses, among all lengths, the bucket bounds that
minimise padding, where each document is padded to its bucket's bound. Inside
each bucket, documents form batches of as many rows as the budget holds at the
padded length.

The rows of a bucket stand in one order, by a hash of doc_id and text, whatever
the table's size, and are numbered through: batches are consecutive rows, and
only the last batch of a bucket can be short. So that no task holds a bucket,
each is cut at fixed values of the hash into PARTS cells, whose rows are
numbered apart and moved up by the rows of the cells before. Shards are runs of
whole batches; they change no batch.
"""

from __future__ import annotations

from collections import deque

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riboscan.llm.core import Workspace, free_name, table

#: Distinct lengths held as Python's exact integers at a time; bounds are the same whatever it is.
EXACT = 16384
#: Cells of a bucket, a power of two; places are the same whatever it is.
PARTS = 4096
#: A shard is as many whole batches as hold at most so many documents and padded tokens, at least one.
SHARD, SHARD_TOKENS = 20000, 1 << 24


def word_tokens(text: str = "text") -> Column:
    """Tokens of the default counter: words ``[^\\x20\\x09-\\x0D]+``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def byte_tokens(text: str = "text") -> Column:
    """Tokens of a byte-level model; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def tokenizer_tokens(path: str):
    """A counter by a ``tokenizers`` vocabulary file, which every executor must reach at ``path``."""

    def count(text: str = "text") -> Column:
        @F.pandas_udf("long")
        def encode(texts):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            return texts.fillna("").map(lambda x: len(tokenizer.encode(x, add_special_tokens=False).ids))

        return encode(text)

    return count


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets that minimise sum(count * (bound - length)).

    lengths: distinct and ascending. cost[j] is the least total of padded tokens
    of the first j lengths in the buckets so far; a bound is always a length that
    occurs. A last bucket from i to j costs cost[i] + (total[j] - total[i]) *
    lengths[j - 1], so the best i is the lowest of the lines cost[i] - total[i] * x
    at x = lengths[j - 1]. x rises and the lines fall ever faster: their lower hull
    is kept in order, and the work is in proportion to the lengths. Of equal
    choices the smallest i is taken.
    """
    m = len(lengths)
    if not m:
        return []
    total = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    cost = None
    back = []
    for _ in range(min(buckets, m)):
        new, origin = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
        hull: deque[tuple[int, int, int]] = deque()  # (i, total[i], cost[i])
        for start in range(0, m, EXACT):
            of = slice(start, start + EXACT)
            costs = cost[:m][of].tolist() if cost is not None else []
            after = []
            for at, (x, before, upto) in enumerate(zip(lengths[of].tolist(), total[:m][of].tolist(), total[1:][of].tolist(), strict=True)):
                i = start + at
                if costs or not i:  # the first bucket begins with the first length
                    c = costs[at] if costs else 0
                    # the last line goes if the new one is below it wherever it is below the line before it
                    while len(hull) > 1 and (c - hull[-1][2]) * (hull[-1][1] - hull[-2][1]) <= (hull[-1][2] - hull[-2][2]) * (before - hull[-1][1]):
                        hull.pop()
                    hull.append((i, before, c))
                while len(hull) > 1 and hull[1][2] - hull[1][1] * x < hull[0][2] - hull[0][1] * x:
                    hull.popleft()
                after.append((hull[0][0], hull[0][2] + (upto - hull[0][1]) * x))
            origin[1:][of], new[1:][of] = zip(*after, strict=True)
        back.append(origin)
        cost = new
    out, j = [], m
    for origin in reversed(back):
        if j:
            out.append(int(lengths[j - 1]))
            j = int(origin[j])
    return out[::-1]


PLACES = ("n_tokens", "bucket", "bucket_tokens", "shard", "batch", "slot", "padding")


def pack(spark: SparkSession, docs: DataFrame, budget: int = 32768, buckets: int = 8, tokens=word_tokens, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row for each row of ``docs``: where it lies in the batches.

    doc_id, n_tokens, bucket (from 0), bucket_tokens (its bound, to which rows
    are padded), shard, batch (both from 0 inside the bucket), slot (from 0
    inside the batch), padding; then the columns ``carry`` of ``docs``, one
    named like a column before it with underscores in front. rows *
    bucket_tokens of a batch is at most ``budget``, but a document over the
    budget is a batch of its own. A batch but the last of its bucket has as many
    rows as ``budget`` allows.

    Null and empty texts have 0 tokens. Repeated rows and null doc_ids each
    take a slot; rows of one doc_id and text may swap their slots. An empty
    table gives no rows. Other columns aren't read.
    """
    ws = Workspace(spark, "packing")
    # rows without a doc_id, or with a common one, are ordered by their texts
    measured = docs.select("doc_id", tokens("text").alias("n_tokens"), F.xxhash64("doc_id", "text").alias("_deal"))
    lengths = ws.keep(measured, "lengths")
    histogram = lengths.groupBy("n_tokens").agg(F.count("*").alias("n")).toArrow().sort_by("n_tokens")
    at, count = histogram["n_tokens"].to_numpy(), histogram["n"].to_numpy()
    bounds = optimal_bounds(at, count, buckets)
    names, taken = [], ["doc_id", "_deal", "_cell", "_before", *PLACES]
    for c in carry:
        names.append(free_name(taken, c))
        taken.append(names[-1])
    if not bounds:
        longs = [T.StructField(n, T.LongType()) for n in ("doc_id", *PLACES)]
        return spark.createDataFrame([], T.StructType([*longs, *[T.StructField(n, docs.schema[c].dataType) for n, c in zip(names, carry, strict=True)]]))
    per = [max(1, budget // max(b, 1)) for b in bounds]
    run = [max(1, min(SHARD // n, SHARD_TOKENS // max(n * b, 1))) for n, b in zip(per, bounds, strict=True)]
    pick = lambda values: F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), (F.col("bucket") + 1).cast("int"))
    bucket = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b < F.col("n_tokens"))).cast("long")
    cell = F.col("bucket") * PARTS + F.shiftright("_deal", 65 - PARTS.bit_length())  # ascends with _deal
    dealt = lambda rows: rows.withColumn("bucket", bucket).withColumn("_cell", cell)
    cells = dealt(lengths).groupBy("bucket", "_cell").agg(F.count("*").alias("n"))  # at most PARTS for each bucket
    earlier = Window.partitionBy("bucket").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select("_cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    if carry:  # texts go along; measuring them again is cheaper than writing them once more
        lengths = docs.select(*measured.columns[:1], tokens("text").alias("n_tokens"), F.xxhash64("doc_id", "text").alias("_deal"), *[F.col(c).alias(n) for n, c in zip(names, carry, strict=True)])
    order = Window.partitionBy("_cell").orderBy("_deal", F.col("doc_id").asc_nulls_first(), "n_tokens")
    placed = dealt(lengths).withColumn("slot", (F.row_number().over(order) - 1).cast("long")).join(F.broadcast(before), "_cell")
    placed = placed.withColumn("slot", F.col("slot") + F.col("_before")).withColumn("batch", pick(per)).withColumn("shard", pick(run)).withColumn("bucket_tokens", pick(bounds))
    shard, batch, slot = F.expr("slot DIV batch DIV shard").alias("shard"), F.expr("slot DIV batch").alias("batch"), F.expr("slot % batch").alias("slot")
    return placed.select("doc_id", "n_tokens", "bucket", "bucket_tokens", shard, batch, slot, (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding"), *names)


def op2_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"))
