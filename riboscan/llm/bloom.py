"""A blocked Bloom filter of a fixed size, built by aggregation and probed in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riboscan.llm.core import free_name

#: Words of 64 bits in a block: one cache line.
WORDS = 8
#: Blocks at most: 16 MB. Beyond it the share of false hits grows, never a miss.
MOST_BLOCKS = 1 << 18


class BlockedBloom:
    """Every hash sets one bit in each of a block's eight 64-bit words.

    ``blocks`` is a power of two chosen from the number of keys (about 16 bits
    a key) and bounded by MOST_BLOCKS, so what is collected and broadcast is at
    most 16 MB whatever the input.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of_ids(cls, ids: DataFrame) -> BlockedBloom:
        """From the one column of ``ids``; counts them first."""
        return cls.build(ids.select(F.xxhash64(ids.columns[0]).alias("h")), ids.count())

    @staticmethod
    def size(keys: int) -> int:
        blocks = 16
        while blocks < MOST_BLOCKS and blocks * WORDS * 64 < 16 * keys:
            blocks *= 2
        return blocks

    @classmethod
    def build(cls, hashes: DataFrame, keys: int) -> BlockedBloom:
        """From a DataFrame with a long column ``h``; null hashes are skipped."""
        blocks = cls.size(keys)
        h = F.col("h")
        block = F.shiftrightunsigned(h, 48 - 1).bitwiseAND(F.lit(blocks - 1)).cast("int")
        # the bit of word i: six bits of h from bit 6 * i on
        masks = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]
        rows = hashes.filter(h.isNotNull()).select(block.alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
        rows = rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
        bits = np.zeros((blocks, WORDS), np.uint64)
        found = rows.toArrow()  # one job; a row per block at most
        bits[found.column(0).to_numpy()] = np.stack([found.column(i + 1).to_numpy() for i in range(WORDS)], axis=1).view(np.uint64)
        return cls(bits)

    def hit(self, h: np.ndarray) -> np.ndarray:
        h = h.view(np.uint64)
        rows = self.bits[((h >> np.uint64(47)) & np.uint64(len(self.bits) - 1)).astype(np.int64)]
        out = np.ones(len(h), bool)
        for i in range(WORDS):
            bit = (h >> np.uint64(6 * i)) & np.uint64(63)
            out &= ((rows[:, i] >> bit) & np.uint64(1)).astype(bool)
        return out

    def maybe(self, df: DataFrame, key: str, hit: bool = True, then: tuple[Callable, T.StructType] | None = None) -> DataFrame:
        """Rows of ``df`` whose key may be in the filter, or (``hit`` false) surely isn't.

        then: what the rows' batches go through in the same pass, and the schema
        it gives; a pass of its own would hold a second Python worker per task.
        """
        names, hashed = df.columns, free_name(df.columns, "_h")
        shared = df.sparkSession.sparkContext.broadcast(self.bits)

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bloom = BlockedBloom(shared.value)
            for batch in batches:
                h = np.asarray(batch.column(hashed)).astype(np.int64)
                yield batch.select(names).filter(pa.array(bloom.hit(h) == hit))

        scan, schema = then or (lambda batches: batches, df.schema)
        return df.withColumn(hashed, F.xxhash64(key)).mapInArrow(lambda batches: scan(probe(batches)), schema)
