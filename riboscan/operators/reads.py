"""Operators on reads: trimming, mates, primers, neighbouring mutations."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def trim_point(q: Column, n: Column, window: int, least: int) -> Column:
    """First i < n - window whose window of scores has a mean under ``least``; null without one. The last full window isn't tested.

    The window sums are ``window`` shifted arrays added up, so no lambda
    evaluates ``q`` again for each place.
    """
    m = F.greatest(n - window, F.lit(0))
    sums = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [F.slice(q, k + 1, m) for k in range(window)])
    first = F.array_position(F.transform(sums, lambda x: x < least * window), F.lit(True))
    return F.when(first > 0, (first - 1).cast("int"))


def trim_quality(df: DataFrame, seq: str, q: str, window: int = 5, least: int = 20, min_length: int = 25) -> DataFrame:
    """Cuts ``seq`` at the trim point. A read shorter than the window, or cut to less than ``min_length``, becomes N."""
    n = F.length(seq)
    df = df.withColumn("_cut", trim_point(F.col(q), n, window, least))
    drop = (n < window) | (F.col("_cut").isNotNull() & (F.col("_cut") < min_length))
    out = F.when(drop, F.lit("N")).when(F.col("_cut").isNotNull(), F.expr(f"substring({seq}, 1, _cut)")).otherwise(F.col(seq))
    return df.withColumn("trimmed", out).drop("_cut")


def trim_quality_strings(df: DataFrame, seq: str, qual: str, score: Callable[[np.ndarray], np.ndarray], window: int = 5, least: int = 20, min_length: int = 25) -> DataFrame:
    """As ``trim_quality``, with ``score`` of the bytes of the ASCII string ``qual``; one Arrow pass, for reads of any length."""
    columns = df.columns
    at, by = columns.index(seq), columns.index(qual)

    def trim(s: str | None, q: str | None) -> str | None:
        if s is None or len(s) < window:
            return None if s is None else "N"
        if q is None:
            return s
        total = np.concatenate([[0], np.cumsum(score(np.frombuffer(q.encode("ascii"), np.uint8)), dtype=np.int64)])
        low = (total[window:-1] - total[: -window - 1])[: len(s) - window] < least * window
        cut = int(low.argmax()) if low.any() else None
        return s if cut is None else "N" if cut < min_length else s[:cut]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [trim(s.as_py(), q.as_py()) for s, q in zip(b.column(at), b.column(by), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*columns, "trimmed"])

    return df.mapInArrow(scan, T.StructType([*df.schema.fields, T.StructField("trimmed", T.StringType())]))


def concordant(a: dict[str, Column], b: dict[str, Column], most: int = 800) -> Column:
    """Mates (left, right, reverse, mapped): both mapped, on opposite strands, fragment in bounds, not dovetailed."""
    size = F.greatest(a["right"], b["right"]) - F.least(a["left"], b["left"])
    forward = ~a["reverse"] & (b["left"] < a["left"]) & (a["right"] > b["right"])
    back = a["reverse"] & (a["left"] < b["left"]) & (b["right"] > a["right"])
    return a["mapped"] & b["mapped"] & (a["reverse"] != b["reverse"]) & (size <= most) & ~forward & ~back


def primer_array(primers: list[tuple[int, int, int, int]]) -> Column:
    """Primer pairs (fw_left, fw_right, rv_left, rv_right) as an array literal; their order is their index."""
    names = ("fw_left", "fw_right", "rv_left", "rv_right")
    return F.array(*[F.struct(F.lit(i).alias("idx"), *[F.lit(v).alias(n) for n, v in zip(names, p, strict=True)]) for i, p in enumerate(primers)])


def nearest_primer(end: Column, primers: Column, side: str, offset: int) -> Column:
    """Index of the nearest primer whose ``side`` is within ``offset`` of a read's end; the lowest index of equals; null without one."""
    near = F.filter(F.transform(primers, lambda p: F.struct(F.abs(end - p[side]).alias("d"), p["idx"].alias("idx"))), lambda x: x["d"] <= offset)
    return F.array_min(near)["idx"]


def overlapping_primer(left: Column, right: Column, primers: Column) -> Column:
    """The largest index of a pair that holds the read's left end in its forward or right end in its reverse primer."""
    hit = F.filter(primers, lambda p: ((left >= p["fw_left"]) & (left <= p["fw_right"])) | ((right >= p["rv_left"]) & (right <= p["rv_right"])))
    return F.array_max(F.transform(hit, lambda p: p["idx"]))


def off_target(fw: Column, rv: Column, need_fw: bool = True, need_rv: bool = True) -> Column:
    """Single reads: a needed primer is missing, or both are needed and differ."""
    out = F.lit(False)
    if need_fw:
        out = out | fw.isNull()
    if need_rv:
        out = out | rv.isNull()
    return out | F.coalesce(fw != rv, F.lit(False)) if need_fw and need_rv else out


def collapse_nearby(df: DataFrame, keys: list[str], left: str, right: str, gap: int) -> DataFrame:
    """Merges mutations of a read with at most ``gap`` unchanged bases between them: keys, left, right, n."""
    order = Window.partitionBy(*keys).orderBy(left, right)
    prev = F.max(F.col(right) - 1).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col(left) - prev > gap, F.lit(True)).cast("int")
    run = df.withColumn("_new", new).withColumn("_group", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(*keys, "_group").agg(F.min(left).alias("left"), F.max(right).alias("right"), F.count("*").alias("n")).drop("_group")


def merge_adjacent(df: DataFrame, keys: list[str]) -> DataFrame:
    """Merges variants (left, right, seq, freq) that touch: keys, left, right, seq, freq of the first."""
    order = Window.partitionBy(*keys).orderBy("left", "right", "seq")
    touch = F.coalesce(F.lag("right").over(order) - 1 == F.col("left"), F.lit(False))
    run = df.withColumn("_group", F.sum((~touch).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = run.groupBy(*keys, "_group").agg(F.array_sort(F.collect_list(F.struct("left", "right", "seq", "freq"))).alias("v"))
    return parts.select(*keys, F.col("v")[0]["left"].alias("left"), F.element_at("v", -1)["right"].alias("right"), F.array_join(F.col("v.seq"), "").alias("seq"), F.col("v")[0]["freq"].alias("freq"))


def spans(left: Column, right: Column, first: int, last: int) -> Column:
    """Whether a read covers all places from ``first`` to ``last``."""
    return (left <= first) & (right >= last)


def without_placeholders(df: DataFrame, seq: str) -> DataFrame:
    """Reads but for those that trimming left one base or none of."""
    return df.filter(F.length(seq) > 1)
