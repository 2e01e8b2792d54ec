"""Depth and class counts by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def coverage(intervals: DataFrame, keys: list[str], left: str = "left", right: str = "right") -> DataFrame:
    """Depth at each covered position from inclusive intervals.

    A difference array: each interval adds one row where it begins and one
    behind its end, which partial aggregation collapses before the shuffle; a
    running sum over positions follows. Cost grows with intervals, not bases.
    """
    k = [F.col(c) for c in keys]
    delta = intervals.select(*k, F.explode(F.array(F.struct(F.col(left).alias("pos"), F.lit(1).alias("d")), F.struct((F.col(right) + 1).alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    steps = delta.groupBy(*k, F.col("e.pos").alias("pos")).agg(F.sum("e.d").alias("d"))
    order = Window.partitionBy(*keys).orderBy("pos")
    run = steps.select(*k, "pos", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("depth"), F.lead("pos").over(order).alias("next"))
    run = run.filter((F.col("depth") > 0) & F.col("next").isNotNull())
    return run.select(*k, F.explode(F.sequence("pos", F.col("next") - 1)).alias("pos"), F.col("depth").cast("long").alias("depth"))


def dense_counts(events: DataFrame, keys: list[str], pos: Column, tag: Column, tags: list, length: int, names: dict | None = None) -> DataFrame:
    """Counts by position and class: a column per class, a row per position in 0 .. length - 1, zeros filled.

    Classes are a fixed list, so no job looks for them.
    """
    at = events.select(*keys, pos.cast("int").alias("pos"), tag.alias("_tag"))
    counts = at.groupBy(*keys, "pos").agg(*[F.count(F.when(F.col("_tag") == t, 1)).alias((names or {}).get(t, str(t))) for t in tags])
    spine = at.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias("pos"))
    return spine.join(counts, [*keys, "pos"], "left").na.fill(0)
