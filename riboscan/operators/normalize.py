"""Normalisation factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def ranked(x: DataFrame) -> DataFrame:
    """v, c, upto, n of x(v): each value once, how often it occurs, the rank of its last copy, and the number of rows.

    Ties are counted before the shuffle. Values are ranked inside bins of 1/256
    octave, and the bins by their sizes, so no task holds all of them.
    """
    bin_of = F.when(F.col("v") == 0, 0.0).otherwise(F.signum("v") * (F.rint(F.log2(F.abs("v")) * 256) + 300_000))
    h = x.groupBy("v").agg(F.count("*").alias("c")).withColumn("bin", bin_of)
    group = Window.partitionBy(F.lit(0))  # over bins, of which there are some thousands at any size
    before = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = h.groupBy("bin").agg(F.sum("c").alias("size"))
    bins = bins.select("bin", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("below"), F.sum("size").over(group).alias("n"))
    inside = Window.partitionBy("bin").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return h.join(bins, "bin").select("v", "c", (F.col("below") + F.sum("c").over(inside)).alias("upto"), "n")


def pooled_factor(df: DataFrame, value: str) -> DataFrame:
    """n, factor: ``boxplot_factor`` over all rows as one group, without a task that sees them all."""
    x = ranked(df.filter(F.col(value).isNotNull()).select(F.col(value).alias("v")))
    n, upto = F.col("n"), F.col("upto")
    at = lambda rank: F.max(F.when((upto - F.col("c") < rank) & (rank <= upto), F.col("v")))
    places = [(n - 1) * q for q in (0.25, 0.75)]
    ends = [at(end(p) + 1).alias(f"{name}{i}") for i, p in enumerate(places) for name, end in (("lo", F.floor), ("hi", F.ceil))]
    cut = F.when(n < 100, F.expr("n DIV 20")).otherwise(F.expr("n DIV 10"))
    stats = x.agg(F.max("n").alias("n"), at(n - cut).alias("high"), *ends)
    quartile = [F.col(f"lo{i}") + (p - F.floor(p)) * (F.col(f"hi{i}") - F.col(f"lo{i}")) for i, p in enumerate(places)]
    stats = stats.select(F.expr("n DIV 10").alias("tenth"), F.greatest(1.5 * F.abs(quartile[0] - quartile[1]), "high").alias("most"))
    low = x.crossJoin(F.broadcast(stats))
    low = low.filter(F.col("v") < F.col("most"))
    # the lowest values keep their ranks, so the top tenth of the m left are those of the ranks m - tenth + 1 to m
    m = low.agg(F.max("upto").alias("m"))
    low = low.crossJoin(F.broadcast(m))
    copies = F.greatest(F.lit(0), upto - F.greatest(upto - F.col("c"), F.col("m") - F.col("tenth")))
    mean = low.agg(F.max("n").alias("n"), F.sum(F.when(copies > 0, F.col("v") * copies)).alias("s"), F.max("m").alias("m"), F.max("tenth").alias("tenth"))
    good = (n >= 20) & (F.col("m") >= F.col("tenth"))
    return mean.select("n", F.when(good, F.try_divide("s", F.col("tenth").cast("double"))).alias("factor"))


def boxplot_factor(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """keys, n, factor: values below a limit, the mean of their top tenth.

    The limit is the larger of 1.5 interquartile ranges and the value that has
    a tenth (a twentieth, under 100 values) above it. Null values are left out;
    fewer than 20 give a null factor. With keys a group is ranked in one task (a
    sequence is short enough); without any, see ``pooled_factor``.
    """
    if not keys:
        return pooled_factor(df, value)
    x = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v"))
    group = Window.partitionBy(*keys)
    x = x.withColumn("rn", F.row_number().over(group.orderBy("v"))).withColumn("n", F.count("*").over(group))
    x = x.withColumn("tenth", F.expr("n DIV 10")).withColumn("cut", F.when(F.col("n") < 100, F.expr("n DIV 20")).otherwise(F.expr("n DIV 10")))
    stats = x.groupBy(*keys).agg(F.max("n").alias("n"), F.max("tenth").alias("tenth"), F.percentile("v", F.array(F.lit(0.25), F.lit(0.75))).alias("q"), F.max(F.when(F.col("rn") == F.col("n") - F.col("cut"), F.col("v"))).alias("high"))
    stats = stats.withColumn("most", F.greatest(1.5 * F.abs(F.col("q")[0] - F.col("q")[1]), F.col("high"))).select(*keys, "n", "tenth", "most")
    rows = x.select(*keys, "v").join(stats, keys)
    low = rows.filter(F.col("v") < F.col("most")).withColumn("top", F.row_number().over(group.orderBy(F.desc("v"))))
    mean = low.groupBy(*keys).agg(F.max("n").alias("n"), F.sum(F.when(F.col("top") <= F.col("tenth"), F.col("v"))).alias("s"), F.count("*").alias("m"), F.max("tenth").alias("tenth"))
    good = (F.col("n") >= 20) & (F.col("m") >= F.col("tenth"))
    return mean.select(*keys, "n", F.when(good, F.try_divide("s", F.col("tenth").cast("double"))).alias("factor"))


def pernt_factor(df: DataFrame, value: str, nt: str, keys: list[str], threshold: int = 20, least: float = 0.002) -> DataFrame:
    """keys, nt, n, factor: the larger of the mean between the 90th and 95th percentile and the 75th percentile of values over 0.001.

    Null under ``threshold`` values and where the factor is under ``least``.
    """
    x = df.filter(F.col(value).isNotNull()).select(*keys, F.col(nt).alias("nt"), F.col(value).alias("v"))
    by = [*keys, "nt"]
    q = x.groupBy(*by).agg(F.count("*").alias("n"), F.percentile("v", F.array(F.lit(0.9), F.lit(0.95))).alias("q"), F.percentile(F.when(F.col("v") > 0.001, F.col("v")), 0.75).alias("upper"))
    mid = x.join(q, by).groupBy(*by).agg(F.avg(F.when((F.col("v") >= F.col("q")[0]) & (F.col("v") < F.col("q")[1]), F.col("v"))).alias("mid"))
    out = q.join(mid, by).withColumn("f", F.greatest(F.coalesce("mid", F.lit(0.0)), F.coalesce("upper", F.lit(0.0))))
    return out.select(*by, "n", F.when((F.col("n") >= threshold) & (F.col("f") >= least), F.col("f")).alias("factor"))


def n7_factors(df: DataFrame, value: str, nt: str, pos: str, keys: list[str]) -> DataFrame:
    """keys, gpur, gpyr: 75th percentiles of G before a purine and before a pyrimidine; few values are pooled, pyrimidines scaled by 0.65."""
    order = Window.partitionBy(*keys).orderBy(pos)
    x = df.withColumn("_next", F.lead(nt).over(order)).filter((F.col(nt) == "G") & F.col(value).isNotNull())
    pur, pyr = F.col("_next").isin("A", "G"), F.col("_next").isin("C", "U")
    v = F.col(value)
    q = x.groupBy(*keys).agg(
        F.count(F.when(pur, 1)).alias("n_pur"), F.count(F.when(pyr, 1)).alias("n_pyr"),
        F.percentile(F.when(pur, v), 0.75).alias("pur"), F.percentile(F.when(pyr, v), 0.75).alias("pyr"),
        F.percentile(F.when(pur, v).when(pyr, v * F.lit(0.65)), 0.75).alias("pool"),
    )
    few = (F.col("n_pur") < 15) | (F.col("n_pyr") < 15)
    return q.select(*keys, F.when(few, F.col("pool")).otherwise(F.col("pur")).alias("gpur"), F.when(few, F.col("pool") / 0.65).otherwise(F.col("pyr")).alias("gpyr"))


def n7_suppressed(gpur: Column, gpyr: Column, least: float = 0.015) -> Column:
    """Whether either factor is too low for N7 outputs."""
    return F.coalesce((gpur < least) | (gpyr < least), F.lit(False))
