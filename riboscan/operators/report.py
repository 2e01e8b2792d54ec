"""Quality verdicts and the tables behind figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# fixed values: rates over which a base counts as reactive to DMS
DMS_REACTIVE = {"A": 0.05, "C": 0.05, "U": 0.01, "G": 0.002}
#: Upper ends of an axis of rates, the largest first.
LADDER = (0.32, 0.16, 0.08, 0.04, 0.02, 0.01)
#: Bounds between low, middle and high reactivities.
COLOURS = {"shape": (0.4, 0.85), "dms": (0.2, 0.4), "n7": (1.6, 2.3)}


def _share(n: str, of: str) -> Column:
    return F.try_divide(F.col(n).cast("double"), F.col(of).cast("double"))


def _tally(c: Column) -> Column:
    return F.count(F.when(c, 1))


def shape_checks(df: DataFrame, keys: list[str], depths: list[str], rate: str, background: str | None, min_depth: int = 5000, max_background: float = 0.05, least_deep: float = 0.8, most_background: float = 0.05, least_positive: float = 0.5, reactive: float = 0.006, least_reactive: float = 0.08) -> DataFrame:
    """keys, n (unmasked), n_deep and the verdicts deep, positive, background, reactive, swapped, dms_like, good.

    Shares are of the uppercase places deep enough in every sample. With ten
    such places or fewer nothing but the depth is judged, and verdicts without
    a judgement are null. Highly reactive places whose 95th percentile is over
    twice as high for A and C as for G and U hint at DMS; as many inverted ones
    as reactive ones at swapped samples.
    """
    upper = F.col("nt").rlike("^[A-Z]$")
    deep = upper
    for d in depths:
        deep = deep & (F.coalesce(d, F.lit(0)) >= min_depth)
    diff = F.col(rate) - F.col(background) if background else F.col(rate)
    high = lambda bases: F.percentile(F.when(deep & F.col("nt").isin(*bases), diff), 0.95)
    x = df.groupBy(*keys).agg(
        _tally(upper).alias("n"), _tally(deep).alias("n_deep"), _tally(deep & (diff > 0)).alias("_pos"),
        (_tally(deep & (F.col(background) > max_background)) if background else F.lit(0)).alias("_bg"),
        _tally(deep & (diff > reactive)).alias("_high"), _tally(deep & (diff < -reactive)).alias("_inv"), high("AC").alias("_ac"), high("GU").alias("_gu"),
    )
    judged = F.col("n_deep") > 10
    x = x.select("*", F.coalesce(_share("n_deep", "n") >= least_deep, F.lit(False)).alias("deep"))
    if background:
        x = x.select("*", F.when(judged, _share("_pos", "n_deep") >= least_positive).alias("positive"), F.when(judged, _share("_bg", "n_deep") <= most_background).alias("background"))
    else:
        x = x.select("*", F.lit(None).cast("boolean").alias("positive"), F.lit(None).cast("boolean").alias("background"))
    x = x.select("*", F.when(judged, _share("_high", "n_deep") >= least_reactive).alias("reactive"))
    seen = F.col("reactive")
    x = x.select("*", F.when(seen, F.coalesce(F.try_divide("_ac", "_gu") > 2, F.lit(False))).alias("dms_like"), F.when(seen, _share("_inv", "n_deep") >= least_reactive).alias("swapped"))
    yes = lambda c: F.coalesce(F.col(c), F.lit(True))
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    good = F.col("deep") & yes("positive") & yes("background") & yes("reactive") & no("dms_like") & no("swapped")
    return x.select(*keys, "n", "n_deep", "deep", "positive", "background", "reactive", "swapped", "dms_like", good.alias("good"))


def dms_checks(df: DataFrame, keys: list[str], depths: list[str], rate: str, background: str, norm: str, min_depth: int = 5000, max_background: float = 0.05, least_deep: float = 0.8, most_background: float = 0.05, least_positive: float = 0.5, least_reactive: float = 0.08, reactive: dict[str, float] = DMS_REACTIVE) -> DataFrame:
    """keys, nt and for each of A, C, G, U the verdicts of ``shape_checks`` by its own bound, and whether any normalised rate is there (normalised)."""
    x = df.filter(F.col("nt").isin(*reactive))
    deep = F.lit(True)
    for d in depths:
        deep = deep & (F.coalesce(d, F.lit(0)) >= min_depth)
    diff = F.col(rate) - F.col(background)
    bound = F.element_at(F.create_map(*[F.lit(v) for kv in reactive.items() for v in kv]), F.col("nt"))
    x = x.groupBy(*keys, "nt").agg(
        F.count("*").alias("n"), _tally(deep).alias("n_deep"), _tally(deep & (diff > 0.0001)).alias("_pos"), _tally(deep & (F.col(background) > max_background)).alias("_bg"),
        _tally(deep & (diff > bound)).alias("_high"), _tally(deep & (diff < -bound)).alias("_inv"), (F.count(norm) > 0).alias("normalised"),
    )
    judged = F.col("n_deep") > 20
    when = lambda c: F.when(judged, c)
    x = x.select(
        *keys, "nt", "n", "n_deep", (_share("n_deep", "n") >= least_deep).alias("deep"), when(_share("_bg", "n_deep") <= most_background).alias("background"),
        when(_share("_pos", "n_deep") >= least_positive).alias("positive"), when(_share("_high", "n_deep") >= least_reactive).alias("reactive"),
        F.when(judged & (_share("_high", "n_deep") >= least_reactive), _share("_inv", "n_deep") >= least_reactive).alias("swapped"), "normalised",
    )
    yes = lambda c: F.coalesce(F.col(c), F.lit(True))
    return x.withColumn("good", F.col("deep") & yes("background") & yes("positive") & yes("reactive") & ~F.coalesce(F.col("swapped"), F.lit(False)) & F.col("normalised"))


def figure_percentiles(df: DataFrame, keys: list[str], columns: list[str], points=(0.05, 0.5, 0.9, 0.95)) -> DataFrame:
    """keys and p<k>_<column> for each column and percentile."""
    q = df.groupBy(*keys).agg(*[F.percentile(c, F.array(*[F.lit(p) for p in points])).alias(c) for c in columns])
    return q.select(*keys, *[F.col(c)[i].alias(f"p{round(100 * p)}_{c}") for c in columns for i, p in enumerate(points)])


def ranged_histogram(df: DataFrame, keys: list[str], value: str, low: Column, high: Column, bins: Column) -> DataFrame:
    """keys, bin, n, height: equal bins of [low, high], columns of ``df``'s own rows; the last closed, heights scaled to a largest of 1."""
    v = F.col(value)
    x = df.select(*keys, v.alias("_v"), low.alias("_low"), high.alias("_high"), bins.alias("_bins")).filter((F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")) & (F.col("_high") > F.col("_low")))
    at = F.least(F.col("_bins") - 1, F.floor((F.col("_v") - F.col("_low")) * F.col("_bins") / (F.col("_high") - F.col("_low"))).cast("int"))
    n = x.groupBy(*keys, at.alias("bin")).agg(F.count("*").alias("n"))
    return n.withColumn("height", F.col("n") / F.max("n").over(Window.partitionBy(*keys)).cast("double"))


def rate_histogram(df: DataFrame, keys: list[str], wide: float = 0.03, narrow: float = 0.008, cut: float = 0.01) -> DataFrame:
    """keys, sample, bin, n, height of rates (keys, sample, rate), the range and number of bins by the data.

    30 bins, or 10 for fewer than 500 places; up to ``narrow`` where every
    sample's 90th percentile is under ``cut``, else to ``wide``. Samples of ten
    places or fewer are left out.
    """
    stats = df.groupBy(*keys, "sample").agg(F.count("*").alias("_n"), F.percentile("rate", 0.9).alias("_p"))
    by = stats.groupBy(*keys).agg(F.max(F.when(F.col("_n") > 10, F.col("_p"))).alias("_top"), F.max("_n").alias("_size"))
    kept = df.join(stats.filter("_n > 10").select(*keys, "sample"), [*keys, "sample"]).join(by, keys)
    high = F.when(F.coalesce("_top", F.lit(0.0)) < cut, F.lit(narrow)).otherwise(F.lit(wide))
    return ranged_histogram(kept, [*keys, "sample"], "rate", F.lit(0.0), high, F.when(F.col("_size") < 500, 10).otherwise(30))


def depth_histogram(df: DataFrame, keys: list[str], bins: int = 30) -> DataFrame:
    """keys, sample, bin, n, height of depths (keys, sample, depth) from 0 to 1.1 times the largest 90th percentile of a sample."""
    top = df.groupBy(*keys, "sample").agg(F.percentile("depth", 0.9).alias("_p")).groupBy(*keys).agg((F.max("_p") * F.lit(1.1)).alias("_top"))
    return ranged_histogram(df.join(top, keys), [*keys, "sample"], "depth", F.lit(0.0), F.col("_top"), F.lit(bins))


def nucleotide_histogram(df: DataFrame, keys: list[str], value: str, bins: int = 20) -> DataFrame:
    """keys, bin, n, height from the least value to 1.2 times the 95th percentile, or 0.8 times a negative one."""
    top = df.groupBy(*keys).agg(F.min(value).alias("_least"), F.percentile(value, 0.95).alias("_p"))
    high = F.col("_p") * F.when(F.col("_p") < 0, F.lit(0.8)).otherwise(F.lit(1.2))
    return ranged_histogram(df.join(top, keys), keys, value, F.col("_least"), high, F.lit(bins))


def shown_factor(df: DataFrame, keys: list[str], raw: str, norm: str) -> DataFrame:
    """keys, factor: raw over normalised where the normalised value is largest."""
    return df.groupBy(*keys).agg(F.max_by(F.try_divide(raw, norm), F.col(norm)).alias("factor"))


def axis_top(df: DataFrame, keys: list[str], rate: str, background: str, most: float = 0.05) -> DataFrame:
    """keys, top: the least step of LADDER over the 98th percentile of rates whose background is low or unknown."""
    p = df.groupBy(*keys).agg(F.percentile(F.when(F.coalesce(F.col(background) <= most, F.lit(True)), F.col(rate)), 0.98).alias("_p"))
    top = F.lit(LADDER[0])
    for step in LADDER:
        top = F.when(F.col("_p") < step, F.lit(step)).otherwise(top)
    return p.select(*keys, top.alias("top"))


def colour(value: Column, kind: str = "shape") -> Column:
    low, high = COLOURS[kind]
    return F.when(value.isNull(), "none").when(value < low, "low").when(value < high, "middle").otherwise("high")


def masked(seq: Column, sites: Column) -> Column:
    """``seq`` with primer sites (array of struct left, right, inclusive) in lowercase.

    A site covers the places from left - 1 to right - 1; place -1 is the last base.
    """
    n = F.length(seq)
    inside = lambda i: F.exists(sites, lambda s: ((i >= s["left"] - 1) & (i < s["right"])) | ((s["left"] == 0) & (i == n - 1)))
    return F.array_join(F.transform(F.filter(F.split(seq, ""), lambda c: c != ""), lambda c, i: F.when(inside(i), F.lower(c)).otherwise(c)), "")


def in_histogram(nt: Column, value: Column) -> Column:
    """Uppercase bases with a finite reactivity."""
    return nt.rlike("^[A-Z]$") & F.coalesce(~F.isnan(value) & (F.abs(value) != float("inf")), F.lit(False))


def metric(n: Column) -> Column:
    """An integer as text, three, six or nine zeros at its end as k, M or G."""
    s = n.cast("string")
    out = s
    for zeros, suffix in ((3, "k"), (6, "M"), (9, "G")):
        out = F.when(s.rlike(f"0{{{zeros}}}$"), F.concat(F.regexp_replace(s, f"0{{{zeros}}}$", ""), F.lit(suffix))).otherwise(out)
    return out


def commas(n: Column) -> Column:
    """An integer as text with a comma before every three digits."""
    return F.regexp_replace(n.cast("string"), r"(?<=\d)(?=(\d{3})+$)", ",")
