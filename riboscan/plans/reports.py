"""Verdicts, figure tables, primers and text tables as queries, with their SQL."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import functions as F

from riboscan.functions.profile import rate, rate_stderr, rescale
from riboscan.operators import normalize as N
from riboscan.operators import primers as Q
from riboscan.operators import reads as R
from riboscan.operators import report as V
from riboscan.operators import summary as A
from riboscan.plans import samples as P
from riboscan.plans.queries import DNA, HEX, PRIMERS, READS, VARIANTS, WIDE, _box_sql, query, r6
from riboscan.sources import mutations as SM
from riboscan.sources import tables as ST
from riboscan.sources import text as SX

_OWN: list[str] = []


def scratch(spark) -> str:
    """A new folder for text that a query writes and reads back: in ``spark.checkpoint.dir``, or a local session's own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="riboscan-text-"))
            atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
        root = f"file://{_OWN[0]}"
    return f"{root.rstrip('/')}/riboscan-{uuid.uuid4().hex}"


def _rates(spark, d):
    """rna, pos, nt, rates and errors of the samples, reactivity, hq, hq_err."""
    h = P.hq(spark, d)
    return h.select("*", *[f(*P.pair(s)).alias(f"{s}_{n}") for s in P.SAMPLES.values() for n, f in (("rate", rate), ("stderr", rate_stderr))])


DEPTHS = [f"{s}_depth" for s in P.SAMPLES.values()]
UPPER = "regexp_matches(nt, '^[A-Z]$')"
DEEP = "d1 >= 80 AND d2 >= 80 AND d3 >= 80"

_SHAPE = f"""q AS (SELECT rna, count(*) FILTER ({UPPER}) AS n, count(*) FILTER ({UPPER} AND {DEEP}) AS n_deep, count(*) FILTER ({UPPER} AND {DEEP} AND r1 - r2 > 0) AS pos, count(*) FILTER ({UPPER} AND {DEEP} AND r2 > 0.5) AS bg,
  count(*) FILTER ({UPPER} AND {DEEP} AND r1 - r2 > 0.006) AS high, count(*) FILTER ({UPPER} AND {DEEP} AND r1 - r2 < -0.006) AS inv,
  quantile_cont(r1 - r2, 0.95) FILTER ({DEEP} AND nt IN ('A', 'C')) AS ac, quantile_cont(r1 - r2, 0.95) FILTER ({DEEP} AND nt IN ('G', 'U')) AS gu FROM prof GROUP BY 1),
j AS (SELECT *, n_deep / n >= 0.8 AS deep, CASE WHEN n_deep > 10 THEN pos / n_deep >= 0.3 END AS positive, CASE WHEN n_deep > 10 THEN bg / n_deep <= 0.05 END AS background, CASE WHEN n_deep > 10 THEN high / n_deep >= 0.08 END AS reactive FROM q),
k AS (SELECT *, CASE WHEN reactive THEN coalesce(ac / nullif(gu, 0) > 2, false) END AS dms_like, CASE WHEN reactive THEN inv / n_deep >= 0.08 END AS swapped FROM j)"""


@query(f"WITH {WIDE}, {_SHAPE} SELECT rna, n, n_deep, deep, positive, background, reactive, swapped, dms_like, deep AND coalesce(positive, true) AND coalesce(background, true) AND coalesce(reactive, true) AND NOT coalesce(dms_like, false) AND NOT coalesce(swapped, false) AS good FROM k")
def qc_shape_verdict(spark, d):
    return V.shape_checks(_rates(spark, d), ["rna"], DEPTHS, "modified_rate", "untreated_rate", min_depth=80, max_background=0.5, least_positive=0.3)


@query(f"""WITH {WIDE}, {_box_sql('rna')}, p AS (SELECT h.*, CASE WHEN nt IN ('A','C','G','U') THEN hv / nullif(factor, 0) END AS nv FROM hq h LEFT JOIN f ON rna = k),
q AS (SELECT rna, nt, count(*) AS n, count(*) FILTER ({DEEP}) AS n_deep, count(*) FILTER ({DEEP} AND r1 - r2 > 0.0001) AS pos, count(*) FILTER ({DEEP} AND r2 > 0.5) AS bg,
  count(*) FILTER ({DEEP} AND r1 - r2 > b) AS high, count(*) FILTER ({DEEP} AND r1 - r2 < -b) AS inv, count(nv) > 0 AS normalised FROM p JOIN (VALUES ('A', 0.05::DOUBLE), ('C', 0.05::DOUBLE), ('U', 0.01::DOUBLE), ('G', 0.002::DOUBLE)) t(base, b) ON nt = base GROUP BY 1, 2),
j AS (SELECT rna, nt, n, n_deep, n_deep / n >= 0.8 AS deep, CASE WHEN n_deep > 20 THEN bg / n_deep <= 0.05 END AS background, CASE WHEN n_deep > 20 THEN pos / n_deep >= 0.3 END AS positive, CASE WHEN n_deep > 20 THEN high / n_deep >= 0.08 END AS reactive,
  CASE WHEN n_deep > 20 AND high / n_deep >= 0.08 THEN inv / n_deep >= 0.08 END AS swapped, normalised FROM q)
SELECT *, deep AND coalesce(background, true) AND coalesce(positive, true) AND coalesce(reactive, true) AND NOT coalesce(swapped, false) AND normalised AS good FROM j""")
def qc_dms_verdict(spark, d):
    h = _rates(spark, d).withColumnRenamed("hq", "hq_profile").withColumnRenamed("hq_err", "hq_stderr")
    x = ST.with_norm(h, N.boxplot_factor(h, "hq_profile", ["rna"]), ["rna"])
    return V.dms_checks(x, ["rna"], DEPTHS, "modified_rate", "untreated_rate", "norm_profile", min_depth=80, max_background=0.5, least_positive=0.3)


@query(f"WITH {WIDE}, x AS (SELECT rna, d1 AS depth, r1 AS rate FROM prof) SELECT rna, " + ", ".join(f"round(quantile_cont({c}, {p / 100}), 6) AS p{p}_{c}" for c in ("depth", "rate") for p in (5, 50, 90, 95)) + " FROM x GROUP BY 1")
def figure_percentiles(spark, d):
    out = V.figure_percentiles(_rates(spark, d).select("rna", F.col("modified_depth").cast("double").alias("depth"), F.col("modified_rate").alias("rate")), ["rna"], ["depth", "rate"])
    return out.select("rna", *[r6(F.col(c), c) for c in out.columns if c != "rna"])


LONG = "long AS (SELECT rna, 'modified' AS sample, r1 AS rate, d1 AS depth FROM prof UNION ALL SELECT rna, 'untreated', r2, d2 FROM prof UNION ALL SELECT rna, 'denatured', r3, d3 FROM prof)"


def _long(spark, d):
    one = [F.struct(F.lit(s).alias("sample"), F.col(f"{s}_rate").alias("rate"), F.col(f"{s}_depth").alias("depth")) for s in P.SAMPLES.values()]
    return _rates(spark, d).select("rna", F.explode(F.array(*one)).alias("x")).select("rna", "x.*")


def _binned(keys: str, value: str, source: str) -> str:
    return f"""b AS (SELECT {keys}, CAST(least(bins - 1, floor(({value} - low) * bins / (high - low))) AS INT) AS bin, count(*) AS n FROM {source} WHERE {value} BETWEEN low AND high AND high > low GROUP BY ALL)
SELECT {keys}, bin, n, round(n / max(n) OVER (PARTITION BY {keys}), 6) AS height FROM b"""


@query(f"WITH {WIDE}, {LONG}, s AS (SELECT rna, sample, count(*) AS n, quantile_cont(rate, 0.9) AS p FROM long GROUP BY 1, 2), t AS (SELECT rna, CASE WHEN max(p) FILTER (n > 10) < 0.48 THEN 0.5::DOUBLE ELSE 0.9::DOUBLE END AS high, 0::DOUBLE AS low, CASE WHEN max(n) < 500 THEN 10 ELSE 30 END AS bins FROM s GROUP BY 1), x AS (SELECT long.*, high, low, bins FROM long JOIN t ON long.rna = t.rna), " + _binned("rna, sample", "rate", "x"))
def rate_histogram_by_data(spark, d):
    return V.rate_histogram(_long(spark, d), ["rna"], wide=0.9, narrow=0.5, cut=0.48).withColumn("height", F.round("height", 6))


@query(f"WITH {WIDE}, {LONG}, s AS (SELECT rna, sample, quantile_cont(depth, 0.9) AS p FROM long GROUP BY 1, 2), t AS (SELECT rna, max(p) * 1.1::DOUBLE AS high, 0::DOUBLE AS low, 30 AS bins FROM s GROUP BY 1), x AS (SELECT long.*, high, low, bins FROM long JOIN t ON long.rna = t.rna), " + _binned("rna, sample", "depth", "x"))
def depth_histogram(spark, d):
    return V.depth_histogram(_long(spark, d), ["rna"]).withColumn("height", F.round("height", 6))


@query(f"WITH {WIDE}, x AS (SELECT rna, v AS value, -1::DOUBLE AS low, 4::DOUBLE AS high, 30 AS bins FROM three WHERE {UPPER}), " + _binned("rna", "value", "x"))
def reactivity_histogram(spark, d):
    x = _rates(spark, d).filter(V.in_histogram(F.col("nt"), F.col("reactivity")))
    return V.ranged_histogram(x, ["rna"], "reactivity", F.lit(-1.0), F.lit(4.0), F.lit(30)).withColumn("height", F.round("height", 6))


@query(f"WITH {WIDE}, y AS (SELECT nt, r1 - r2 AS v FROM prof WHERE {UPPER}), t AS (SELECT nt, min(v) AS low, quantile_cont(v, 0.95) AS p, 20 AS bins FROM y GROUP BY 1), x AS (SELECT y.nt, v, low, p * CASE WHEN p < 0 THEN 0.8::DOUBLE ELSE 1.2::DOUBLE END AS high, bins FROM y JOIN t ON y.nt = t.nt), " + _binned("nt", "v", "x"))
def nucleotide_histogram(spark, d):
    x = _rates(spark, d).filter(F.col("nt").rlike("^[A-Z]$")).select("nt", (F.col("modified_rate") - F.col("untreated_rate")).alias("v"))
    return V.nucleotide_histogram(x, ["nt"], "v").withColumn("height", F.round("height", 6))


@query(f"WITH {WIDE}, {_box_sql('rna')}, p AS (SELECT rna, hv, CASE WHEN nt IN ('A','C','G','U') THEN hv / nullif(factor, 0) END AS nv FROM hq LEFT JOIN f ON rna = k) SELECT rna, round(arg_max(hv / nullif(nv, 0), nv), 6) AS factor FROM p GROUP BY 1")
def shown_norm_factor(spark, d):
    h = P.hq(spark, d).withColumnRenamed("hq", "hq_profile").withColumnRenamed("hq_err", "hq_stderr")
    x = ST.with_norm(h, N.boxplot_factor(h, "hq_profile", ["rna"]), ["rna"])
    return V.shown_factor(x, ["rna"], "hq_profile", "norm_profile").withColumn("factor", F.round("factor", 6))


@query(f"WITH {WIDE}, p AS (SELECT rna, quantile_cont(CASE WHEN coalesce(r2 <= 0.45, true) THEN r1 / 10 END, 0.98) AS p FROM prof GROUP BY 1) SELECT rna, CASE WHEN p < 0.01 THEN 0.01::DOUBLE WHEN p < 0.02 THEN 0.02::DOUBLE WHEN p < 0.04 THEN 0.04::DOUBLE WHEN p < 0.08 THEN 0.08::DOUBLE WHEN p < 0.16 THEN 0.16::DOUBLE ELSE 0.32::DOUBLE END AS top FROM p")
def axis_top(spark, d):
    return V.axis_top(_rates(spark, d).withColumn("r", F.col("modified_rate") / 10), ["rna"], "r", "untreated_rate", 0.45)


@query(f"WITH {WIDE} SELECT rna, pos, round(r1 - s1, 6) AS low, round(r1 + s1, 6) AS high, " + ", ".join(f"CASE WHEN hv IS NULL THEN 'none' WHEN hv < {a} THEN 'low' WHEN hv < {b} THEN 'middle' ELSE 'high' END AS {k}" for k, (a, b) in V.COLOURS.items()) + " FROM (SELECT hq.*, hq.s1 FROM hq)")
def bands_and_colours(spark, d):
    r, s = F.col("modified_rate"), F.col("modified_stderr")
    return _rates(spark, d).select("rna", "pos", r6(r - s, "low"), r6(r + s, "high"), *[V.colour(F.col("hq"), k).alias(k) for k in V.COLOURS])


@query(f"WITH {WIDE}, t AS (SELECT *, substr('GACGU', CAST(pos % 5 AS INT) + 1, 1) AS b, lead(substr('GACGU', CAST(pos % 5 AS INT) + 1, 1)) OVER (PARTITION BY rna ORDER BY pos) AS nb FROM three), s AS (SELECT rna, count(*) FILTER (nb IN ('A','G')) AS a, count(*) FILTER (nb IN ('C','U')) AS c, quantile_cont(v, 0.75) FILTER (nb IN ('A','G')) AS pur, quantile_cont(v, 0.75) FILTER (nb IN ('C','U')) AS pyr, quantile_cont(CASE WHEN nb IN ('A','G') THEN v WHEN nb IN ('C','U') THEN v * 0.65::DOUBLE END, 0.75) AS pool FROM t WHERE b = 'G' AND v IS NOT NULL GROUP BY 1) SELECT rna, CASE WHEN a < 15 OR c < 15 THEN least(pool, pool / 0.65::DOUBLE) ELSE least(pur, pyr) END < 0.015 AS suppressed FROM s")
def qc_n7(spark, d):
    p = P.profile(spark, d).withColumn("b", F.substring(F.lit("GACGU"), F.col("pos") % 5 + 1, 1))
    return N.n7_factors(p, "reactivity", "b", "pos", ["rna"]).select("rna", N.n7_suppressed(F.col("gpur"), F.col("gpyr")).alias("suppressed"))


ENDS = """fw AS (SELECT read_id, arg_min(idx, abs("left" - fw_left) * 100 + idx) AS fw FROM reads, primers WHERE abs("left" - fw_left) <= 10 GROUP BY 1), rv AS (SELECT read_id, arg_min(idx, abs("right" - rv_right) * 100 + idx) AS rv FROM reads, primers WHERE abs("right" - rv_right) <= 10 GROUP BY 1),
e AS (SELECT r.*, fw.fw, rv.rv FROM reads r LEFT JOIN fw ON r.read_id = fw.read_id LEFT JOIN rv ON r.read_id = rv.read_id)"""


def _ends(spark, d):
    p = R.primer_array(P.PRIMERS)
    return P.reads(spark, d).select("*", R.nearest_primer(F.col("left"), p, "fw_left", 10).alias("fw"), R.nearest_primer(F.col("right"), p, "rv_right", 10).alias("rv"))


@query(f"WITH {READS}, {PRIMERS}, {ENDS} SELECT read_id, coalesce(fw, -999) <> coalesce(rv, -999) AS pair, CASE WHEN reverse THEN rv IS NULL ELSE fw IS NULL END AS mate, fw IS NULL AS fw_only FROM e")
def off_target_pairs(spark, d):
    fw, rv = F.col("fw"), F.col("rv")
    return _ends(spark, d).select("read_id", Q.off_target_pair(fw, rv).alias("pair"), Q.off_target_mate(fw, rv, F.col("reverse")).alias("mate"), Q.off_target_pair(fw, rv, need_rv=False).alias("fw_only"))


_LABEL = "CASE WHEN mapq < 10 THEN 'low_mapq_mapped_depth' WHEN fw IS NULL AND read_id % 4 = 0 THEN 'off_target_mapped_depth' WHEN fw IS NULL THEN 'mapped_depth' ELSE 'primer_pair_' || (fw + 1) || '_mapped_depth' END"
_LABELS = ["mapped_depth", *[f"primer_pair_{i}_mapped_depth" for i in range(1, 6)], "off_target_mapped_depth", "low_mapq_mapped_depth"]


def _labelled(spark, d):
    category = F.when(F.col("mapq") < 10, "LOW_MAPQ").when(F.col("fw").isNull() & (F.col("read_id") % 4 == 0), "OFF_TARGET").otherwise("INCLUDED")
    return _ends(spark, d).withColumn("category", category).withColumn("primer", F.col("fw"))


@query(f"WITH {READS}, {PRIMERS}, {ENDS}, u AS (SELECT {_LABEL} AS label, unnest(range(\"left\", \"right\" + 1)) AS pos FROM e) SELECT CAST(pos AS INT) AS pos, " + ", ".join(f"count(*) FILTER (label = '{c}') AS {c}" for c in _LABELS) + " FROM u GROUP BY 1")
def primer_pair_depths(spark, d):
    return Q.mapped_depths(_labelled(spark, d), [], 5)


@query(f"WITH {READS}, {PRIMERS}, {ENDS}, u AS (SELECT {_LABEL} AS label, unnest(range(\"left\", \"right\" + 1)) AS pos FROM e), c AS (SELECT label, pos, count(*) AS n FROM u GROUP BY 1, 2), m AS (SELECT label, max(n) AS n FROM c GROUP BY 1) SELECT 'modified' AS sample, idx, concat_ws(chr(9), 'Primer_pair_' || (idx + 1), 'ACGT', fw_left, fw_right, 'TTGC', rv_left, rv_right, n) AS line FROM m JOIN primers ON label = 'primer_pair_' || (idx + 1) || '_mapped_depth'")
def abundance_text(spark, d):
    depths = Q.mapped_depths(_labelled(spark, d), [], 5).agg(*[F.max(f"primer_pair_{i + 1}_mapped_depth").alias(str(i)) for i in range(5)])
    rows = [F.struct(F.lit("modified").alias("sample"), F.lit(i).alias("idx"), F.lit("ACGT").alias("fw_seq"), F.lit(p[0]).alias("fw_left"), F.lit(p[1]).alias("fw_right"), F.lit("TTGC").alias("rv_seq"), F.lit(p[2]).alias("rv_left"), F.lit(p[3]).alias("rv_right"), F.col(str(i)).alias("max_depth")) for i, p in enumerate(P.PRIMERS)]
    return ST.abundance_lines(depths.select(F.explode(F.array(*rows)).alias("r")).select("r.*").filter("max_depth > 0"))


@query(f"WITH {READS}, {PRIMERS}, {ENDS}, u AS (SELECT CASE WHEN mapq % 2 = 0 THEN 'even' ELSE 'odd' END AS sample, CASE WHEN mapq < 30 AND mapq % 2 = 0 THEN 0 ELSE fw END AS x FROM e) SELECT sample, sum(coalesce(x, 0)) > 0 AS present FROM u GROUP BY 1")
def sample_presence(spark, d):
    x = _ends(spark, d).select(F.when(F.col("mapq") % 2 == 0, "even").otherwise("odd").alias("sample"), F.when((F.col("mapq") < 30) & (F.col("mapq") % 2 == 0), 0).otherwise(F.col("fw")).alias("x"))
    return Q.present_samples(x, ["x"])


@query(f"WITH {READS}, {PRIMERS} SELECT read_id, idx, fw_right < \"left\" AND \"left\" < rv_left AS interior FROM reads JOIN primers ON idx = read_id % 5")
def amplicon_interior(spark, d):
    p = F.element_at(R.primer_array(P.PRIMERS), (F.col("read_id") % 5 + 1).cast("int"))
    return P.reads(spark, d).withColumn("p", p).select("read_id", F.col("p.idx").alias("idx"), Q.inside_amplicon(F.col("left"), F.col("p.fw_right"), F.col("p.rv_left")).alias("interior"))


_PAIRS = f"pr AS (SELECT p_brand AS rna, substr(translate(md5(p_type), '{HEX}', '{DNA}'), 1, 6) AS fw_seq, substr(translate(md5(p_type), '{HEX}', '{DNA}'), 9, 6) AS rv_seq, p_partkey FROM part)"


def _pairs(spark, d):
    s = F.translate(F.md5("p_type"), HEX, DNA)
    return P.read(spark, d, "part").select(F.col("p_brand").alias("rna"), F.substring(s, 1, 6).alias("fw_seq"), F.substring(s, 9, 6).alias("rv_seq"), "p_partkey")


@query(f"WITH {_PAIRS} SELECT rna, fw_seq, rv_seq, count(*) AS n FROM pr GROUP BY 1, 2, 3 HAVING count(*) > 1")
def repeated_primers(spark, d):
    return Q.repeated_pairs(_pairs(spark, d))


@query(f"WITH {_PAIRS}, i AS (SELECT *, CAST(row_number() OVER (PARTITION BY rna ORDER BY p_partkey) - 1 AS INT) AS idx FROM pr) SELECT rna, idx, fw_seq, rv_seq, CAST(p_partkey AS INT) AS fw_left, CAST(p_partkey + 5 AS INT) AS fw_right, CAST(p_partkey + 90 AS INT) AS rv_left, CAST(p_partkey + 95 AS INT) AS rv_right FROM i")
def primer_files(spark, d):
    """Written with sequences and places, then both read back."""
    k = F.col("p_partkey").cast("int")
    x = _pairs(spark, d).selectExpr("*", "CAST(row_number() OVER (PARTITION BY rna ORDER BY p_partkey) - 1 AS INT) AS idx").select("rna", "idx", "fw_seq", "rv_seq", k.alias("fw_left"), (k + 5).alias("fw_right"), (k + 90).alias("rv_left"), (k + 95).alias("rv_right"))
    path = scratch(spark)
    Q.write_primers(x, f"{path}/places")
    x.groupBy("rna").agg(F.array_sort(F.collect_list(F.struct("idx", F.concat_ws(" ", "fw_seq", "rv_seq").alias("t")))).alias("p")).select(F.concat(F.lit(">"), "rna", F.lit("\n"), F.array_join(F.col("p.t"), "\n"))).coalesce(1).write.text(f"{path}/sequences")
    return Q.read_primer_sequences(spark, f"{path}/sequences/part-*").join(Q.read_primer_places(spark, f"{path}/places/part-*"), ["rna", "idx"])


@query("WITH s AS (SELECT o_orderkey AS read_id, upper(translate(md5(CAST(o_orderkey AS VARCHAR)), '" + HEX + "', '" + DNA + "')) AS seq, CAST(o_custkey % 20 AS INT) AS a, CAST(o_custkey % 20 + 5 AS INT) AS b FROM orders), c AS (SELECT read_id, i, CASE WHEN (i >= a - 1 AND i < b) OR (a = 0 AND i = 31) THEN lower(substr(seq, CAST(i + 1 AS INT), 1)) ELSE substr(seq, CAST(i + 1 AS INT), 1) END AS c FROM s, (SELECT unnest(range(0, 32)) AS i)) SELECT read_id, string_agg(c, '' ORDER BY i) AS seq FROM c GROUP BY 1")
def mask_primer_sites(spark, d):
    left = (F.col("o_custkey") % 20).cast("int")
    seq = F.translate(F.md5(F.col("o_orderkey").cast("string")), HEX, DNA)
    x = P.read(spark, d, "orders").select(F.col("o_orderkey").alias("read_id"), seq.alias("seq"), F.array(F.struct(left.alias("left"), (left + 5).alias("right"))).alias("sites"))
    return x.select("read_id", V.masked(F.col("seq"), F.col("sites")).alias("seq"))


@query("WITH x AS (SELECT o_orderkey AS id, o_orderkey * CASE o_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 1000000 ELSE 10 END AS n FROM orders) SELECT id, CASE WHEN regexp_matches(n::VARCHAR, '0{9}$') THEN regexp_replace(n::VARCHAR, '0{9}$', '') || 'G' WHEN regexp_matches(n::VARCHAR, '0{6}$') THEN regexp_replace(n::VARCHAR, '0{6}$', '') || 'M' WHEN regexp_matches(n::VARCHAR, '0{3}$') THEN regexp_replace(n::VARCHAR, '0{3}$', '') || 'k' ELSE n::VARCHAR END AS short, format('{:,}', n) AS grouped FROM x")
def number_texts(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey") % 4
    n = k * F.when(c == 0, 1).when(c == 1, 1000).when(c == 2, 1000000).otherwise(10)
    return P.read(spark, d, "orders").select(k.alias("id"), V.metric(n).alias("short"), V.commas(n).alias("grouped"))


def _factor_sql(reagent: str, how: str) -> str:
    from riboscan.functions.profile import REAGENTS

    f = REAGENTS[reagent]
    unit = (min if how == "down" else max)(f.values())
    return "CASE nt " + " ".join(f"WHEN '{b}' THEN {unit} / {x}" for b, x in f.items()) + " ELSE 1 END"


@query(f"WITH {WIDE} SELECT rna, pos, round(v * ({_factor_sql('5NIA', 'down')}), 6) AS down, round(v * ({_factor_sql('1M7', 'up')}), 6) AS up FROM three")
def rescale_reagents(spark, d):
    return P.profile(spark, d).select("rna", "pos", r6(rescale(F.col("nt"), F.col("reactivity"), "5NIA"), "down"), r6(rescale(F.col("nt"), F.col("reactivity"), "1M7", "up"), "up"))


@query(f"WITH {WIDE}, u AS (SELECT *, upper(translate(md5('x' || pos || rna), '{HEX}', '01{'0' * 14}')) AS m, pos % 3 = 0 AS p FROM three WHERE v IS NOT NULL), k AS (SELECT *, rank() OVER (PARTITION BY rna ORDER BY v) + (count(*) OVER (PARTITION BY rna, v) - 1) / 2 AS r FROM u) SELECT rna, round((sum(r) FILTER (p) - count(*) FILTER (p) * (count(*) FILTER (p) + 1) / 2) / (count(*) FILTER (p) * count(*) FILTER (NOT p)), 6) AS auc FROM k GROUP BY 1")
def auc_of_pairing_file(spark, d):
    """The pairing table is written and read back; unpaired places are every third."""
    path = scratch(spark)
    n = F.col("id") + 1
    rows = spark.range(P.LENGTH).select(F.concat_ws(" ", n.cast("string"), F.lit("A"), F.col("id").cast("string"), (n + 1).cast("string"), F.when(F.col("id") % 3 == 0, "0").otherwise("1"), n.cast("string")).alias("v"), "id")
    rows.union(spark.range(1).select(F.lit(f"{P.LENGTH}  a title").alias("v"), F.lit(-1).cast("long").alias("id"))).orderBy("id").coalesce(1).select("v").write.text(path)
    ct = SX.read_ct(spark, path).select("pos", (~F.col("paired")).alias("unpaired"))
    return A.auc(P.profile(spark, d).join(ct, "pos"), "reactivity", "unpaired", ["rna"]).withColumn("auc", F.round("auc", 6))


_F6 = lambda c: f"coalesce(printf('%.6f', {c}::DOUBLE), 'nan')"


@query(f"WITH {WIDE}, {_box_sql('rna')} SELECT CAST(pos + 1 AS VARCHAR) AS nucleotide, nt, {', '.join(f'm{i}::VARCHAR AS m{i}, {_F6(f'r{i}')} AS r{i}' for i in (1, 2, 3))}, {_F6('v')} AS reactivity, {_F6('e')} AS error, {_F6('hv')} AS hq, {_F6('CASE WHEN upper(nt) = nt THEN hv / nullif(factor, 0) END')} AS norm FROM hq LEFT JOIN f ON rna = k WHERE rna = 'O'")
def profile_text(spark, d):
    """One target's profile with its norm columns, written and its fields read back as text."""
    h = _rates(spark, d).withColumnRenamed("hq", "hq_profile").withColumnRenamed("hq_err", "hq_stderr").withColumnRenamed("std_err", "stderr")
    x = ST.with_norm(h, N.boxplot_factor(h, "hq_profile", ["rna"]), ["rna"]).filter("rna = 'O'")
    path = scratch(spark)
    ST.write_profile(x, path)
    t = spark.read.option("sep", "\t").option("header", True).csv(path)
    return t.select(F.col("Nucleotide").alias("nucleotide"), F.col("Sequence").alias("nt"), *[c for i, s in enumerate(ST.SAMPLES, 1) for c in (F.col(f"{s}_mutations").alias(f"m{i}"), F.col(f"{s}_rate").alias(f"r{i}"))], F.col("Reactivity_profile").alias("reactivity"), F.col("Std_err").alias("error"), F.col("HQ_profile").alias("hq"), F.col("Norm_profile").alias("norm"))


@query(f"WITH {WIDE}, {_box_sql('rna')} SELECT CAST(pos AS INT) AS pos, round(CASE WHEN upper(nt) = nt THEN hv / nullif(factor, 0) END, 6) AS value, round(CASE WHEN upper(nt) = nt THEN he / nullif(factor, 0) END, 6) AS stderr, upper(nt) AS nt FROM hq LEFT JOIN f ON rna = k WHERE rna = 'F'")
def profile_scan(spark, d):
    h = _rates(spark, d).withColumnRenamed("hq", "hq_profile").withColumnRenamed("hq_err", "hq_stderr").withColumnRenamed("std_err", "stderr")
    path = scratch(spark)
    ST.write_profile(ST.with_norm(h, N.boxplot_factor(h, "hq_profile", ["rna"]), ["rna"]).filter("rna = 'F'"), path)
    t = ST.read_export(spark, path)
    return t.select("pos", r6(F.col("value"), "value"), r6(F.col("stderr"), "stderr"), "nt")


@query(f"WITH {VARIANTS} SELECT \"left\", \"right\", seq, count(*) AS n FROM vars WHERE rna = 'O' GROUP BY ALL")
def variant_scan(spark, d):
    """Variants of one target, written as text with the depths and read back."""
    c = P.variants(spark, d).filter("rna = 'O'").groupBy("rna", "left", "right", "seq").agg(F.count("*").alias("n"))
    depths = P.calls(spark, d).filter("rna = 'O'").groupBy("rna", "pos").agg(F.count("*").alias("depth"))
    path = scratch(spark)
    ST.write_variants(ST.variant_lines(c, depths), path)
    return ST.read_variants(spark, path)


@query(f"WITH {READS}, b AS (SELECT least(20, CAST(floor((\"right\" - \"left\" + 1) / 50.0) AS INT)) AS bin FROM reads), s AS (SELECT CAST(unnest(range(0, 21)) AS INT) AS bin), h AS (SELECT s.bin, count(b.bin) / (SELECT count(*) FROM b) AS f FROM s LEFT JOIN b ON s.bin = b.bin GROUP BY 1) SELECT bin, CASE WHEN bin < 20 THEN '[' || bin * 50 || ',' || (bin * 50 + 49) || ']' ELSE '>=1000' END || chr(9) || printf('%.6f', f) AS line FROM h")
def histogram_text(spark, d):
    return ST.histogram_lines(A.histogram(P.reads(spark, d), F.col("right") - F.col("left") + 1, 0, 50, 21), 0, 50, 21, ranges=True)


_SEQ = f"translate(md5(CAST(o_orderkey AS VARCHAR)), '{HEX}', '{DNA}')"


def _orders(spark, d):
    k = F.col("o_orderkey").cast("string")
    return P.read(spark, d, "orders").select("o_orderkey", "o_custkey", F.concat(F.lit("r"), k).alias("read_id"), F.translate(F.md5(k), HEX, DNA).alias("seq"), F.md5(k).alias("qual"))


@query(f"SELECT 'r' || o_orderkey AS read_id, {_SEQ} AS seq, md5(CAST(o_orderkey AS VARCHAR)) AS qual FROM orders")
def fastq_round_trip(spark, d):
    path = scratch(spark)
    SX.write_fastq(_orders(spark, d), path)
    return SX.read_fastq(spark, f"{path}/*.gz")


@query(f"SELECT 'r' || o_orderkey AS name, translate({_SEQ} || {_SEQ} || {_SEQ}, 'T', 'U') AS seq, 96 AS len FROM orders")
def fasta_round_trip(spark, d):
    path = scratch(spark)
    SX.write_fasta(_orders(spark, d).select(F.col("read_id").alias("name"), F.repeat("seq", 3).alias("seq")), path)
    return SX.read_fasta(spark, path, rna=True)


@query(f"""SELECT 'r' || o_orderkey AS read_id, CASE WHEN o_custkey % 7 = 0 THEN '*' ELSE 'rna' || (o_custkey % 3) END AS rna, CAST(o_custkey % 500 AS INT) AS "left", CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_custkey % 500 + 33 AS INT) END AS "right",
CASE WHEN o_custkey % 7 = 0 THEN 'UNMAPPED' WHEN o_orderkey % 40 < 10 THEN 'LOW_MAPQ' ELSE 'INCLUDED' END AS category, (o_custkey % 2 = 1) AS reverse, 'last' || o_orderkey AS tag FROM orders""")
def sam_scan(spark, d):
    """Alignments written as text, with a header and a repeated tag, and read back."""
    o = _orders(spark, d)
    off = F.col("o_custkey") % 7 == 0
    flag = F.when(F.col("o_custkey") % 2 == 1, "16").otherwise("0")
    line = F.concat_ws("\t", "read_id", flag, F.when(off, "*").otherwise(F.concat(F.lit("rna"), (F.col("o_custkey") % 3).cast("string"))), (F.col("o_custkey") % 500 + 1).cast("string"), (F.col("o_orderkey") % 40).cast("string"), F.when(off, "*").otherwise("20M2D12M"), F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual", F.lit("XX:Z:first"), F.lit("MD:Z:20^AC12"), F.concat(F.lit("XX:Z:last"), F.col("o_orderkey").cast("string")))
    path = scratch(spark)
    spark.range(1).select(F.lit("@HD\tVN:1.0").alias("v")).union(o.select(line.alias("v"))).write.text(path)
    return SX.read_sam(spark, path).select("read_id", "rna", "left", "right", "category", "reverse", F.col("tags")["XX"].alias("tag"))


@query("SELECT 'r' || o_orderkey AS read_id, CAST(o_custkey % 500 AS INT) AS \"left\", CAST(o_custkey % 500 + 3 AS INT) AS \"right\", CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 5 AS INT) END AS primer, substr('ACGT', CAST(o_custkey % 4 AS INT) + 1, 1) AS base, o_orderkey % 2 = 0 AS ambig, o_orderkey % 3 = 0 AS second FROM orders")
def mutation_record_round_trip(spark, d):
    o = _orders(spark, d)
    left = (F.col("o_custkey") % 500).cast("int")
    m = lambda q: F.struct((left + 1).alias("left"), (left + 3).alias("right"), F.substring(F.lit("ACGT"), F.col("o_custkey") % 4 + 1, 1).alias("seq"), F.lit(q).alias("qual"), F.lit("AT").alias("tag"), (F.col("o_orderkey") % 2 == 0).alias("ambig"))
    bits = F.array(F.lit(True), F.col("o_orderkey") % 3 == 0, F.lit(False))
    records = o.select(F.lit("MERGED").alias("read_type"), "read_id", left.alias("left"), (left + 3).alias("right"), F.lit("INCLUDED").alias("category"), F.when(F.col("o_custkey") % 5 != 0, (F.col("o_custkey") % 5).cast("int")).alias("primer"), bits.alias("mapped_depth"), bits.alias("depth"), bits.alias("count"), F.array(m('"'), m("I")).alias("mutations"))
    path = scratch(spark)
    SM.write_mutations(records, path)
    first = F.col("mutations")[0]
    return SM.read_mutations(spark, path).select("read_id", "left", "right", "primer", first["seq"].alias("base"), first["ambig"].alias("ambig"), F.col("depth")[1].alias("second"))


@query("SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INT) AS pos, p_partkey % 7 + p_partkey % 11 AS mutations, p_partkey % 100 AS read_depth, CAST(p_size AS BIGINT) AS effective_depth FROM part")
def counts_scan(spark, d):
    from riboscan.functions.mutations import CLASSES

    k = F.col("p_partkey")
    zero = [F.lit(0).alias(c) for c in CLASSES if c not in ("AT", "complex_deletion")]
    t = P.read(spark, d, "part").selectExpr("*", "CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INT) AS pos").select("pos", (k % 7).alias("AT"), (k % 11).alias("complex_deletion"), *zero, (k % 100).alias("read_depth"), F.col("p_size").alias("effective_depth"), F.col("pos").alias("place"))
    path = scratch(spark)
    SM.write_counts(t, path)
    return ST.read_counts(spark, path).select(F.col("place").cast("int").alias("pos"), "mutations", "read_depth", "effective_depth")


@query("WITH p AS (SELECT CAST(p_partkey AS INT) AS pos, p_partkey FROM part) SELECT pos, 'modified' AS sample, 'included' AS kind, p_partkey * 2 AS depth FROM p UNION ALL SELECT pos, 'untreated', 'pair_2', p_partkey * 3 FROM p UNION ALL SELECT pos, 'untreated', 'off_target', p_partkey % 5 FROM p")
def mapped_depth_scan(spark, d):
    k = F.col("p_partkey")
    t = P.read(spark, d, "part").select((k + 1).alias("Nucleotide"), F.lit("A").alias("Sequence"), (k * 2).alias("Modified_mapped_depth"), (k * 3).alias("Untreated_primer_pair_2_mapped_depth"), (k % 5).alias("Untreated_off_target_mapped_depth"), F.lit(0.5).alias("Modified_rate"))
    path = scratch(spark)
    t.write.option("sep", "\t").option("header", True).csv(path)
    return ST.read_mapped_depths(spark, path)


@query(f"WITH {WIDE} SELECT CAST(pos AS INT) AS pos, CASE WHEN hv IS NOT NULL THEN round(hv, 6) END AS value, round(CASE WHEN hv IS NULL THEN 0 ELSE he END, 6) AS stderr, upper(nt) AS nt FROM hq WHERE rna = 'O'")
def map_round_trip(spark, d):
    path = scratch(spark)
    SX.write_map(P.hq(spark, d).filter("rna = 'O'").select("pos", F.col("hq").alias("value"), F.col("hq_err").alias("stderr"), "nt"), path)
    return SX.read_map(spark, path).select("pos", r6(F.col("value"), "value"), r6(F.col("stderr"), "stderr"), "nt")


@query(f"SELECT CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'MERGED' END AS read_type, CAST(o_custkey % 500 AS INT) AS \"left\", CASE o_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END AS reverse, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 9 AS INT) END AS primer, {_SEQ} AS seq FROM orders")
def debug_scan(spark, d):
    c = F.col("o_custkey") % 3
    line = F.concat_ws("\t", F.lit("[read]"), F.when(c == 0, "").otherwise("MERGED"), (F.col("o_custkey") % 500).cast("string"), F.lit("900"), F.when(c == 0, "N/A").when(c == 1, "-").otherwise("+"), F.lit("INCLUDED"), F.when(F.col("o_orderkey") % 2 == 0, (F.col("o_orderkey") % 9).cast("string")).otherwise("-999"), "seq", "qual")
    path = scratch(spark)
    _orders(spark, d).select(line.alias("v")).union(spark.range(3).select(F.lit("another line").alias("v"))).write.text(path)
    return ST.read_debug(spark, path).select("read_type", "left", "reverse", "primer", "seq")


@query(f"WITH {READS}, p AS (SELECT pair, min(\"left\") AS l, max(\"right\") AS r, count(*) AS n FROM reads GROUP BY 1) SELECT pair, l AS min_left, r AS max_right FROM p WHERE n = 2 AND l <= 100 AND r >= 200")
def spanning_pairs(spark, d):
    """Pairs that span places 100 to 200, by the least left and largest right end of their reads."""
    m = P.reads(spark, d).groupBy("pair").agg(F.collect_list(F.struct("left", "right")).alias("m"))
    x = m.select("pair", F.array_min(F.col("m.left")).alias("min_left"), F.array_max(F.col("m.right")).alias("max_right"), (F.size("m") == 2).alias("both"))
    return x.filter(F.col("both") & R.spans(F.col("min_left"), F.col("max_right"), 100, 200)).drop("both")


@query(f"SELECT o_orderkey // 2 AS pair, o_orderkey % 2 AS mate, CASE WHEN o_custkey % 5 = 0 THEN 'N' ELSE {_SEQ} END AS seq FROM orders WHERE o_custkey % 5 <> 0")
def without_placeholders(spark, d):
    o = _orders(spark, d).select(F.expr("o_orderkey DIV 2").alias("pair"), (F.col("o_orderkey") % 2).alias("mate"), F.when(F.col("o_custkey") % 5 == 0, "N").otherwise(F.col("seq")).alias("seq"))
    return R.without_placeholders(o, "seq")
