"""Each operator as a query over the supplied tables, and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riboscan.functions import mutations as M
from riboscan.functions import sequence as S
from riboscan.functions.profile import n7_log, rate
from riboscan.operators import depth as D
from riboscan.operators import normalize as N
from riboscan.operators import reads as R
from riboscan.operators import summary as A
from riboscan.operators import targets as T
from riboscan.plans import samples as P

QUERIES, SQL = {}, {}

CALLS = """calls AS (SELECT l_linestatus AS rna, CASE l_returnflag WHEN 'R' THEN 'modified' WHEN 'A' THEN 'untreated' WHEN 'N' THEN 'denatured' END AS sample,
  CAST(l_partkey % 100 AS INT) AS pos, l_discount > 0.05 AS mutated, l_linenumber AS class FROM lineitem)"""
WIDE = CALLS + """, w0 AS (SELECT rna, pos,
  count(*) FILTER (sample = 'modified' AND mutated) AS m1, count(*) FILTER (sample = 'modified') AS d1,
  count(*) FILTER (sample = 'untreated' AND mutated) AS m2, count(*) FILTER (sample = 'untreated') AS d2,
  count(*) FILTER (sample = 'denatured' AND mutated) AS m3, count(*) FILTER (sample = 'denatured') AS d3 FROM calls GROUP BY 1, 2),
wide AS (SELECT *, CASE WHEN pos < 5 THEN lower(substr('ACGU', pos % 4 + 1, 1)) ELSE substr('ACGU', pos % 4 + 1, 1) END AS nt,
  m1 / nullif(d1, 0) AS r1, m2 / nullif(d2, 0) AS r2, m3 / nullif(d3, 0) AS r3 FROM w0),
prof AS (SELECT *, sqrt(r1) / nullif(sqrt(d1), 0) AS s1, sqrt(r2) / nullif(sqrt(d2), 0) AS s2, sqrt(r3) / nullif(sqrt(d3), 0) AS s3 FROM wide),
three AS (SELECT *, (r1 - r2) / nullif(r3, 0) AS v, sqrt(power(s1 / nullif(r3, 0), 2) + power(s2 / nullif(r3, 0), 2) + power(s3 * (r1 - r2) / nullif(r3 * r3, 0), 2)) AS e FROM prof),
hq AS (SELECT *, CASE WHEN nt IN ('A', 'C', 'G', 'U') AND coalesce(r2 <= 0.48, true) AND d1 >= 10 AND d2 >= 10 AND d3 >= 10 THEN v END AS hv,
  CASE WHEN nt IN ('A', 'C', 'G', 'U') AND coalesce(r2 <= 0.48, true) AND d1 >= 10 AND d2 >= 10 AND d3 >= 10 THEN e END AS he FROM three)"""
READS = """reads AS (SELECT o_orderkey AS read_id, o_orderkey // 2 AS pair, CAST(o_custkey % 500 AS INT) AS "left", CAST(o_custkey % 500 + 20 + o_orderkey % 130 AS INT) AS "right",
  CAST(o_custkey % 60 AS INT) AS mapq, o_custkey % 2 = 1 AS reverse FROM orders)"""
PRIMERS = "primers(idx, fw_left, fw_right, rv_left, rv_right) AS (VALUES " + ", ".join(str((i, *p)) for i, p in enumerate(P.PRIMERS)) + ")"
VARIANTS = """vars AS (SELECT l_linestatus AS rna, CAST(l_partkey % 100 AS INT) AS "left", CAST(l_partkey % 100 + 1 + l_linenumber % 3 AS INT) AS "right",
  CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE substr('ACGTACGT', l_linenumber, 2) END AS seq FROM lineitem WHERE l_discount > 0.05)"""


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def r6(c, name: str):
    return F.round(c, 6).alias(name)


@query(f"WITH {CALLS} SELECT rna, sample, pos, count(*) AS depth, count(*) FILTER (mutated) AS mutations, round(count(*) FILTER (mutated) / count(*), 6) AS rate FROM calls GROUP BY 1, 2, 3")
def rates_by_position(spark, d):
    n = P.calls(spark, d).groupBy("rna", "sample", "pos").agg(F.count("*").alias("depth"), F.count(F.when(F.col("mutated"), 1)).alias("mutations"))
    return n.withColumn("rate", F.round(rate(F.col("mutations"), F.col("depth")), 6))


@query(f"WITH {CALLS}, s AS (SELECT rna, sample, unnest(range(0, 110)) AS pos FROM (SELECT DISTINCT rna, sample FROM calls WHERE mutated)), c AS (SELECT * FROM calls WHERE mutated) SELECT s.rna, s.sample, CAST(s.pos AS INT) AS pos, " + ", ".join(f"count(*) FILTER (class = {i}) AS class_{i}" for i in range(1, 8)) + " FROM s LEFT JOIN c ON s.rna = c.rna AND s.sample = c.sample AND s.pos = c.pos GROUP BY 1, 2, 3")
def class_counts_pivot(spark, d):
    c = P.calls(spark, d).filter("mutated").withColumnRenamed("pos", "at")
    return D.dense_counts(c, ["rna", "sample"], F.col("at"), F.col("class"), list(range(1, 8)), 110, {i: f"class_{i}" for i in range(1, 8)})


@query("WITH i AS (SELECT l_linestatus AS rna, CAST(l_partkey % 500 AS INT) AS a, CAST(l_partkey % 500 AS INT) + CAST(l_quantity AS INT) AS b FROM lineitem), u AS (SELECT rna, unnest(range(a, b + 1)) AS pos FROM i) SELECT rna, CAST(pos AS INT) AS pos, count(*) AS depth FROM u GROUP BY 1, 2")
def coverage_depth(spark, d):
    left = (F.col("l_partkey") % 500).cast("int")
    i = P.read(spark, d, "lineitem").select(F.col("l_linestatus").alias("rna"), left.alias("left"), (left + F.col("l_quantity").cast("int")).alias("right"))
    return D.coverage(i, ["rna"])


@query(f"""WITH {READS}, {PRIMERS}, f AS (SELECT read_id, (SELECT min(idx) FROM primers p WHERE abs(r."left" - p.fw_left) <= 10 AND abs(r."left" - p.fw_left) = (SELECT min(abs(r."left" - q.fw_left)) FROM primers q)) AS fw, "left", "right", mapq FROM reads r),
c AS (SELECT CASE WHEN mapq < 10 THEN 'low_mapq' WHEN fw IS NULL THEN 'off_target' ELSE 'included' END AS category, "left", "right" FROM f),
u AS (SELECT category, unnest(range("left", "right" + 1)) AS pos FROM c)
SELECT CAST(pos AS INT) AS pos, count(*) FILTER (category = 'included') AS mapped_depth, count(*) FILTER (category = 'off_target') AS off_target_mapped_depth, count(*) FILTER (category = 'low_mapq') AS low_mapq_mapped_depth FROM u GROUP BY 1""")
def mapped_depth_by_category(spark, d):
    fw = R.nearest_primer(F.col("left"), R.primer_array(P.PRIMERS), "fw_left", 10)
    c = P.reads(spark, d).select("left", "right", F.when(F.col("mapq") < 10, "low_mapq").when(fw.isNull(), "off_target").otherwise("included").alias("category"))
    long = D.coverage(c, ["category"])
    of = lambda k: F.coalesce(F.sum(F.when(F.col("category") == k, F.col("depth"))), F.lit(0))
    return long.groupBy("pos").agg(of("included").alias("mapped_depth"), of("off_target").alias("off_target_mapped_depth"), of("low_mapq").alias("low_mapq_mapped_depth"))


def _reactivity(spark, d, n):
    return P.profile(spark, d, n).select("rna", "pos", r6(F.col("reactivity"), "reactivity"), r6(F.col("std_err"), "std_err"))


@query(f"WITH {WIDE} SELECT rna, pos, round(v, 6) AS reactivity, round(e, 6) AS std_err FROM three")
def reactivity_three_sample(spark, d):
    return _reactivity(spark, d, 3)


@query(f"WITH {WIDE} SELECT rna, pos, round(r1 - r2, 6) AS reactivity, round(sqrt(s1 * s1 + s2 * s2), 6) AS std_err FROM prof")
def reactivity_two_sample(spark, d):
    return _reactivity(spark, d, 2)


@query(f"WITH {WIDE} SELECT rna, pos, round(r1, 6) AS reactivity, round(s1, 6) AS std_err FROM prof")
def reactivity_one_sample(spark, d):
    return _reactivity(spark, d, 1)


@query(f"WITH {WIDE} SELECT rna, pos, nt, round(hv, 6) AS hq_profile, round(he, 6) AS hq_stderr FROM hq")
def hq_profile(spark, d):
    return P.hq(spark, d).select("rna", "pos", "nt", r6(F.col("hq"), "hq_profile"), r6(F.col("hq_err"), "hq_stderr"))


def _box_sql(key: str) -> str:
    part = f"PARTITION BY {key}"
    return f"""x AS (SELECT {key} AS k, hv AS v, row_number() OVER ({part} ORDER BY hv) AS rn, count(*) OVER ({part}) AS n FROM hq WHERE hv IS NOT NULL),
l AS (SELECT k, max(n) AS n, greatest(1.5 * abs(quantile_cont(v, 0.25) - quantile_cont(v, 0.75)), max(v) FILTER (rn = n - CASE WHEN n < 100 THEN n // 20 ELSE n // 10 END)) AS most FROM x GROUP BY k),
o AS (SELECT x.k, v, l.n, row_number() OVER (PARTITION BY x.k ORDER BY v DESC) AS top, count(*) OVER (PARTITION BY x.k) AS m FROM x JOIN l ON x.k = l.k WHERE v < most),
f AS (SELECT k, max(n) AS n, CASE WHEN max(n) >= 20 AND max(m) >= max(n) // 10 THEN sum(v) FILTER (top <= n // 10) / nullif(max(n) // 10, 0) END AS factor FROM o GROUP BY k)"""


@query(f"WITH {WIDE}, {_box_sql('rna')} SELECT k AS rna, n, round(factor, 6) AS factor FROM f")
def boxplot_factor(spark, d):
    return N.boxplot_factor(P.hq(spark, d), "hq", ["rna"]).select("rna", "n", r6(F.col("factor"), "factor"))


@query(f"WITH {WIDE}, {_box_sql('rna')} SELECT rna, pos, CASE WHEN nt IN ('A','C','G','U') THEN round(hv / nullif(factor, 0), 6) END AS norm_profile, CASE WHEN nt IN ('A','C','G','U') THEN round(he / nullif(factor, 0), 6) END AS norm_stderr FROM hq LEFT JOIN f ON rna = k")
def norm_profile(spark, d):
    h = P.hq(spark, d)
    out = h.join(N.boxplot_factor(h, "hq", ["rna"]), "rna", "left")
    up = F.col("nt").isin("A", "C", "G", "U")
    return out.select("rna", "pos", F.when(up, F.round(F.try_divide("hq", "factor"), 6)).alias("norm_profile"), F.when(up, F.round(F.try_divide("hq_err", "factor"), 6)).alias("norm_stderr"))


@query(f"WITH {WIDE}, {_box_sql('rna')}, g AS (WITH {_box_sql('1')} SELECT n, factor FROM f) SELECT f.k AS rna, round(f.factor, 6) AS own_factor, round(g.factor, 6) AS group_factor FROM f, g")
def group_vs_indiv_norm(spark, d):
    h = P.hq(spark, d)
    group = N.boxplot_factor(h, "hq", []).select(r6(F.col("factor"), "group_factor"))
    return N.boxplot_factor(h, "hq", ["rna"]).select("rna", r6(F.col("factor"), "own_factor")).crossJoin(F.broadcast(group))


@query(f"""WITH {WIDE}, x AS (SELECT rna, nt, hv AS v FROM hq WHERE hv IS NOT NULL),
q AS (SELECT rna, nt, count(*) AS n, quantile_cont(v, 0.9) AS lo, quantile_cont(v, 0.95) AS hi, quantile_cont(v, 0.75) FILTER (v > 0.001) AS up FROM x GROUP BY 1, 2),
m AS (SELECT x.rna, x.nt, avg(v) FILTER (v >= lo AND v < hi) AS mid FROM x JOIN q ON x.rna = q.rna AND x.nt = q.nt GROUP BY 1, 2)
SELECT q.rna, q.nt, n, CASE WHEN n >= 10 AND greatest(coalesce(mid, 0), coalesce(up, 0)) >= 0.002 THEN round(greatest(coalesce(mid, 0), coalesce(up, 0)), 6) END AS factor FROM q JOIN m ON q.rna = m.rna AND q.nt = m.nt""")
def pernt_factor(spark, d):
    return N.pernt_factor(P.hq(spark, d), "hq", "nt", ["rna"], threshold=10).select("rna", "nt", "n", r6(F.col("factor"), "factor"))


@query(f"""WITH {WIDE}, t AS (SELECT *, substr('GACGU', CAST(pos % 5 AS INT) + 1, 1) AS b, substr('GACGU', CAST((pos + 1) % 5 AS INT) + 1, 1) AS bn, lead(pos) OVER (PARTITION BY rna ORDER BY pos) AS nx FROM three),
g AS (SELECT rna, v, CASE WHEN nx IS NULL THEN NULL ELSE lead(b) OVER (PARTITION BY rna ORDER BY pos) END AS nb, b, pos FROM t),
s AS (SELECT rna, count(*) FILTER (nb IN ('A','G')) AS a, count(*) FILTER (nb IN ('C','U')) AS c, quantile_cont(v, 0.75) FILTER (nb IN ('A','G')) AS pur, quantile_cont(v, 0.75) FILTER (nb IN ('C','U')) AS pyr,
  quantile_cont(CASE WHEN nb IN ('A','G') THEN v WHEN nb IN ('C','U') THEN v * 0.65::DOUBLE END, 0.75) AS pool FROM g WHERE b = 'G' AND v IS NOT NULL GROUP BY rna),
k AS (SELECT rna, CASE WHEN a < 15 OR c < 15 THEN pool ELSE pur END AS gpur, CASE WHEN a < 15 OR c < 15 THEN pool / 0.65::DOUBLE ELSE pyr END AS gpyr FROM s)
SELECT g.rna, pos, CASE WHEN nb IS NULL OR v IS NULL OR v = 0 THEN NULL WHEN v < 0 THEN 3.32::DOUBLE WHEN nb IN ('A','G') THEN round(log2(gpur / v), 6) ELSE round(log2(gpyr / v), 6) END AS n7 FROM g JOIN k ON g.rna = k.rna WHERE b = 'G'""")
def n7_norm(spark, d):
    p = P.profile(spark, d).withColumn("b", F.substring(F.lit("GACGU"), F.col("pos") % 5 + 1, 1))
    p = p.withColumn("nb", F.lead("b").over(Window.partitionBy("rna").orderBy("pos")))
    k = N.n7_factors(p, "reactivity", "b", "pos", ["rna"])
    v, factor = F.col("reactivity"), F.when(F.col("nb").isin("A", "G"), F.col("gpur")).otherwise(F.col("gpyr"))
    return p.filter("b = 'G'").join(k, "rna").select("rna", "pos", F.when(F.col("nb").isNotNull() & v.isNotNull() & (v != 0), F.round(n7_log(factor, v), 6)).alias("n7"))


@query("""WITH s AS (SELECT doc_id, regexp_replace(text, '[^ -~]', '', 'g') AS seq FROM documents),
c AS (SELECT doc_id, unnest(string_split(seq, '')) AS c, generate_subscripts(string_split(seq, ''), 1) AS i, length(seq) AS n FROM s),
w AS (SELECT doc_id, i, n, sum(unicode(c) % 42) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS q FROM c),
t AS (SELECT doc_id, min(i) - 1 AS cut FROM w WHERE q < 14 * 5 AND i <= n - 5 GROUP BY 1)
SELECT s.doc_id, CASE WHEN length(seq) < 5 OR cut < 25 THEN 'N' WHEN cut IS NOT NULL THEN substr(seq, 1, CAST(cut AS INT)) ELSE seq END AS trimmed FROM s LEFT JOIN t ON s.doc_id = t.doc_id""")
def quality_trim(spark, d):
    """Over the whole cleaned text."""
    s = P.read(spark, d, "documents").select("doc_id", F.regexp_replace("text", "[^ -~]", "").alias("seq"))
    return R.trim_quality_strings(s, "seq", "seq", lambda q: q % 42, 5, 14, 25).select("doc_id", "trimmed")


@query("""WITH m AS (SELECT DISTINCT l_orderkey AS read_id, CAST(l_partkey % 500 AS INT) AS a FROM lineitem), p AS (SELECT *, a - max(a + 1) OVER (PARTITION BY read_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM m),
g AS (SELECT *, sum(CASE WHEN gap <= 30 THEN 0 ELSE 1 END) OVER (PARTITION BY read_id ORDER BY a) AS grp FROM p) SELECT read_id, min(a) AS "left", max(a) + 2 AS "right", count(*) AS n FROM g GROUP BY read_id, grp""")
def collapse_mutations(spark, d):
    return R.collapse_nearby(P.mutations(spark, d), ["read_id"], "left", "right", 30)


@query(f"""WITH {VARIANTS}, c AS (SELECT rna, "left", "right", seq, count(*) AS n FROM vars GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY rna, "left" ORDER BY n DESC, "right", seq) AS k FROM c), b AS (SELECT * FROM o WHERE k = 1),
t AS (SELECT *, CASE WHEN lag("right") OVER (PARTITION BY rna ORDER BY "left", "right", seq) - 1 = "left" THEN 0 ELSE 1 END AS nw FROM b),
g AS (SELECT *, sum(nw) OVER (PARTITION BY rna ORDER BY "left", "right", seq ROWS UNBOUNDED PRECEDING) AS grp FROM t)
SELECT rna, arg_min("left", "left") AS "left", arg_max("right", "left") AS "right", string_agg(seq, '' ORDER BY "left") AS seq, arg_min(n, "left") AS freq FROM g GROUP BY rna, grp""")
def merge_adjacent_variants(spark, d):
    c = P.variants(spark, d).groupBy("rna", "left", "right", "seq").agg(F.count("*").alias("freq"))
    best = c.withColumn("k", F.row_number().over(Window.partitionBy("rna", "left").orderBy(F.desc("freq"), "right", "seq"))).filter("k = 1")
    return R.merge_adjacent(best, ["rna"])


@query(f'WITH {VARIANTS} SELECT rna, "left", "right", seq, count(*) AS n FROM vars GROUP BY ALL')
def variant_counts(spark, d):
    return P.variants(spark, d).groupBy("rna", "left", "right", "seq").agg(F.count("*").alias("n"))


@query(f"""WITH {VARIANTS}, c AS (SELECT rna, "left", "right", seq, count(*) AS n FROM vars GROUP BY ALL), p AS (SELECT l_linestatus AS rna, CAST(l_partkey % 100 AS INT) AS pos, count(*) AS depth FROM lineitem GROUP BY 1, 2)
SELECT c.rna, "left", "right", seq, n, least(a.depth, b.depth) AS depth, round(n / least(a.depth, b.depth), 6) AS freq, CASE WHEN n / least(a.depth, b.depth) >= 0.05 THEN 'keep' ELSE 'warn' END AS status
FROM c JOIN p a ON c.rna = a.rna AND a.pos = "left" JOIN p b ON c.rna = b.rna AND b.pos = "right" WHERE "right" - "left" - 1 <= 1000 AND length(seq) <= 1000 AND least(a.depth, b.depth) >= 20 AND n / least(a.depth, b.depth) >= 0.02""")
def variant_filter(spark, d):
    c = P.variants(spark, d).groupBy("rna", "left", "right", "seq").agg(F.count("*").alias("n"))
    p = P.calls(spark, d).groupBy("rna", "pos").agg(F.count("*").alias("depth"))
    c = c.join(p.select("rna", F.col("pos").alias("left"), F.col("depth").alias("dl")), ["rna", "left"]).join(p.select("rna", F.col("pos").alias("right"), F.col("depth").alias("dr")), ["rna", "right"])
    c = c.withColumn("depth", F.least("dl", "dr")).withColumn("f", rate(F.col("n"), F.col("depth")))
    ok = (M.span(F.col("left"), F.col("right")) <= 1000) & (F.length("seq") <= 1000) & (F.col("depth") >= 20) & (F.col("f") >= 0.02)
    return c.filter(ok).select("rna", "left", "right", "seq", "n", "depth", r6(F.col("f"), "freq"), F.when(F.col("f") >= 0.05, "keep").otherwise("warn").alias("status"))


MATES = f"""{READS}, m AS (SELECT a.pair, a."left" AS l1, a."right" AS e1, a.reverse AS v1, a.mapq >= 5 AS ok1, b."left" AS l2, b."right" AS e2, b.reverse AS v2, b.mapq >= 5 AS ok2 FROM reads a JOIN reads b ON a.pair = b.pair AND a.read_id % 2 = 0 AND b.read_id % 2 = 1)"""


def _mates(spark, d):
    r = P.reads(spark, d)
    a = r.filter("read_id % 2 = 0").select("pair", F.col("left").alias("l1"), F.col("right").alias("e1"), F.col("reverse").alias("v1"), (F.col("mapq") >= 5).alias("ok1"))
    b = r.filter("read_id % 2 = 1").select("pair", F.col("left").alias("l2"), F.col("right").alias("e2"), F.col("reverse").alias("v2"), (F.col("mapq") >= 5).alias("ok2"))
    return a.join(b, "pair")


@query(f"WITH {MATES} SELECT pair, ok1 AND ok2 AND v1 <> v2 AND greatest(e1, e2) - least(l1, l2) <= 300 AND NOT (NOT v1 AND l2 < l1 AND e1 > e2) AND NOT (v1 AND l1 < l2 AND e2 > e1) AS concordant FROM m")
def mate_join_concordance(spark, d):
    side = lambda i: {"left": F.col(f"l{i}"), "right": F.col(f"e{i}"), "reverse": F.col(f"v{i}"), "mapped": F.col(f"ok{i}")}
    return _mates(spark, d).select("pair", R.concordant(side(1), side(2), 300).alias("concordant"))


@query(f'WITH {MATES} SELECT pair, least(l1, l2) AS "left", greatest(e1, e2) AS "right", CAST(e1 - l1 + 1 + e2 - l2 + 1 - greatest(0, least(e1, e2) - greatest(l1, l2) + 1) AS INT) AS covered FROM m')
def mate_simple_merge(spark, d):
    both = F.greatest(F.lit(0), F.least("e1", "e2") - F.greatest("l1", "l2") + 1)
    return _mates(spark, d).select("pair", F.least("l1", "l2").alias("left"), F.greatest("e1", "e2").alias("right"), (F.col("e1") - F.col("l1") + 1 + F.col("e2") - F.col("l2") + 1 - both).cast("int").alias("covered"))


@query(f"""WITH {READS}, {PRIMERS}, f AS (SELECT read_id, arg_min(idx, abs("left" - fw_left) * 100 + idx) AS fw FROM reads, primers WHERE abs("left" - fw_left) <= 10 GROUP BY 1), v AS (SELECT read_id, arg_min(idx, abs("right" - rv_right) * 100 + idx) AS rv FROM reads, primers WHERE abs("right" - rv_right) <= 10 GROUP BY 1)
SELECT r.read_id, f.fw, v.rv, f.fw IS NULL OR v.rv IS NULL OR f.fw <> v.rv AS off_target FROM reads r LEFT JOIN f ON r.read_id = f.read_id LEFT JOIN v ON r.read_id = v.read_id""")
def nearest_primer(spark, d):
    p = R.primer_array(P.PRIMERS)
    out = P.reads(spark, d).select("read_id", R.nearest_primer(F.col("left"), p, "fw_left", 10).alias("fw"), R.nearest_primer(F.col("right"), p, "rv_right", 10).alias("rv"))
    return out.withColumn("off_target", R.off_target(F.col("fw"), F.col("rv")))


@query(f'WITH {READS}, {PRIMERS} SELECT read_id, max(idx) FILTER ("left" BETWEEN fw_left AND fw_right OR "right" BETWEEN rv_left AND rv_right) AS primer FROM reads, primers GROUP BY 1')
def overlapping_primer(spark, d):
    return P.reads(spark, d).select("read_id", R.overlapping_primer(F.col("left"), F.col("right"), R.primer_array(P.PRIMERS)).alias("primer"))


@query(f"""WITH {READS}, {PRIMERS}, x AS (SELECT idx, "left", "right" FROM reads JOIN primers ON abs("left" - fw_left) <= 10), u AS (SELECT idx, unnest(range("left", "right" + 1)) AS pos FROM x), c AS (SELECT idx, pos, count(*) AS n FROM u GROUP BY 1, 2) SELECT idx AS primer, max(n) AS max_depth FROM c GROUP BY 1""")
def primer_max_depth(spark, d):
    r = P.reads(spark, d).withColumn("primer", R.nearest_primer(F.col("left"), R.primer_array(P.PRIMERS), "fw_left", 10)).filter("primer IS NOT NULL")
    return D.coverage(r, ["primer"]).groupBy("primer").agg(F.max("depth").alias("max_depth"))


@query("""WITH m AS (SELECT DISTINCT l_orderkey AS read_id, CAST(l_partkey % 500 AS INT) AS a FROM lineitem) SELECT read_id, count(*) AS n, count(*) FILTER (a >= 19 AND a + 2 <= 480) AS kept, min(a) FILTER (a >= 19 AND a + 2 <= 480) AS first FROM m GROUP BY 1""")
def primer_trim(spark, d):
    keep = (F.col("left") >= 19) & (F.col("right") <= 480)
    return P.mutations(spark, d).groupBy("read_id").agg(F.count("*").alias("n"), F.count(F.when(keep, 1)).alias("kept"), F.min(F.when(keep, F.col("left"))).alias("first"))


CIGAR = "(o_orderkey % 90 + 5) || 'M' || (o_custkey % 4 + 1) || CASE o_orderkey % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'I' ELSE 'S' END || (o_custkey % 30 + 1) || 'M'"
MD = "(o_orderkey % 40) || CASE o_custkey % 3 WHEN 0 THEN '^AC' WHEN 1 THEN 'G' ELSE 'T0C' END || (o_custkey % 20)"


@query(f"SELECT o_orderkey AS read_id, CAST(o_custkey % 500 + list_sum(list_transform(regexp_extract_all({CIGAR}, '(\\d+)[MDNP=X]', 1), lambda x: CAST(x AS INT))) - 1 AS INT) AS right_pos FROM orders")
def cigar_right_pos(spark, d):
    o = P.read(spark, d, "orders").withColumn("cigar", F.expr(CIGAR))
    return o.select(F.col("o_orderkey").alias("read_id"), S.right_target_pos((F.col("o_custkey") % 500).cast("int"), F.col("cigar")).alias("right_pos"))


@query(f"WITH p AS (SELECT o_orderkey AS read_id, list_filter(regexp_extract_all({MD}, '(\\d+|\\^[A-Z]+|[A-Z]+)', 1), lambda x: NOT regexp_matches(x, '^0+$')) AS x FROM orders) SELECT read_id, len(x) AS n_ops, array_to_string(x, ' ') AS ops, coalesce(list_sum(list_transform(x, lambda y: CASE WHEN regexp_matches(y, '^[0-9]') THEN CAST(y AS INT) ELSE length(replace(y, '^', '')) END)), 0)::BIGINT AS covered FROM p")
def md_ops(spark, d):
    o = P.read(spark, d, "orders").select(F.col("o_orderkey").alias("read_id"), S.md_ops(F.expr(MD)).alias("x"))
    text = F.transform("x", lambda y: F.when(y["op"] == "match", y["len"].cast("string")).when(y["op"] == "deletion", F.concat(F.lit("^"), y["seq"])).otherwise(y["seq"]))
    return o.select("read_id", F.size("x").cast("long").alias("n_ops"), F.array_join(text, " ").alias("ops"), F.aggregate("x", F.lit(0).cast("long"), lambda a, y: a + y["len"]).alias("covered"))


@query("WITH f AS (SELECT o_orderkey AS read_id, CAST(o_custkey % 256 AS INT) AS flag FROM orders) SELECT read_id, flag & 16 <> 0 AS reverse, CASE WHEN flag & 1 = 0 THEN 'MERGED' WHEN flag & 8 <> 0 THEN 'UNPAIRED' WHEN flag & 64 <> 0 THEN 'PAIRED_R1' ELSE 'PAIRED_R2' END AS read_type FROM f")
def flag_bits(spark, d):
    o = P.read(spark, d, "orders").select(F.col("o_orderkey").alias("read_id"), (F.col("o_custkey") % 256).cast("int").alias("flag"))
    return o.select("read_id", S.flag_bit(F.col("flag"), 4).alias("reverse"), S.read_type(F.col("flag")).alias("read_type"))


TARGET = "ATGCATGCGGCATTACGATC"
MUTS = f"""mu AS (SELECT o_orderkey AS read_id, CAST(o_custkey % 12 AS INT) AS "left", CAST(o_custkey % 12 + 1 + o_orderkey % 4 AS INT) AS "right", substr('ACGTN', 1 + CAST(o_orderkey % 3 AS INT), CAST(o_custkey % 4 AS INT)) AS seq FROM orders),
cl AS (SELECT *, "right" - "left" - 1 AS d, length(seq) AS n FROM mu),
tg AS (SELECT *, CASE WHEN d = 1 AND n = 0 THEN substr('{TARGET}', "left" + 2, 1) || '-' WHEN d = 0 AND n = 1 THEN '-' || seq WHEN d = 1 AND n = 1 THEN CASE WHEN seq = 'N' THEN 'N_match' ELSE substr('{TARGET}', "left" + 2, 1) || seq END
  WHEN d > 1 AND n = 0 THEN 'multinuc_deletion' WHEN d = 0 AND n > 1 THEN 'multinuc_insertion' WHEN d = n THEN substr('{TARGET}', "right", 1) || '_multinuc_mismatch' WHEN n < d THEN 'complex_deletion' ELSE 'complex_insertion' END AS tag FROM cl)"""


def _tagged(spark, d):
    o = P.read(spark, d, "orders").select(F.col("o_orderkey").alias("read_id"), (F.col("o_custkey") % 12).cast("int").alias("left"), (F.col("o_custkey") % 12 + 1 + F.col("o_orderkey") % 4).cast("int").alias("right"), F.expr("substring('ACGTN', CAST(1 + o_orderkey % 3 AS INT), CAST(o_custkey % 4 AS INT))").alias("seq"))
    return o.withColumn("tag", M.classify(F.col("left"), F.col("right"), F.col("seq"), F.lit(TARGET), F.lit(0)))


@query(f"WITH {MUTS} SELECT read_id, tag, (d > n AND n > 0) OR (d < n AND d > 0) AS ambiguous FROM tg")
def classify_mutation(spark, d):
    return _tagged(spark, d).select("read_id", "tag", M.is_ambiguous(F.col("left"), F.col("right"), F.col("seq")).alias("ambiguous"))


@query(f"WITH {MUTS} SELECT tag, count(*) AS n FROM tg WHERE tag IN {M.TYPES['dms']} GROUP BY 1")
def mutation_type_filter(spark, d):
    return _tagged(spark, d).filter(M.of_type(F.col("tag"), "dms")).groupBy("tag").agg(F.count("*").alias("n"))


@query(f'WITH {READS}, b AS (SELECT least(20, CAST(floor(("right" - "left" + 1) / 50.0) AS INT)) AS bin FROM reads), s AS (SELECT CAST(unnest(range(0, 21)) AS INT) AS bin) SELECT s.bin, count(b.bin) AS n, round(count(b.bin) / (SELECT count(*) FROM b), 6) AS freq FROM s LEFT JOIN b ON s.bin = b.bin GROUP BY 1')
def read_histogram(spark, d):
    return A.histogram(P.reads(spark, d), F.col("right") - F.col("left") + 1, 0, 50, 21).withColumn("freq", F.round("freq", 6))


def _scaled(sql_values: str, low: float, high: float, bins: int) -> str:
    return f"x AS ({sql_values}), c AS (SELECT sample, least({bins - 1}, CAST(floor((v - {low}::DOUBLE) * {bins} / ({high}::DOUBLE - {low}::DOUBLE)) AS INT)) AS bin, count(*) AS n FROM x WHERE v BETWEEN {low} AND {high} GROUP BY 1, 2) SELECT sample, bin, n, round(n / max(n) OVER (PARTITION BY sample), 6) AS height FROM c"


@query(f"WITH {WIDE}, " + _scaled("SELECT 'modified' AS sample, r1 AS v FROM wide UNION ALL SELECT 'untreated', r2 FROM wide UNION ALL SELECT 'denatured', r3 FROM wide", 0.2, 0.7, 30))
def rate_histogram(spark, d):
    w = P.wide(spark, d).select(F.explode(F.array(*[F.struct(F.lit(s).alias("sample"), rate(*P.pair(s)).alias("v")) for s in P.SAMPLES.values()])).alias("x")).select("x.sample", "x.v")
    return A.scaled_histogram(w, ["sample"], "v", 0.2, 0.7, 30).withColumn("height", F.round("height", 6))


@query(f"WITH {WIDE}, " + _scaled("SELECT rna AS sample, ln(nullif(r1 / nullif(r2, 0), 0)) AS v FROM wide", -1.0, 7.0, 30))
def log_ratio_histogram(spark, d):
    ratio = F.try_divide(rate(*P.pair("modified")), rate(*P.pair("untreated")))
    w = P.wide(spark, d).select(F.col("rna").alias("sample"), F.log(F.when(ratio > 0, ratio)).alias("v"))
    return A.scaled_histogram(w, ["sample"], "v", -1.0, 7.0, 30).withColumn("height", F.round("height", 6))


QC = "count(*) AS n, round(avg(CAST(d1 >= 10 AND d2 >= 10 AND d3 >= 10 AS INT)), 6) AS deep, round(avg(CAST(r1 > 0 AS INT)), 6) AS positive, round(avg(CAST(r2 > 0.48 AS INT)), 6) AS high_background, round(avg(CAST(v > 0.2 AS INT)), 6) AS reactive, round(quantile_cont(r1, 0.95), 6) AS p95_rate"


def _qc(spark, d, keys):
    w = P.profile(spark, d)
    share = lambda c, n: F.round(F.avg(c.cast("int")), 6).alias(n)
    deep = (F.col("modified_depth") >= 10) & (F.col("untreated_depth") >= 10) & (F.col("denatured_depth") >= 10)
    r1, r2 = rate(*P.pair("modified")), rate(*P.pair("untreated"))
    return w.groupBy(*keys).agg(F.count("*").alias("n"), share(deep, "deep"), share(r1 > 0, "positive"), share(r2 > 0.48, "high_background"), share(F.col("reactivity") > 0.2, "reactive"), r6(F.percentile(r1, 0.95), "p95_rate"))


@query(f"WITH {WIDE}, q AS (SELECT rna, {QC} FROM three GROUP BY 1) SELECT *, deep >= 0.8 AND positive >= 0.5 AND high_background <= 0.05 AND reactive >= 0.08 AS good FROM q")
def qc_shape(spark, d):
    good = (F.col("deep") >= 0.8) & (F.col("positive") >= 0.5) & (F.col("high_background") <= 0.05) & (F.col("reactive") >= 0.08)
    return _qc(spark, d, ["rna"]).withColumn("good", good)


@query(f"WITH {WIDE} SELECT rna, upper(nt) AS base, {QC} FROM three GROUP BY 1, 2")
def qc_dms(spark, d):
    return _qc(spark, d, ["rna", F.upper("nt").alias("base")])


@query(f"WITH {WIDE}, x AS (SELECT rna, v, pos % 3 = 0 AS p FROM three WHERE v IS NOT NULL), k AS (SELECT *, rank() OVER (PARTITION BY rna ORDER BY v) + (count(*) OVER (PARTITION BY rna, v) - 1) / 2 AS r FROM x) SELECT rna, round((sum(r) FILTER (p) - count(*) FILTER (p) * (count(*) FILTER (p) + 1) / 2) / (count(*) FILTER (p) * count(*) FILTER (NOT p)), 6) AS auc FROM k GROUP BY 1")
def auc_rank(spark, d):
    return A.auc(P.profile(spark, d).withColumn("unpaired", F.col("pos") % 3 == 0), "reactivity", "unpaired", ["rna"]).withColumn("auc", F.round("auc", 6))


@query(f"WITH {WIDE} SELECT rna, pos + 1 AS nucleotide, round(coalesce(hv, -999), 6) AS value, round(CASE WHEN hv IS NULL THEN 0 ELSE he END, 6) AS stderr FROM hq")
def export_shape(spark, d):
    return P.hq(spark, d).select("rna", (F.col("pos") + 1).alias("nucleotide"), r6(F.coalesce("hq", F.lit(-999.0)), "value"), r6(F.when(F.col("hq").isNull(), 0.0).otherwise(F.col("hq_err")), "stderr"))


@query(f"WITH {WIDE} SELECT rna, pos, round(greatest(0, least(0.85, coalesce(hv, 0))), 6) AS value, CASE WHEN hv IS NULL THEN 'none' WHEN hv < 0.4 THEN 'low' WHEN hv < 0.85 THEN 'middle' ELSE 'high' END AS colour FROM hq")
def export_clip(spark, d):
    v = F.col("hq")
    return P.hq(spark, d).select("rna", "pos", r6(F.greatest(F.lit(0.0), F.least(F.lit(0.85), F.coalesce(v, F.lit(0.0)))), "value"), F.when(v.isNull(), "none").when(v < 0.4, "low").when(v < 0.85, "middle").otherwise("high").alias("colour"))


@query("SELECT p_partkey, regexp_replace(translate(reverse(upper(p_name)), 'ACGT', 'TGCA'), '[^ACGT]', 'N', 'g') AS revcomp FROM part")
def revcomp(spark, d):
    return P.read(spark, d, "part").select("p_partkey", S.reverse_complement(F.col("p_name")).alias("revcomp"))


@query("SELECT p_partkey, CASE WHEN length(p_name) <> length(p_type) THEN 1 ELSE len(list_filter(range(1, length(p_name) + 1), lambda i: substr(p_name, CAST(i AS INT), 1) <> substr(p_type, CAST(i AS INT), 1))) END::INT AS distance FROM part")
def hamming(spark, d):
    return P.read(spark, d, "part").select("p_partkey", S.hamming(F.col("p_name"), F.col("p_type")).cast("int").alias("distance"))


@query(r"SELECT c_custkey, regexp_replace(c_name || ' ' || c_mktsegment || '#1', '[^A-Za-z0-9.\-_+:]', '_', 'g') AS name FROM customer")
def sanitize(spark, d):
    return P.read(spark, d, "customer").select("c_custkey", S.sanitize_name(F.concat("c_name", F.lit(" "), "c_mktsegment", F.lit("#1"))).alias("name"))


@query(f'WITH {READS} SELECT pair, read_id % 2 AS mate, pair * 2 + read_id % 2 AS place, "left" FROM reads')
def interleave_union(spark, d):
    r = P.reads(spark, d)
    mates = [r.filter(F.col("read_id") % 2 == i).select("pair", F.lit(i).cast("long").alias("mate"), (F.col("pair") * 2 + i).alias("place"), "left") for i in (0, 1)]
    return mates[0].unionByName(mates[1])


@query("SELECT l_orderkey AS read_id, l_linenumber, CASE WHEN count(*) OVER (PARTITION BY l_orderkey) = 2 THEN 'paired' ELSE 'single' END AS kind, l_partkey FROM lineitem")
def deinterleave(spark, d):
    n = F.count("*").over(Window.partitionBy("l_orderkey"))
    return P.read(spark, d, "lineitem").select(F.col("l_orderkey").alias("read_id"), "l_linenumber", F.when(n == 2, "paired").otherwise("single").alias("kind"), "l_partkey")


@query(f"WITH {CALLS} SELECT rna, sample, count(*) AS n FROM calls WHERE rna IN ('O') GROUP BY 1, 2")
def target_split(spark, d):
    return P.calls(spark, d).filter(F.col("rna").isin("O")).groupBy("rna", "sample").agg(F.count("*").alias("n"))


@query(f"WITH {WIDE} SELECT rna, pos, round(v * CASE upper(nt) WHEN 'A' THEN 1.2::DOUBLE WHEN 'C' THEN 0.8::DOUBLE WHEN 'G' THEN 1.1::DOUBLE ELSE 0.9::DOUBLE END, 6) AS scaled FROM three")
def scale_by_class(spark, d):
    factor = F.element_at(F.create_map(*[F.lit(x) for kv in {"A": 1.2, "C": 0.8, "G": 1.1, "U": 0.9}.items() for x in kv]), F.upper("nt"))
    return P.profile(spark, d).select("rna", "pos", r6(F.col("reactivity") * factor, "scaled"))


HEX, DNA = "0123456789abcdef", "ACGTACGTACGTACGT"


@query(f"""WITH t AS (SELECT p_partkey, translate(md5(p_name || p_partkey), '{HEX}', '{DNA}') AS s FROM part),
p AS (SELECT p_partkey, s, substr(s, 3, 8) AS fw, substr(s, 20, 9) AS rc FROM t), f AS (SELECT *, strpos(s, fw) AS a, strpos(s, rc) AS b FROM p),
g AS (SELECT *, CASE WHEN strpos(substr(s, a + 1), fw) = 0 THEN CAST(a AS INT) - 1 END AS x, CASE WHEN strpos(substr(s, b + 1), rc) = 0 THEN CAST(b AS INT) - 1 END AS y FROM f)
SELECT p_partkey AS rna, x AS fw_left, x + 7 AS fw_right, y AS rv_left, y + 8 AS rv_right FROM g""")
def primer_location(spark, d):
    seq = F.translate(F.md5(F.concat("p_name", F.col("p_partkey").cast("string"))), HEX, DNA)
    t = P.read(spark, d, "part").select(F.col("p_partkey").alias("rna"), seq.alias("seq"))
    primers = t.select("rna", F.lit(0).alias("idx"), F.substring("seq", 3, 8).alias("fw_seq"), S.reverse_complement(F.substring("seq", 20, 9)).alias("rv_seq"))
    return T.locate_primers(t, primers, strict=False).select("rna", "fw_left", "fw_right", "rv_left", "rv_right")


REPEATS = "ACGU" * 25


@query(f"""WITH v AS (SELECT l_orderkey AS rna, l_linenumber * 10 AS "left", l_linenumber * 10 + 1 + CAST(min(l_partkey) % 3 AS INT) AS "right", substr('ACGTACGT', l_linenumber, CAST(min(l_suppkey) % 4 AS INT)) AS seq FROM lineitem GROUP BY 1, l_linenumber),
w AS (SELECT *, coalesce(lag("right") OVER (PARTITION BY rna ORDER BY "left"), 0) AS done FROM v),
o AS (SELECT rna, string_agg(substr('{REPEATS}', done + 1, "left" + 1 - done) || seq, '' ORDER BY "left") || substr('{REPEATS}', max("right") + 1) AS seq, CAST(count(*) AS INT) AS n FROM w GROUP BY 1)
SELECT o_orderkey AS rna, translate(coalesce(seq, '{REPEATS}'), 'U', 'T') AS seq, coalesce(n, 0) AS n_corrections FROM orders LEFT JOIN o ON o_orderkey = rna""")
def correct_sequences(spark, d):
    li = P.read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("rna"), "l_linenumber").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    left = F.col("l_linenumber") * 10
    v = li.select("rna", left.alias("left"), (left + 1 + F.col("p") % 3).cast("int").alias("right"), F.expr("substring('ACGTACGT', l_linenumber, CAST(s % 4 AS INT))").alias("seq"))
    return T.correct_sequence(P.read(spark, d, "orders").select(F.col("o_orderkey").alias("rna"), F.lit(REPEATS).alias("seq")), v)


@query(f"""WITH r AS (SELECT o_orderkey AS read_id, CAST(o_custkey % 20 AS INT) AS a, md5(CAST(o_orderkey AS VARCHAR)) AS q, CAST(o_custkey % 45 AS INT) AS b, md5(CAST(o_custkey AS VARCHAR)) AS u FROM orders),
e AS (SELECT *, unnest(range(least(a, b), greatest(a, b) + 32)) AS p FROM r),
c AS (SELECT read_id, p, CASE WHEN p >= a AND p < a + 32 THEN substr(q, CAST(p - a + 1 AS INT), 1) END AS x, CASE WHEN p >= b AND p < b + 32 THEN substr(u, CAST(p - b + 1 AS INT), 1) END AS y FROM e)
SELECT read_id, string_agg(coalesce(translate(coalesce(y, x), '{HEX}', '{DNA}'), '_'), '' ORDER BY p) AS seq, string_agg(coalesce(greatest(x, y), '~'), '' ORDER BY p) AS qual FROM c GROUP BY 1""")
def mate_base_merge(spark, d):
    q, u = F.md5(F.col("o_orderkey").cast("string")), F.md5(F.col("o_custkey").cast("string"))
    r = P.read(spark, d, "orders").select(F.col("o_orderkey").alias("read_id"), (F.col("o_custkey") % 20).cast("int").alias("a"), q.alias("q"), (F.col("o_custkey") % 45).cast("int").alias("b"), u.alias("u"))
    seq, qual = T.merge_mate_bases(F.col("a"), F.translate("q", HEX, DNA), F.col("q"), F.col("b"), F.translate("u", HEX, DNA), F.col("u"))
    return r.select("read_id", seq.alias("seq"), qual.alias("qual"))


from riboscan.plans import chains, reports  # noqa: E402, F401  (they add their queries)
