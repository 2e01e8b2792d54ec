"""The read chain as queries: alignments made from keys, whose mutations SQL knows from the same keys.

An order is a read of 40 places of a target of repeated ACGT from ``left`` =
custkey % 10 on. By orderkey % 4 it has a mismatch, a deletion or an insertion at
place ``p``, or nothing; of every third one base ``j`` has a low quality.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riboscan.functions.reads import process_reads
from riboscan.operators import primers as Q
from riboscan.operators import reads as R
from riboscan.plans import samples as P
from riboscan.plans.correction import corrected_targets
from riboscan.plans.profiling import count_records
from riboscan.plans.queries import query

TARGET = "ACGT" * 25
AT = "10 + o_custkey % 15"
KEYS = """a AS (SELECT o_orderkey AS read_id, o_custkey, CAST(o_custkey % 10 AS INT) AS "left", o_orderkey % 4 AS kind, CAST({at} AS INT) AS pi, CASE WHEN o_orderkey % 3 = 0 AND {low} THEN CAST(o_custkey * 7 % 39 AS INT) ELSE -9 END AS j, o_custkey % 2 = 1 AS reverse FROM orders),
k AS (SELECT *, "left" + pi AS p, substr('{target}', CAST("left" + pi + 1 AS INT), 1) AS base, translate(substr('{target}', CAST("left" + pi + 1 AS INT), 1), 'ACGT', 'TGCA') AS other, substr('{target}', CAST("left" + pi + 3 AS INT), 1) AS ins FROM a)"""


def keys(at: str = AT, low: str = "true") -> str:
    return KEYS.format(at=at, low=low, target=TARGET)


def alignments(spark, d, at: str = AT, low: str = "true", category: str = "INCLUDED"):
    x = P.read(spark, d, "orders").selectExpr(
        "*", "CAST(o_custkey % 10 AS INT) AS left", "o_orderkey % 4 AS kind", f"CAST({at} AS INT) AS pi", f"CASE WHEN o_orderkey % 3 = 0 AND {low} THEN CAST(o_custkey * 7 % 39 AS INT) ELSE -9 END AS j"
    )
    x = x.selectExpr("*", f"substring('{TARGET}', left + 1, 40) AS win", f"substring('{TARGET}', left + pi + 1, 1) AS base", f"substring('{TARGET}', left + pi + 3, 1) AS ins")
    before = "substring(win, 1, pi)"
    x = x.selectExpr(
        "*", f"CASE kind WHEN 0 THEN concat({before}, translate(base, 'ACGT', 'TGCA'), substring(win, pi + 2)) WHEN 1 THEN concat({before}, substring(win, pi + 2)) WHEN 2 THEN concat({before}, base, ins, substring(win, pi + 2)) ELSE win END AS seq",
        "CASE kind WHEN 1 THEN concat(pi, 'M1D', 39 - pi, 'M') WHEN 2 THEN concat(pi + 1, 'M1I', 39 - pi, 'M') ELSE '40M' END AS cigar",
        "CASE kind WHEN 0 THEN concat(pi, base, 39 - pi) WHEN 1 THEN concat(pi, '^', base, 39 - pi) ELSE '40' END AS md",
    )
    x = x.withColumn("qual", F.expr("CASE WHEN j < 0 THEN repeat('I', length(seq)) ELSE concat(repeat('I', j), '#', repeat('I', length(seq) - 1 - j)) END"))
    none = F.lit(None).cast("string")
    return x.select(
        F.lit("MERGED").alias("read_type"), F.col("o_orderkey").cast("string").alias("read_id"), F.lit("t").alias("rna"), F.lit(category).alias("category"), (F.col("o_custkey") % 2 == 1).alias("reverse"),
        F.lit(None).cast("int").alias("primer"), F.lit(None).cast("array<int>").alias("primers"), "left", "cigar", "md", "seq", "qual",
        F.lit(None).cast("int").alias("left2"), *[none.alias(f"{c}2") for c in ("cigar", "md", "seq", "qual")], "kind",
    )


def _read_id():
    return F.col("read_id").cast("long").alias("read_id")


def _bits(c: str):
    return F.size(F.filter(c, lambda b: b)).cast("long")


@query(f"""WITH {keys()} SELECT read_id, CAST(CASE kind WHEN 2 THEN p ELSE p - 1 END AS INT) AS "left", CAST(p + 1 AS INT) AS "right", CASE kind WHEN 0 THEN other WHEN 1 THEN '' ELSE ins END AS seq, CASE kind WHEN 0 THEN base || other WHEN 1 THEN base || '-' ELSE '-' || ins END AS tag FROM k WHERE kind < 3""")
def chain_locate(spark, d):
    """Raw mutations of reads that aren't processed further."""
    x = process_reads(alignments(spark, d, category="OFF_TARGET"))
    return x.select(_read_id(), F.explode("mutations").alias("m")).select("read_id", "m.left", "m.right", "m.seq", "m.tag")


_PASS = "CASE kind WHEN 0 THEN abs(pi - j) > 1 WHEN 1 THEN j NOT IN (pi - 1, pi) END"


@query(f"""WITH {keys()}, q AS (SELECT *, {_PASS} AS pass, len(list_filter(range(j - 1, j + 2), lambda i: j >= 0 AND i BETWEEN 0 AND CASE kind WHEN 1 THEN 38 ELSE 39 END)) AS lost FROM k WHERE kind <> 2)
SELECT read_id, CASE kind WHEN 1 THEN 39 - lost + CASE WHEN pass THEN 1 ELSE 0 END ELSE 40 - lost END AS effective, CAST(coalesce(pass, false) AS INT) AS kept FROM q""")
def chain_quality_filter(spark, d):
    x = process_reads(alignments(spark, d).filter("kind <> 2"))
    return x.select(_read_id(), _bits("depth").alias("effective"), F.size("mutations").alias("kept"))


@query(f"""WITH {keys()}, q AS (SELECT *, {_PASS} AS pass FROM k WHERE kind <> 2), u AS (SELECT *, unnest(range("left", "left" + 40)) AS pos FROM q),
g AS (SELECT *, pos - "left" - CASE WHEN kind = 1 AND pos > p THEN 1 ELSE 0 END AS i FROM u), e AS (SELECT pos, CASE WHEN kind < 2 AND pos = p THEN pass ELSE j < 0 OR abs(i - j) > 1 END AS good, kind < 2 AND pos = p AND pass AS mut, kind FROM g)
SELECT CAST(pos AS INT) AS pos, count(*) FILTER (mut) AS mutations, count(*) FILTER (mut AND kind = 1) AS deletions, count(*) AS read_depth, count(*) FILTER (good) AS effective_depth FROM e GROUP BY 1""")
def chain_counts(spark, d):
    from riboscan.functions.mutations import CLASSES, DELETIONS

    x = count_records(process_reads(alignments(spark, d).filter("kind <> 2")), spark.createDataFrame([("t", TARGET)], "rna string, seq string"))
    total = lambda names: F.expr(" + ".join(f"`{c}`" for c in names))
    return x.filter("read_depth > 0").select("pos", total(CLASSES).alias("mutations"), total(DELETIONS).alias("deletions"), "read_depth", "effective_depth")


_END = "1 + o_custkey % 38"


@query(f"""WITH {keys(_END, 'false')}, q AS (SELECT *, CASE WHEN reverse THEN pi >= 6 ELSE pi + 1 <= 34 END AS kept FROM k WHERE kind IN (0, 3)) SELECT read_id, CAST(kind = 0 AND kept AS INT) AS kept, 34 + CASE WHEN kind = 0 AND kept AND pi >= 34 THEN 1 ELSE 0 END AS effective FROM q""")
def chain_random_primer(spark, d):
    """Six places left out; a mutation that stays counts its place."""
    x = process_reads(alignments(spark, d, _END, "false").filter("kind IN (0, 3)"), random_primer=5)
    return x.select(_read_id(), F.size("mutations").alias("kept"), _bits("depth").alias("effective"))


@query(f"""WITH {keys(_END, 'false')} SELECT read_id, CAST(kind = 0 AND p - 1 > 14 AND p + 1 < 35 AS INT) AS kept, 20 AS effective FROM k WHERE kind IN (0, 3)""")
def chain_amplicon_primers(spark, d):
    x = alignments(spark, d, _END, "false").filter("kind IN (0, 3)").withColumn("primers", F.array(F.lit(0), F.lit(14), F.lit(35), F.lit(49)))
    return process_reads(x).select(_read_id(), F.size("mutations").alias("kept"), _bits("depth").alias("effective"))


@query("""WITH a AS (SELECT o_orderkey AS read_id, CAST(o_custkey % 6 AS INT) AS "left", o_custkey % 4 AS shift FROM orders) SELECT read_id, 9 AS raw_left, 14 AS raw_right, 'TTT' AS raw_seq, CASE WHEN shift <> 1 THEN 9 END AS placed, CASE WHEN shift <> 2 THEN 12 END AS placed_right FROM a""")
def chain_ambiguous_deletion(spark, d):
    """One T of four is missing, wherever the aligner put the gap: the raw mutation spans all places, the placed one is the first or the last.

    The aligner's gap has no quality, so it fails the filter where it comes to lie beside the placed one.
    """
    target = "GACGACGACGTTTTGACGACGACGACG"
    x = P.read(spark, d, "orders").selectExpr("CAST(o_orderkey AS STRING) AS read_id", "CAST(o_custkey % 6 AS INT) AS left", "o_custkey % 4 AS shift")
    x = x.selectExpr("*", f"concat(substring('{target}', left + 1, 10 - left), 'TTT', substring('{target}', 15)) AS seq", "concat(10 + shift - left, 'M1D', 16 - shift, 'M') AS cigar", "concat(10 + shift - left, '^T', 16 - shift) AS md")
    x = x.select("*", F.expr("repeat('I', length(seq))").alias("qual"), F.lit("MERGED").alias("read_type"), F.lit("t").alias("rna"), F.lit(False).alias("reverse"), F.lit(None).cast("int").alias("primer"), F.lit(None).cast("array<int>").alias("primers"), F.lit(None).cast("int").alias("left2"), *[F.lit(None).cast("string").alias(f"{c}2") for c in ("cigar", "md", "seq", "qual")])
    first = lambda records, *names: records.select("read_id", *[F.get("mutations", F.lit(0))[a].alias(b) for a, b in names])
    raw = first(process_reads(x.withColumn("category", F.lit("OFF_TARGET"))), ("left", "raw_left"), ("right", "raw_right"), ("seq", "raw_seq"))
    left = first(process_reads(x.withColumn("category", F.lit("INCLUDED"))), ("left", "placed"))
    right = first(process_reads(x.withColumn("category", F.lit("INCLUDED")), right_gaps=True), ("left", "placed_right"))
    return raw.join(left, "read_id").join(right, "read_id").withColumn("read_id", F.col("read_id").cast("long"))


_GAP = 'g AS (SELECT o_orderkey AS read_id, CAST(o_custkey % 10 AS INT) AS "left", CAST(o_custkey % 12 AS INT) AS gap FROM orders), h AS (SELECT *, "left" + 5 AS p, "left" + 6 + gap AS q FROM g)'
_BASE = lambda at: f"substr('{TARGET}', CAST({at} + 1 AS INT), 1)"


@query(f"""WITH {_GAP} SELECT read_id, CASE WHEN gap <= 6 THEN 1 ELSE 2 END AS n, translate({_BASE('p')}, 'ACGT', 'TGCA') || CASE WHEN gap <= 6 THEN substr('{TARGET}', CAST(p + 2 AS INT), gap) || translate({_BASE('q')}, 'ACGT', 'TGCA') ELSE '' END AS seq,
CASE WHEN gap <= 6 THEN {_BASE('q')} || '_multinuc_mismatch' ELSE {_BASE('p')} || translate({_BASE('p')}, 'ACGT', 'TGCA') END AS tag FROM h""")
def chain_join_nearby(spark, d):
    """Two mismatches with up to 11 unchanged places between them; up to 6 become one."""
    x = P.read(spark, d, "orders").selectExpr("CAST(o_orderkey AS STRING) AS read_id", "CAST(o_custkey % 10 AS INT) AS left", "CAST(o_custkey % 12 AS INT) AS gap")
    x = x.selectExpr("*", f"substring('{TARGET}', left + 1, 40) AS win", "5 AS i", "6 + gap AS k")
    other = lambda at: f"translate(substring(win, {at} + 1, 1), 'ACGT', 'TGCA')"
    x = x.selectExpr("*", f"concat(substring(win, 1, i), {other('i')}, substring(win, i + 2, gap), {other('k')}, substring(win, k + 2)) AS seq", "concat(i, substring(win, i + 1, 1), gap, substring(win, k + 1, 1), 39 - k) AS md", "'40M' AS cigar", "repeat('I', 40) AS qual")
    x = x.select("*", F.lit("MERGED").alias("read_type"), F.lit("t").alias("rna"), F.lit("INCLUDED").alias("category"), F.lit(False).alias("reverse"), F.lit(None).cast("int").alias("primer"), F.lit(None).cast("array<int>").alias("primers"), F.lit(None).cast("int").alias("left2"), *[F.lit(None).cast("string").alias(f"{c}2") for c in ("cigar", "md", "seq", "qual")])
    m = F.col("mutations")
    return process_reads(x).select(_read_id(), F.size(m).alias("n"), m[0]["seq"].alias("seq"), m[0]["tag"].alias("tag"))


@query("""WITH m AS (SELECT o_orderkey AS read_id, o_orderkey % 2 = 0 AS a, o_custkey % 2 = 0 AS b, o_custkey % 3 AS qa, o_orderkey % 3 AS qb, CAST(o_custkey % 10 AS INT) AS "left" FROM orders)
SELECT read_id, "left" + 59 AS "right", CASE WHEN qb > qa THEN b ELSE a END AS kept, 60 AS effective FROM m""")
def chain_resolve_mates(spark, d):
    """Mates that overlap in 20 places and may each show a mismatch there; the better one says whether it is there, the first of equals."""
    x = P.read(spark, d, "orders").selectExpr("CAST(o_orderkey AS STRING) AS read_id", "CAST(o_custkey % 10 AS INT) AS left", "o_orderkey % 2 = 0 AS a", "o_custkey % 2 = 0 AS b", "o_custkey % 3 AS qa", "o_orderkey % 3 AS qb")
    x = x.selectExpr("*", "left + 20 AS left2", f"substring('{TARGET}', left + 1, 40) AS w1", f"substring('{TARGET}', left + 21, 40) AS w2")

    def mate(w: str, at: int, changed: str, q: str, tail: str) -> list[str]:
        base = f"substring({w}, {at + 1}, 1)"
        return [
            f"CASE WHEN {changed} THEN concat(substring({w}, 1, {at}), translate({base}, 'ACGT', 'TGCA'), substring({w}, {at + 2})) ELSE {w} END AS seq{tail}",
            f"CASE WHEN {changed} THEN concat('{at}', {base}, '{39 - at}') ELSE '40' END AS md{tail}", f"'40M' AS cigar{tail}", f"repeat(substring('@EI', CAST({q} + 1 AS INT), 1), 40) AS qual{tail}",
        ]

    x = x.selectExpr("*", *mate("w1", 30, "a", "qa", ""), *mate("w2", 10, "b", "qb", "2"))
    x = x.select("*", F.lit("PAIRED").alias("read_type"), F.lit("t").alias("rna"), F.lit("INCLUDED").alias("category"), F.lit(False).alias("reverse"), F.lit(None).cast("int").alias("primer"), F.lit(None).cast("array<int>").alias("primers"))
    return process_reads(x).select(_read_id(), "right", (F.size("mutations") > 0).alias("kept"), _bits("depth").cast("int").alias("effective"))


PRIMERS = [(0, 5, 30, 41), (4, 9, 34, 45), (60, 65, 80, 90)]


@query(f"""WITH {keys(low='false')}, pr(idx, a, b) AS (VALUES {', '.join(f'({i}, {p[0]}, {p[3]})' for i, p in enumerate(PRIMERS))}), f AS (SELECT read_id, arg_min(idx, abs("left" - a) * 100 + idx) AS fw FROM k, pr WHERE abs("left" - a) <= 3 GROUP BY 1), r AS (SELECT read_id, arg_min(idx, abs("left" + 39 - b) * 100 + idx) AS rv FROM k, pr WHERE abs("left" + 39 - b) <= 3 GROUP BY 1)
SELECT k.read_id, CASE WHEN fw IS NULL OR rv IS NULL OR fw <> rv THEN 'OFF_TARGET' ELSE 'INCLUDED' END AS category, CASE WHEN fw = rv THEN fw END AS primer FROM k LEFT JOIN f ON k.read_id = f.read_id LEFT JOIN r ON k.read_id = r.read_id""")
def chain_off_target(spark, d):
    """Reads told by their primer pair before the chain, which then leaves its sites out."""
    x = Q.with_primers(alignments(spark, d, low="false"), R.primer_array(PRIMERS), offset=3)
    return process_reads(x.drop("kind")).select(_read_id(), "category", "primer")


@query(f"""WITH {keys(low='false')} SELECT read_id, CAST(kind = 0 AND base <> 'G' AS INT) AS n, 0 AS n_ga FROM k WHERE kind IN (0, 3)""")
def chain_dms_channels(spark, d):
    """Mismatches to the complement: none is G to A, and those of G don't count for dms (GC is a class of it)."""
    x = process_reads(alignments(spark, d, low="false").filter("kind IN (0, 3)"), kind="dms")
    return x.select(_read_id(), F.size(F.filter("mutations", lambda m: ~m["tag"].startswith("G"))).alias("n"), F.size("mutations_ga").alias("n_ga"))


@query(f"""SELECT 't' AS rna, substr('{TARGET}', 1, 20) || translate(substr('{TARGET}', 21, 1), 'ACGT', 'TGCA') || substr('{TARGET}', 22) AS seq, 1 AS n_corrections""")
def chain_correction(spark, d):
    """Seven of eight reads show a mismatch at place 20; the target is corrected by it."""
    at = "CASE WHEN o_orderkey % 8 = 3 THEN 12 + o_custkey % 3 ELSE 20 - o_custkey % 10 END"
    records = process_reads(_all_mismatch(spark, d, at), variant=True)
    return corrected_targets(records, spark.createDataFrame([("t", TARGET)], "rna string, seq string"))


def _all_mismatch(spark, d, at: str):
    """As ``alignments``, every read with its mismatch."""
    orders = P.read(spark, d, "orders")
    x = orders.selectExpr("o_orderkey", "o_custkey", "CAST(o_custkey % 10 AS INT) AS left", f"CAST({at} AS INT) AS pi").selectExpr("*", f"substring('{TARGET}', left + 1, 40) AS win", f"substring('{TARGET}', left + pi + 1, 1) AS base")
    x = x.selectExpr("'MERGED' AS read_type", "CAST(o_orderkey AS STRING) AS read_id", "'t' AS rna", "'INCLUDED' AS category", "false AS reverse", "left", "'40M' AS cigar", "concat(pi, base, 39 - pi) AS md", "concat(substring(win, 1, pi), translate(base, 'ACGT', 'TGCA'), substring(win, pi + 2)) AS seq", "repeat('I', 40) AS qual")
    return x.select("*", F.lit(None).cast("int").alias("primer"), F.lit(None).cast("array<int>").alias("primers"), F.lit(None).cast("int").alias("left2"), *[F.lit(None).cast("string").alias(f"{c}2") for c in ("cigar", "md", "seq", "qual")])
