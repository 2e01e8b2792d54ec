"""Quality rules: base counts, and the distance of a text's distributions from its corpus's languages.

DataFrame functions only. Each text gives two histograms: character classes and
common words. The references are the summed histograms of each language's
documents that pass the base rules, for every language found. A text fails if its
Jensen-Shannon distance from its language's reference is too large in either
histogram, provided it has enough words for the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riboscan.llm.core import Workspace, table

WORD = r"[^\x20\x09-\x0D]+"
#: Short frequent words of the languages; a text's other words share one more bin.
COMMON = ("the", "of", "and", "to", "in", "is", "that", "le", "la", "les", "de", "et", "en", "un", "der", "die", "und", "das", "nicht", "mit", "el", "los", "que", "y")
CLASSES = {"lower": r"[^a-z]+", "upper": r"[^A-Z]+", "digit": r"[^0-9]+", "symbol": r"[^#*$%&|<>]+", "mark": r"[^!-\"'-)+-/:;=?@\x5B-`{}~]+"}


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts and the histograms ``classes`` and ``common`` of each whole text."""
    t = F.col("t")
    df = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("t"))
    df = df.select("*", F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("w"), F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    df = df.withColumn("n", F.size("w"))
    windows = F.when(F.col("n") >= 5, F.transform(F.sequence(F.lit(1), F.greatest(F.col("n") - 4, F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, 5)))).otherwise(F.array().cast("array<long>"))
    df = df.withColumn("five", windows)
    # only texts with a repeated window get their windows sorted with their places
    again = F.size(F.array_distinct("five")) < F.size("five")
    df = df.withColumn("s", F.when(again, F.sort_array(F.transform("five", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("at", F.sort_array(F.transform(F.filter("s", lambda x, j: F.coalesce(x["h"] == F.get("s", j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get("s", j + 1)["h"], F.lit(False))), lambda x: x["i"])))
    repeat = F.aggregate("at", F.struct(F.lit(-5).alias("last"), F.lit(0).cast("long").alias("n")), lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(5), x - a["last"])).alias("n")), lambda a: a["n"])
    kept = {k: F.length(F.regexp_replace(t, p, "")) for k, p in CLASSES.items()}
    chars = F.length(t)
    variants = sorted({v for c in COMMON for v in (c, c.capitalize(), c.upper())})
    df = df.select(
        "doc_id", "lang", F.col("n").cast("long").alias("n_words"), F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        kept["symbol"].cast("long").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeat, F.lit(0)).cast("long").alias("n_repeat_words"), chars.alias("chars"), *[c.alias(f"c_{k}") for k, c in kept.items()],
        F.transform(F.filter("w", lambda x: x.isin(variants)), F.lower).alias("found"),
    )
    known = [F.col(f"c_{k}") for k in CLASSES]
    spaces = F.col("chars") - F.col("word_chars")
    other = F.col("chars") - sum(known[1:], known[0]) - spaces
    counts = [F.size(F.filter("found", _is(c))) for c in COMMON]
    classes = F.array(*[c.cast("long") for c in (*known, spaces, other)])
    common = F.array(*[c.cast("long") for c in (*counts, F.col("n_words") - F.size("found"))])
    return df.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", classes.alias("classes"), common.alias("common"))


def _is(word: str):
    return lambda x: x == word


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


#: With more languages than this the references are joined without a broadcast.
BROADCAST = 10_000


def references(rows: DataFrame) -> DataFrame:
    """lang, ``classes_share`` and ``common_share`` of each language found: the share of each bin over its documents that pass the base rules."""
    sizes = {"classes": len(CLASSES) + 2, "common": len(COMMON) + 1}
    sums = [F.sum(F.get(k, F.lit(i))).alias(f"{k}{i}") for k, n in sizes.items() for i in range(n)]
    found = rows.filter(F.col("lang").isNotNull() & ~base_failed()).groupBy("lang").agg(*sums)
    share = {k: [F.col(f"{k}{i}") for i in range(n)] for k, n in sizes.items()}
    return found.select("lang", *[F.array(*[F.try_divide(x.cast("double"), sum(v[1:], v[0]).cast("double")) for x in v]).alias(f"{k}_share") for k, v in share.items()])


def distance(counts: str, reference: str) -> Column:
    """Jensen-Shannon distance (the root of the divergence, base 2) of a histogram from shares; null for an empty one or without shares."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(F.transform(counts, lambda x: F.try_divide(x.cast("double"), total.cast("double"))), reference, lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    known = F.when((total > 0) & F.col(reference).isNotNull(), terms)
    total = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / 2
    return F.sqrt(F.when(total < 0, 0.0).otherwise(total))


def judge(spark: SparkSession, docs: DataFrame, most_classes=(0.1, 0.6), most_common=(0.22, 1.0), least_words: int = 20) -> DataFrame:
    """The base counts of each row of ``docs`` with base_failed, class_distance, common_distance and kept.

    ``kept``: the base rules hold, and neither distance from the reference of
    the text's language is over its bound, which is x + y / sqrt(n_words) for
    bounds (x, y): short texts lie further from any reference by chance.
    Distances count for texts of ``least_words`` words or more. The references
    are summed twice, the second time without the documents that the first ones
    rule out, where that leaves any.

    Null and empty texts have no words and fail the base rules; a text with a
    null lang, or one without a reference, has null distances and passes them.
    Repeated rows and null doc_ids stay; other columns aren't read.
    """
    ws = Workspace(spark, "divergence")
    rows = ws.keep(measures(docs), "measures").withColumn("base_failed", base_failed())

    def judged(known: DataFrame) -> DataFrame:
        out = rows.join(F.broadcast(known) if known.limit(BROADCAST + 1).count() <= BROADCAST else known, "lang", "left")
        out = out.withColumn("class_distance", F.round(distance("classes", "classes_share"), 6)).withColumn("common_distance", F.round(distance("common", "common_share"), 6))
        over = lambda c, bound: F.coalesce(F.col(c), F.lit(0.0)) > bound[0] + bound[1] / F.sqrt("n_words")
        far = (F.col("n_words") >= least_words) & (over("class_distance", most_classes) | over("common_distance", most_common))
        return out.withColumn("kept", ~F.col("base_failed") & ~far).drop("classes_share", "common_share")

    first = ws.keep(references(rows), "first")
    again = references(judged(first).filter("kept")).toDF("lang", "a", "b")
    # a language without a document left keeps its first reference
    second = first.join(again, "lang", "left").select("lang", F.coalesce("a", "classes_share").alias("classes_share"), F.coalesce("b", "common_share").alias("common_share"))
    return judged(ws.keep(second, "second")).drop("lang", "classes", "common")


def op5_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``judge`` of all documents."""
    return judge(spark, table(spark, sf_dir, "documents"))


_COUNTS = ", ".join(f"len(list_filter(f, lambda x: x = '{w}'))" for w in COMMON)
_VARIANTS = ", ".join(f"'{v}'" for c in COMMON for v in dict.fromkeys((c, c.capitalize(), c.upper())))
_KEPT = ", ".join(f"length(regexp_replace(t, '{p}', '', 'g')) AS c_{k}" for k, p in ((k, p.replace("'", "''")) for k, p in CLASSES.items()))


def _references(rows: str) -> str:
    share = lambda k, n: ", ".join(f"sum({k}[{i + 1}])::DOUBLE / sum(list_sum({k}))::DOUBLE" for i in range(n))
    return f"SELECT lang, [{share('classes', len(CLASSES) + 2)}] AS qa, [{share('common', len(COMMON) + 1)}] AS qb FROM {rows} WHERE lang IS NOT NULL GROUP BY lang"


def _judged(rows: str, known: str) -> str:
    part = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / ((p + q) / 2)) ELSE 0 END"
    d = lambda k, q: f"""round(sqrt(if({q} IS NULL OR list_sum({k}) = 0, NULL, greatest(0, list_sum(list_transform(list_zip(list_transform({k}, lambda c: c::DOUBLE / nullif(list_sum({k}), 0)), {q}),
      lambda z: {part('p').replace('(p + q)', '(z[1] + z[2])').replace('p ', 'z[1] ')} + {part('q').replace('(p + q)', '(z[1] + z[2])').replace('q ', 'z[2] ')})) / 2))), 6)"""  # noqa: E731
    return f"""SELECT *, NOT base_failed AND NOT (n_words >= 20 AND (coalesce(class_distance, 0) > 0.1::DOUBLE + 0.6::DOUBLE / sqrt(n_words) OR coalesce(common_distance, 0) > 0.22::DOUBLE + 1.0::DOUBLE / sqrt(n_words))) AS kept
      FROM (SELECT r.*, {d('classes', 'qa')} AS class_distance, {d('common', 'qb')} AS common_distance FROM {rows} r LEFT JOIN {known} k ON r.lang = k.lang)"""


OP5_SQL = rf"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
e AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 4, 0) + 1)) AS i, w FROM t),
v AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + 4]) AS n FROM e),
p AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM v WHERE n > 1) GROUP BY 1),
c AS (SELECT t.*, coalesce(p.n, 0) AS rep, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS li, length(t) AS chars,
  length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS wc, {_KEPT}, list_transform(list_filter(w, lambda x: x IN ({_VARIANTS})), lambda x: lower(x)) AS f FROM t LEFT JOIN p ON t.doc_id = p.doc_id),
m AS (SELECT doc_id, lang, len(w) AS n_words, wc AS word_chars, c_symbol AS n_symbols, len(li) - len(list_distinct(li)) AS n_dup_lines, rep AS n_repeat_words,
  [{", ".join(f"c_{k}" for k in CLASSES)}, chars - wc, chars - ({" + ".join(f"c_{k}" for k in CLASSES)}) - (chars - wc)] AS classes, [{_COUNTS}, len(w) - len(f)] AS common FROM c),
r AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
k1 AS ({_references("(SELECT * FROM r WHERE NOT base_failed)")}), j1 AS ({_judged("r", "k1")}),
k3 AS ({_references("(SELECT * FROM j1 WHERE kept)")}), k2 AS (SELECT k1.lang, coalesce(k3.qa, k1.qa) AS qa, coalesce(k3.qb, k1.qb) AS qb FROM k1 LEFT JOIN k3 ON k1.lang = k3.lang), j2 AS ({_judged("r", "k2")})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, common_distance, kept FROM j2
"""
