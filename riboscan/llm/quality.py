"""Quality by a sparse rule ensemble.

Statistics of each whole text come from one vectorised pass. Shallow boosted
trees are grown on labelled rows; each path from a root to a node is a
conjunctive rule. A lasso logistic regression over the rules keeps few of
them, and these are compiled into one Spark column expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riboscan.llm.bloom import BlockedBloom
from riboscan.llm.core import Workspace, free_name, table
from riboscan.llm.textkit import SPACES, Words, byte_set, hash_word, mix, slices, text_bytes

#: Frequent short words of four languages.
COMMON = tuple("the of and to in is that it for was with be as on by at from this or an he are le la les de des du et en un une est que qui dans pour pas sur der die das und ist von mit den dem ein nicht im auch el los las del y se por con una para su al".split())

FEATURES = (
    "log_words", "mean_word", "lower", "upper", "digit", "space", "punct", "symbol", "high",
    "distinct", "common", "top", "sentence_end", "single", "symbol_end", "all_upper",
    "dup_lines", "words_per_line", "repeat5", "bang",
)

_CLASS = np.full(256, 4, np.uint8)  # 0 lower 1 upper 2 digit 3 space 4 other ASCII 5 symbol 6 lead byte 7 continuation 8 bang
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[SPACES] = 0, 1, 2, 3
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 5
_CLASS[0xC0:], _CLASS[0x80:0xC0], _CLASS[ord("!")] = 6, 7, 8
_NOT_LINE = byte_set((10, 10))


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text; every value is finite, 0 for empty texts."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    kind = _CLASS[data]
    counts = np.bincount(row * 9 + kind, minlength=n * 9).reshape(n, 9).astype(float)
    chars = np.maximum(counts.sum(1) - counts[:, 7], 1)
    w = Words(data, off)
    h, words = w.hashes(), np.diff(w.of)
    at = np.repeat(np.arange(n), words)
    size = np.maximum(words, 1).astype(float)
    per = lambda mask: np.bincount(at[mask], minlength=n) / size
    order = np.lexsort((h, at))
    sh, sa = h[order], at[order]
    new = np.ones(len(h), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (sa[1:] != sa[:-1])
    run = np.diff(np.append(np.flatnonzero(new), len(h)))
    top = np.zeros(n)
    np.maximum.at(top, sa[new], run)
    last, first = data[w.end - 1] if len(h) else data[:0], kind[w.start] if len(h) else kind[:0]
    upper = np.concatenate([[0], np.cumsum((kind == 1) * 1)])
    lower = np.concatenate([[0], np.cumsum((kind == 0) * 1)])
    n_upper, n_lower = upper[w.end] - upper[w.start], lower[w.end] - lower[w.start]
    lines = Words(data, off, _NOT_LINE)
    lh, per_line = lines.hashes(np.arange(256)), np.diff(lines.of)
    la = np.repeat(np.arange(n), per_line)
    distinct_lines = np.bincount(np.unique(np.column_stack([la.astype(np.uint64), lh]), axis=0)[:, 0].astype(int), minlength=n) if len(lh) else np.zeros(n)
    # words in 5-word windows that occur before in the text
    repeat = np.zeros(n)
    if len(h) > 5:
        five = np.zeros(len(h) - 4, np.uint64)
        for j in range(5):
            five = mix(five + h[j : j + len(five)] + np.uint64(j))
        own = at[:-4] == at[4:]
        five, fa = five[own], at[:-4][own]
        o = np.lexsort((five, fa))
        again = np.zeros(len(five), bool)
        again[1:] = (five[o][1:] == five[o][:-1]) & (fa[o][1:] == fa[o][:-1])
        repeat = np.bincount(fa[o][again], minlength=n) / size
    common = np.isin(h, np.array([hash_word(x) for x in COMMON], np.uint64))
    out = np.column_stack([
        np.log1p(words), (counts[:, [0, 1, 2, 4, 5, 6, 8]].sum(1)) / size, *(counts[:, [0, 1, 2, 3, 4, 5, 6]] / chars[:, None]).T,
        np.bincount(sa[new], minlength=n) / size, per(common), top / size, per(np.isin(last, list(b".!?"))), per(w.end - w.start == 1),
        per(np.isin(last, list(b"#*$%&|<>"))), per((n_upper > 1) & (n_lower == 0)),
        1 - distinct_lines / np.maximum(per_line, 1), words / np.maximum(per_line, 1), repeat, counts[:, 8] / chars,
    ])
    out[np.diff(off) == 0] = 0
    return out


def with_statistics(docs: DataFrame, columns: list[str], name: str = "_stats", known: BlockedBloom | None = None) -> DataFrame:
    """``columns`` of ``docs`` (text among them) and ``name``, a struct of FEATURES; with ``known`` only rows whose doc_id may be in it."""
    struct = T.StructType([T.StructField(f, T.DoubleType()) for f in FEATURES])
    schema = T.StructType([*docs.select(*columns).schema.fields, T.StructField(name, struct)])
    at = columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(at))
            for a, b in slices(off):
                x = statistics(data[off[a] : off[b]], off[a : b + 1] - off[a])
                stats = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in x.T], names=list(FEATURES))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, stats], names=[*columns, name])

    docs = docs.select(*columns)
    return docs.mapInArrow(scan, schema) if known is None else known.maybe(docs, "doc_id", then=(scan, schema))


Rule = tuple[tuple[int, bool, float], ...]  # (feature, above, threshold): x > t if above, else x <= t


@dataclass
class RuleEnsemble:
    """``trees`` boosted trees of ``depth``, then lasso over their rules; ``penalty`` is per row."""

    trees: int = 40
    depth: int = 3
    bins: int = 32
    shrink: float = 0.3
    penalty: float = 0.002
    rounds: int = 250
    seed: int = 11
    bias: float = 0.0
    rules: list[tuple[float, Rule]] = field(default_factory=list)

    def _tree(self, code: np.ndarray, grad: np.ndarray, hess: np.ndarray, edges: list[np.ndarray], out: set[Rule]) -> np.ndarray:
        n, f = code.shape
        step = np.zeros(n)
        flat = code + np.arange(f) * self.bins

        def grow(rows: np.ndarray, path: Rule) -> None:
            if path:
                out.add(path)
            g, h = grad[rows], hess[rows]
            if len(path) < self.depth and len(rows) >= 40:
                at = flat[rows].ravel()
                gs, hs = (np.bincount(at, np.repeat(v, f), f * self.bins).reshape(f, self.bins).cumsum(1) for v in (g, h))
                gain = gs**2 / (hs + 1) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + 1)
                k, b = np.unravel_index(np.argmax(gain), gain.shape)
                if b < len(edges[k]) and gain[k, b] > g.sum() ** 2 / (h.sum() + 1) + 1e-3:
                    left = code[rows, k] <= b
                    if left.any() and not left.all():
                        grow(rows[left], (*path, (int(k), False, float(edges[k][b]))))
                        grow(rows[~left], (*path, (int(k), True, float(edges[k][b]))))
                        return
            step[rows] = -g.sum() / (h.sum() + 1)

        pick = self._rng.random(n) < 0.6
        grow(np.flatnonzero(pick), ())
        return step * pick

    @staticmethod
    def simple(path: Rule) -> Rule:
        """One bound at most for each feature and side."""
        best: dict[tuple[int, bool], float] = {}
        for f, above, t in path:
            old = best.get((f, above), t)
            best[f, above] = max(old, t) if above else min(old, t)
        return tuple(sorted((f, above, t) for (f, above), t in best.items()))

    @staticmethod
    def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, above, t in rule:
            out &= x[:, f] > t if above else x[:, f] <= t
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
        """Without rows the score is 0.5 everywhere; with one class it is that class's smoothed share."""
        self.rules, n = [], len(y)
        self.bias = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
        if n == 0 or y.min() == y.max():
            return self
        self._rng = np.random.default_rng(self.seed)
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        code = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
        margin, found = np.full(n, self.bias), set()
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            margin += self.shrink * self._tree(code, p - y, p * (1 - p), edges, found)
        rules = sorted({self.simple(r) for r in found})
        z = np.column_stack([self.holds(r, x) for r in rules]).astype(np.float32)
        share = z.mean(0)
        use = np.flatnonzero((share > 0.002) & (share < 0.998))
        z, rules = z[:, use], [rules[i] for i in use]
        weight, self.bias = self._lasso(z, y.astype(np.float32))
        self.rules = [(float(w), r) for w, r in zip(weight, rules, strict=True) if w]
        return self

    def _lasso(self, z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        """FISTA for logistic loss and an L1 penalty, the intercept free."""
        n, m = z.shape
        mean = z.mean(0)
        z = z - mean
        v = np.ones(m, np.float32)
        for _ in range(15):
            v = z.T @ (z @ v)
            v /= np.linalg.norm(v) + 1e-12
        rate = 1 / (0.25 * float(np.linalg.norm(z @ v)) ** 2 / n * 1.05 + 1e-6)
        w = u = np.zeros(m, np.float32)
        b, t = self.bias, 1.0
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-(z @ u + b)))
            new = u - rate * (z.T @ (p - y) / n)
            new = np.sign(new) * np.maximum(np.abs(new) - rate * self.penalty, 0)
            b -= 4.0 * float((p - y).mean())
            t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
            u, w = new + (old - 1) / t * (new - w), new
        return w, b - float(w @ mean)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + sum((w * self.holds(r, x) for w, r in self.rules), np.zeros(len(x))))))

    def column(self, stats: str = "_stats") -> Column:
        """The score as a Spark expression over the struct of statistics."""
        total = F.lit(self.bias)
        for w, rule in self.rules:
            cond = None
            for f, above, t in rule:
                c = F.col(stats)[FEATURES[f]]
                c = c > F.lit(t) if above else c <= F.lit(t)
                cond = c if cond is None else cond & c
            total = total + F.when(cond, F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text, mod 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def learn(stats: DataFrame, labels: DataFrame, max_rows: int = 20000) -> RuleEnsemble:
    """Fits on at most ``max_rows`` labelled rows that aren't held out, those of the smallest id hashes.

    stats: doc_id and ``_stats``. Null labels are skipped.
    """
    known = labels.select("doc_id", F.col("quality").alias("_y")).filter(F.col("_y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "_y").limit(max_rows)
    rows = stats.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "_y", *[F.col("_stats")[f] for f in FEATURES]).limit(max_rows).select("_y", *[F.col("_stats")[f].alias(f) for f in FEATURES]).toPandas()
    return RuleEnsemble().fit(rows[list(FEATURES)].to_numpy(float), (rows["_y"].to_numpy() >= 1).astype(float))


def score_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``.

    Scores depend on the text alone. Null texts score as empty ones; repeated
    rows and null doc_ids stay; other columns aren't read. Without labelled
    rows every score is 0.5.
    """
    ws = Workspace(spark, "quality")
    stats = ws.keep(with_statistics(docs, ["doc_id", "text"]).drop("text"), "stats")
    score = learn(stats, labels).column()
    out = stats.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose score is 0.5 or more, all their columns as they are.

    Statistics for learning are taken of the rows that a fixed-size Bloom
    filter of the labelled ids lets pass, in the pass that probes it; ``learn``
    joins them exactly.
    """
    ws = Workspace(spark, "quality")
    known = labels.filter("quality is not null").select("doc_id").distinct()
    stats = ws.keep(with_statistics(docs, ["doc_id", "text"], known=BlockedBloom.of_ids(known)).drop("text"), "stats")
    name = free_name(docs.columns, "_stats")
    score = learn(stats, labels).column(name)
    return with_statistics(docs, docs.columns, name).filter(score >= 0.5).select(docs.columns)


def op3_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
