"""Secret scanning by one combined automaton.

All rules together form one minimal deterministic automaton; it runs over every
byte once, over thousands of pieces of text in step, and marks the pieces in
which a whole match of a rule ends (its shortest: what may follow it adds
nothing to a mark). In a marked piece, one backward pass of the automaton of all
reversed rules gives the places where a match of each rule begins; from those
alone the rule's own automaton yields the leftmost longest matches, one after
the other. So the work grows with the text's length, whatever is in it.

Texts are cut into pieces only behind bytes that no rule contains, so no match
crosses a cut. The rule of private keys matches their first line; found keys are
then extended over the body and the last line, across pieces.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riboscan.llm.automaton import Automaton
from riboscan.llm.core import table
from riboscan.llm.textkit import slices, text_bytes


class Rule(NamedTuple):
    """``before`` + ``value`` is the pattern; a match stays if its value (or, without ``before``, the match) has ``least`` bytes.

    ``shortest`` is the pattern without what a match may go on with (runs of one
    kind of byte keep a least length, or every letter would be marked).
    """

    kind: str
    before: str
    value: str
    least: int
    shortest: str
    fold: bool = False


BASE = (
    Rule("assign", "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?", "[A-Za-z0-9+/_.=-]+", 8, "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]", True),
    Rule("access", "", "AKIA[A-Z0-9]+", 16, "AKIA[A-Z0-9]{12}"),
    Rule("hex", "", "[0-9a-f]+", 32, "[0-9a-f]{32}"),
)
ADDED = (
    Rule("github", "", "gh[opsur]_[A-Za-z0-9]+", 40, "gh[opsur]_[A-Za-z0-9]"),
    Rule("gitlab", "", "glpat-[A-Za-z0-9_-]+", 26, "glpat-[A-Za-z0-9_-]"),
    Rule("slack", "", "xox[abprs]-[A-Za-z0-9-]+", 20, "xox[abprs]-[A-Za-z0-9-]"),
    Rule("gcp", "", "AIza[A-Za-z0-9_-]+", 39, "AIza[A-Za-z0-9_-]"),
    Rule("stripe", "", "(sk|rk|pk)_(live|test)_[A-Za-z0-9]+", 24, "(sk|rk|pk)_(live|test)_[A-Za-z0-9]"),
    Rule("jwt", "", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 40, "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]"),
    Rule("key", "", "-----BEGIN [A-Z0-9 ]*PRIVATE KEY( BLOCK)?-----", 27, "-----BEGIN [A-Z0-9 ]*PRIVATE KEY( BLOCK)?-----"),
)
RULES = BASE + ADDED
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_BREAK = rb"""(?:[ \t"'+,;>|#*]*(?:\r\n|\n|\r|\\r|\\n))+[ \t"'>|#*]*"""
_END_OF_LINE = rb"""(?=[ \t"'+,;]*(?:\r|\n|\\r|\\n|\Z))"""
#: What follows the first line of a key without its last: fields, then lines of base64 (with written-out line ends, too) or long base64 in the same line.
_BODY = re.compile(rb"(?:" + _BREAK + rb"[A-Za-z][A-Za-z0-9-]*:[^\r\n\\]*)*(?:" + _BREAK + rb"(?:[A-Za-z0-9+/]+={0,2}|=[A-Za-z0-9+/]{4})" + _END_OF_LINE + rb"|[ \t]*[A-Za-z0-9+/]{40,}={0,2})+(?:" + _BREAK + rb"-----END [A-Z0-9 ]*-----)?")
#: Bytes of a piece, to the next cut.
PIECE = 256


def key_end(raw: bytes, start: int, end: int) -> int:
    """Where the private key ends whose first line is ``raw[start:end]``: behind its last line, or behind its base64 where that is missing."""
    last = b"-----END " + raw[start + 11 : end]
    other = raw.find(b"-----BEGIN ", end)
    found = raw.find(last, end, other if other >= 0 else len(raw))
    if found >= 0:
        return found + len(last)
    body = _BODY.match(raw, end)
    return body.end() if body else end


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.combined = Automaton([(r.shortest, r.fold) for r in rules], search=True)
        self.begins = Automaton([(r.before + r.value, r.fold) for r in rules], search=True, reverse=True)
        self.whole = [Automaton([(r.before + r.value, r.fold)], search=False) for r in rules]
        self.before = [Automaton([(r.before, r.fold)], search=False) if r.before else None for r in rules]
        self.cut = np.ones(256, bool)
        for a in self.whole:
            self.cut[list(a.alphabet)] = False

    def pieces(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Ends of pieces: of rows, and behind the first cut byte of each PIECE bytes."""
        cuts = np.flatnonzero(self.cut[data])
        block = cuts // PIECE
        cuts = cuts[np.flatnonzero(np.diff(block, prepend=-1))] + 1
        return np.union1d(cuts, off)

    def marked(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and rule bits of the pieces in which a match ends."""
        start, size = bounds[:-1], np.diff(bounds)
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        kinds = self.combined.class_of[data].astype(np.int32)
        state, seen = np.zeros(len(start), np.int32), np.zeros(len(start), np.int64)
        step, accepts, n = self.combined.step, np.repeat(self.combined.accepts, self.combined.classes), len(start)
        longest = int(size[0]) if n else 0
        active = n - np.searchsorted(size[::-1], np.arange(longest), "right")
        for i in range(longest):
            m = int(active[i])
            if m < 8 and i >= 8 * PIECE:
                self._tails(kinds, start, size, state, seen, m, i)
                break
            now = step[state[:m] + kinds[start[:m] + i]]
            state[:m] = now
            seen[:m] |= accepts[now]
        hit = np.flatnonzero(seen)
        return start[hit], start[hit] + size[hit], seen[hit]

    def _tails(self, kinds, start, size, state, seen, m, i) -> None:
        """The rest of a few long pieces, byte by byte."""
        rows, accept, classes = self.combined.rows, self.combined.accept_list, self.combined.classes
        for p in range(m):
            s, bits = int(state[p]) // classes, int(seen[p])
            for c in kinds[start[p] + i : start[p] + size[p]].tolist():
                s = rows[s][c]
                bits |= accept[s]
            seen[p] = bits

    def spans(self, data: np.ndarray, a: int, b: int, bits: int) -> list[tuple[int, int, int]]:
        """(start, rule, end) of the matches in a piece, leftmost and not overlapping for each rule."""
        raw, out = data[a:b].tobytes(), []
        begins = self.begins.trace(raw[::-1])[::-1]  # rule bits of the places where a match begins
        for r, rule in enumerate(self.rules):
            if not bits >> r & 1:
                continue
            starts, i = np.flatnonzero(begins >> r & 1).tolist(), 0
            while i < len(starts):
                p = starts[i]
                end = self.whole[r].longest(raw, p, b - a)
                value = self.before[r].longest(raw, p, end - 1) if self.before[r] else p
                if end - value >= rule.least:
                    out.append((a + p, r, a + end))
                i = bisect_left(starts, end, i + 1)
        return out

    def whole_keys(self, raw: bytes, at: int, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans of the row that begins at ``at``, private keys with their bodies."""
        return [(a, r, at + key_end(raw, a - at, b - at) if self.rules[r].kind == "key" else b) for a, r, b in spans]

    def scan(self, data: np.ndarray, off: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """For each row with matches: (start, rule, end) in code points of the row, in order."""
        found: dict[int, list] = {}
        start, end, bits = self.marked(data, self.pieces(data, off))
        for a, b, rule_bits in zip(start.tolist(), end.tolist(), bits.tolist(), strict=True):
            if spans := self.spans(data, a, b, rule_bits):
                found.setdefault(int(np.searchsorted(off, a, "right")) - 1, []).extend(spans)
        for row, spans in found.items():
            if any(self.rules[r].kind == "key" for _, r, _ in spans):
                spans = self.whole_keys(data[off[row] : off[row + 1]].tobytes(), int(off[row]), spans)
            lead = np.concatenate([[0], np.cumsum((data[off[row] : off[row + 1]] & 0xC0) != 0x80)])
            found[row] = sorted((int(lead[a - off[row]]), r, int(lead[b - off[row]])) for a, r, b in spans)
        return found


@cache
def scanner() -> Scanner:
    return Scanner()


def _spans(columns: list[str], docs: DataFrame) -> DataFrame:
    """``columns`` of ``docs`` with ``spans``: array of (kind, start, end) in code points, in order."""
    schema = T.StructType([*docs.select(*columns).schema.fields, T.StructField("found", SPANS)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    at = columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner()
        for batch in batches:
            data, off = text_bytes(batch.column(at))
            for a, b in slices(off):
                found = s.scan(data[off[a] : off[b]], off[a : b + 1] - off[a])
                rows = [[{"kind": s.rules[r].kind, "start": x, "end": y} for x, r, y in found.get(i, ())] for i in range(b - a)]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, kind)], names=[*columns, "found"])

    return docs.select(*columns).mapInArrow(scan, schema)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and ``found``: the secrets of each whole text, by start and then rule order.

    Null and empty texts have none. Rows stay as they are, with repeated and
    null doc_ids; other columns aren't read.
    """
    return _spans(["doc_id", "text"], docs).drop("text")


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by ``[kind]``; overlapping secrets count as one, of the first's kind.

    ``n_chars``, where there is one, follows the text. Rows without secrets
    and null texts stay as they are.
    """
    columns = docs.columns
    schema = docs.schema
    at = columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner()
        for batch in batches:
            data, off = text_bytes(batch.column(at))
            for a, b in slices(off):
                part = batch.slice(a, b - a)
                if found := s.scan(data[off[a] : off[b]], off[a : b + 1] - off[a]):
                    texts = part.column(at).to_pylist()
                    for i, spans in found.items():
                        out, last, text = [], 0, texts[i]
                        for x, r, y in spans:
                            if x >= last:
                                out += [text[last:x], f"[{s.rules[r].kind}]"]
                            last = max(last, y)
                        texts[i] = "".join([*out, text[last:]])
                    arrays = list(part.columns)
                    arrays[at] = pa.array(texts, part.column(at).type)
                    if "n_chars" in columns:
                        k = columns.index("n_chars")
                        old = part.column(k).to_pylist()
                        arrays[k] = pa.array([len(texts[i]) if i in found else old[i] for i in range(b - a)], part.column(k).type)
                    part = pa.RecordBatch.from_arrays(arrays, names=columns)
                yield part

    return docs.mapInArrow(scan, schema)


def op4_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda x: x["kind"].isin([r.kind for r in BASE]))
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(r.kind) for r in BASE]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))


def base_digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
