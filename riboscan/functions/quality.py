"""Base-quality filter over a read's mutations and effective depth; plain Python, run inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from riboscan.functions.mutations import TYPES


class Tagged(NamedTuple):
    left: int
    right: int
    seq: str
    qual: str
    tag: str


class Filtered(NamedTuple):
    depth: list[bool]
    count: list[bool]
    kept: list[Tagged]
    ga_depth: list[bool]
    ga_count: list[bool]
    ga: list[Tagged]


def quality_filter(mutations: list[Tagged], qual: str, depth: list[bool], left: int, least: int, kind: str = "", variant: bool = False) -> Filtered:
    """What stays countable of a read whose first target place is ``left``.

    A place outside mutations needs itself and both neighbours at ``least`` or
    more; a mutation needs all its bases and both neighbours. A neighbour that
    belongs to a mutation is that mutation's nearest base, or the place beyond
    it for a deletion. Neighbours outside the read pass; ``~`` (no read there)
    fails as the place itself. A mutation of another ``kind``, or one that
    fails, loses its whole span from the depth; one that passes keeps its last
    place only, or all places in ``variant`` mode. For ``dms``, G to A changes
    go to a channel of their own.
    """
    n = len(qual)
    begins, ends = {m.left: m for m in mutations}, {m.right: m for m in mutations}
    inside = lambda p: 0 <= p - left < n

    def low(c: str) -> bool:
        return c != "" and ord(c) - 33 < least

    def at(p: int) -> str:
        return qual[p - left] if inside(p) else ""

    def before(p: int, skip: Tagged | None = None) -> str:
        m = ends.get(p)
        if m is None or m is skip:
            return at(p - 1)
        return m.qual[-1:] if m.seq else at(m.left)

    def after(p: int, skip: Tagged | None = None) -> str:
        m = begins.get(p)
        if m is None or m is skip:
            return at(p + 1)
        return m.qual[:1] if m.seq else at(m.right)

    out = list(depth)

    def put(start: int, end: int, value: bool, bits: list[bool]) -> None:
        for p in range(start, end):
            if 0 <= p - left < len(bits):
                bits[p - left] = value

    changed = {p for m in mutations for p in range(m.left + 1, m.right)}
    for p in range(left, left + n):
        if p not in changed and (at(p) == "~" or low(at(p)) or low(before(p)) or low(after(p))):
            out[p - left] = False

    kept, ga = [], []
    for m in mutations:
        split = kind == "dms" and m.tag == "GA"
        good = split or not kind or m.tag in TYPES[kind]
        good = good and not any(low(c) for c in m.qual)
        good = good and not (inside(m.left + 1) and low(before(m.left + 1, m))) and not (inside(m.right - 1) and low(after(m.right - 1, m)))
        put(m.left + 1, m.right, good and variant, out)
        if good and split and not variant:
            ga.append(m)
        elif good:
            put(m.right - 1, m.right, True, out)
            kept.append(m)

    def sites(found: list[Tagged]) -> list[bool]:
        bits = [False] * n
        for m in found:
            put(m.right - 1, m.right, True, bits)
        return bits

    ga_depth = list(out) if kind == "dms" else [False] * len(out)
    if kind == "dms":
        for m in kept:
            put(m.left + 1, m.right, False, ga_depth)
        for m in ga:
            put(m.right - 1, m.right, True, ga_depth)
    return Filtered(out, sites(kept), kept, ga_depth, sites(ga), ga)


MUTATIONS = "array<struct<left:int,right:int,seq:string,qual:string,tag:string>>"


def filter_by_quality(reads: DataFrame, least: int = 30, kind: str = "", variant: bool = False) -> DataFrame:
    """Applies the filter to (read_id, rna, left, qual, depth, mutations): depth, count and mutations as filtered, and those of the G-to-A channel."""
    item = pa.list_(pa.struct([("left", pa.int32()), ("right", pa.int32()), *[(c, pa.string()) for c in ("seq", "qual", "tag")]]))
    bits = pa.list_(pa.bool_())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [quality_filter([Tagged(**m) for m in found], q, depth, left, least, kind, variant) for left, q, depth, found in zip(*[batch.column(c).to_pylist() for c in ("left", "qual", "depth", "mutations")], strict=True)]
            columns = [pa.array([[x._asdict() for x in r[i]] if i in (2, 5) else r[i] for r in rows], item if i in (2, 5) else bits) for i in range(6)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("read_id", "rna", "left")], *columns], names=["read_id", "rna", "left", "depth", "count", "mutations", "depth_ga", "count_ga", "mutations_ga"])

    schema = f"read_id string, rna string, left int, depth array<boolean>, count array<boolean>, mutations {MUTATIONS}, depth_ga array<boolean>, count_ga array<boolean>, mutations_ga {MUTATIONS}"
    return reads.select("read_id", "rna", "left", "qual", "depth", "mutations").mapInArrow(scan, schema)
