"""Near duplicates by MinHash: banding, signature verification, exact verification, components.

1. One pass over the texts gives each document the fingerprint of its whole
   shingle set, a signature of ``bands * rows`` universal-hash minima, and one
   key per band.
2. Documents with equal sets form a class; only its smallest doc_id goes on, so
   a group of exact copies costs one row.
3. In each bucket (documents with the same band key) one member is the hub;
   every other member is a candidate with the hub only, so a hot bucket adds a
   row per member and not one per pair.
4. Candidates are verified by signature agreement, then by their full sets.
5. Components by alternating large-star and small-star. Buckets that still hold
   several components are verified in full between components, so no link that a
   bucket found is lost: pair by pair in buckets of at most HOT members, and in
   blocks of documents in larger ones, where no pair becomes a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riboscan.llm.bloom import BlockedBloom
from riboscan.llm.core import Workspace, table
from riboscan.llm.textkit import Words, mix, shingles, slices, text_bytes

SIGNED = "doc_id long, n_shingles long, fp binary, sig binary, keys array<long>"
#: Members of a hub that are verified in one group.
GROUP = 256
#: Rounds in which a bucket's members are compared with one hub; after them, the pairs left between components.
STAR_ROUNDS = 1
#: Buckets left with more members are compared in blocks of BLOCK by BLOCK documents, others pair by pair.
HOT, BLOCK = 16, 256
#: Shingles of a block that are held in order at a time.
VALUES = 1 << 19
#: Keys with more than this share of all rows are listed on the driver and joined by broadcast: there are fewer than 1,024 of them.
HOT_SHARE = 1 / 1024


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return rng.integers(0, 2**31, n, dtype=np.uint32) * 2 + 1, rng.integers(0, 2**32, n, dtype=np.uint32)


def minima(sets: list[np.ndarray], n: int) -> np.ndarray:
    """``n`` minima of each nonempty set under universal hashes a * x + b mod 2**32."""
    a, b = _coefficients(n)
    x = np.concatenate(sets)
    x = (x ^ (x >> np.uint64(32))).astype(np.uint32)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out, t = np.empty((len(sets), n), np.uint32), np.empty_like(x)
    for j in range(n):
        np.multiply(x, a[j], out=t)
        np.add(t, b[j], out=t)
        out[:, j] = np.minimum.reduceat(t, at)
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    rows = sig.shape[1] // bands
    parts = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r] + np.uint64(1))
    return key.view(np.int64)


def signed(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for a, b in slices(off):
                w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
                sets = shingles(w.hashes(), w.of, k)
                full = [i for i, s in enumerate(sets) if len(s)]
                fp, sig, keys = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    least = minima([sets[i] for i in full], bands * rows)
                    low, key = (least & 255).astype(np.uint8), band_keys(least, bands)
                    for j, i in enumerate(full):
                        fp[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                        sig[i], keys[i] = low[j].tobytes(), key[j]
                yield pa.record_batch(
                    [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(fp, pa.binary()), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "fp", "sig", "keys"],
                )

    return docs.select("doc_id", "text").mapInArrow(scan, SIGNED)


def _with_key(ws: Workspace, rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """``rows`` joined with ``keys`` (one row a key, its rows counted in ``n``), so that no task gets all rows of a hot key.

    ``rows`` is a written table; ``n`` counts its rows, so hot keys are few at
    any size. They come to the driver and split both sides by a filter: each
    row passes one join, which makes a row of it at most. ``keys`` is written as ``name``.
    """
    keys = ws.keep(keys, name)
    hot = [r.key for r in keys.filter(F.col("n") > HOT_SHARE * rows.count()).select("key").collect()]
    if not hot:
        return rows.join(keys, "key")
    is_hot = F.col("key").isin(hot)
    return rows.filter(is_hot).join(F.broadcast(keys.filter(is_hot)), "key").union(rows.filter(~is_hot).join(keys.filter(~is_hot), "key"))


def _agreeing(pairs: DataFrame, sigs: DataFrame, threshold: float) -> DataFrame:
    """Signature verification: drops pairs whose minima agree too rarely for the threshold.

    The bound lies five standard errors below it, so a true link passes but
    with a chance below one in a million.
    """
    both = pairs.join(sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a").join(sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b")

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.array([np.frombuffer(s, np.uint8) for s in batch.column(c).to_pylist()]) for c in ("sig_a", "sig_b"))
            if not len(x):
                continue
            n = x.shape[1]
            least = threshold - 5 * (threshold * (1 - threshold) / n) ** 0.5
            yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(agree, "a long, b long")


def _linked(spark: SparkSession, ws: Workspace, pairs: DataFrame, docs: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union.

    Texts of documents outside every pair are dropped by a fixed-size Bloom
    filter before the shuffle. The members of a hub are dealt into groups of
    about GROUP, and the hub's text goes to each of them.
    """
    sizes = pairs.groupBy("a").agg(F.count("*").alias("n"))
    dealt = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / GROUP)).cast("int").alias("part"))
    roles = ws.keep(dealt.select(F.col("b").alias("doc_id"), "a", "part", F.lit(False).alias("hub")).union(dealt.select(F.col("a").alias("doc_id"), "a", "part", F.lit(True).alias("hub")).distinct()), f"{name}-roles")
    needed = BlockedBloom.of_ids(roles.select("doc_id"))
    texts = needed.maybe(docs.filter("doc_id is not null").select("doc_id", "text"), "doc_id")
    rows = roles.join(texts, "doc_id").select("a", "part", "hub", "doc_id", "text")

    def verify(group: pa.Table) -> pa.Table:
        data, off = text_bytes(group.column("text"))
        ids, hub = group.column("doc_id").to_numpy(), group.column("hub").to_numpy(zero_copy_only=False)
        sets: list[np.ndarray] = []
        for a, b in slices(off):
            w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
            sets += shingles(w.hashes(), w.of, k)
        found = set()
        for i in np.flatnonzero(hub):
            for j in np.flatnonzero(~hub):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    found.add((ids[i], ids[j]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    out = ws.keep(rows.groupBy("a", "part").applyInArrow(verify, "a long, b long").distinct(), name)
    ws.drop(f"{name}-roles")
    return out


def _linked_blocks(spark: SparkSession, ws: Workspace, hot: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame | None:
    """Links between components of documents that meet in hot buckets; None without such buckets.

    Documents tied by hot buckets form a tangle, which is cut into parts of
    about BLOCK: a component of BLOCK or more has parts of its own, the others
    share theirs. Each two parts of a tangle meet in one group, but for parts of
    the same component. It compares their full sets and yields links alone, and
    of these only such as join components that the group has not joined yet.
    ``least`` in ``hot`` is the smallest doc_id of the row's bucket.
    """
    ties = ws.keep(hot.select(F.col("doc_id").alias("a"), F.col("least").alias("b")).distinct(), "ties")
    if not ties.limit(1).count():
        return None
    tangles = components(spark, ws, ties, "tangles")
    members = hot.select(F.col("doc_id").alias("id"), F.col("comp").alias("own")).distinct().join(tangles.withColumnRenamed("comp", "tangle"), "id")
    members = ws.keep(members, "tangled")
    # start: the first of a component's own parts; shared parts come first and have no owner
    sizes = members.groupBy("tangle", "own").agg(F.count("*").alias("n")).withColumn("owner", F.when(F.col("n") >= BLOCK, F.col("own")))
    cut = sizes.groupBy("tangle", "owner").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("cut"))
    cut = ws.keep(cut.withColumn("start", (F.sum("cut").over(Window.partitionBy("tangle").orderBy(F.col("owner").asc_nulls_first())) - F.col("cut")).cast("int")), "cut")
    ends = cut.groupBy("tangle").agg(F.sum("cut").cast("int").alias("parts"))
    owners = cut.filter("owner is not null").select("tangle", F.col("owner").alias("own"), "cut", "start")
    shared = cut.filter("owner is null").select("tangle", F.col("cut").alias("shared"))
    members = members.join(ends, "tangle").join(shared, "tangle", "left").join(owners, ["tangle", "own"], "left")
    part = F.coalesce("start", F.lit(0)) + F.pmod(F.xxhash64("id"), F.coalesce("cut", "shared")).cast("int")
    members = ws.keep(members.select(F.col("id").alias("doc_id"), "own", "tangle", "parts", part.alias("part"), "start", "cut"), "members")
    texts = BlockedBloom.of_ids(members.select("doc_id")).maybe(docs.filter("doc_id is not null").select("doc_id", "text"), "doc_id")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.col("start").isNull() | (x < F.col("start")) | (x >= F.col("start") + F.col("cut")))
    met = members.join(texts, "doc_id").withColumn("other", F.explode(others))
    met = met.select("tangle", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "doc_id", "own", "text")

    def verify(group: pa.Table) -> pa.Table:
        ids, own, part = (group.column(c).to_numpy() for c in ("doc_id", "own", "part"))
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        data, off = text_bytes(group.column("text"))
        sets: list[np.ndarray] = []
        for a, b in slices(off):
            w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
            sets += shingles(w.hashes(), w.of, k)
        size = np.array([len(s) for s in sets])
        x, y, joined = [], [], own.copy()
        right = np.flatnonzero(part == high)
        # some documents of long texts at a time, or all of short ones: what is held doesn't grow with the texts
        for some in np.split(right, np.flatnonzero(np.diff(np.cumsum(size[right]) // VALUES)) + 1):
            values = np.concatenate([sets[j] for j in some]) if len(some) else np.zeros(0, np.uint64)
            owner = np.repeat(some, size[some])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            for i in np.flatnonzero(part == low):
                first, last = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
                n = last - first
                at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(sets))
                for j in np.flatnonzero((100 * both >= percent * (size[i] + size - both)) & (both > 0) & (joined != joined[i])):
                    if joined[j] != joined[i]:
                        x.append(ids[i])
                        y.append(ids[j])
                        joined[joined == joined[j]] = joined[i]
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})

    return ws.keep(met.groupBy("tangle", "low", "high").applyInArrow(verify, "a long, b long").distinct(), "links-hot")


def components(spark: SparkSession, ws: Workspace, links: DataFrame, name: str) -> DataFrame:
    """(id, comp): the smallest id that each end of a link reaches.

    Alternating large-star and small-star; the edge table is written after
    each round. It is done when each id has one edge to a smaller one at most
    and none of those has an edge to a smaller one itself.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    i, done = 0, False
    while not done:
        both = edges.union(edges.select(F.col("v"), F.col("u")).toDF("u", "v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_min, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        edges = ws.keep(small, f"{name}-{i}")
        roles = edges.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(edges.select("v", F.lit(0), F.lit(1)))
        done = not roles.groupBy("x").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).filter("child > 1 or child = 1 and parent = 1").limit(1).count()
        if i:
            ws.drop(f"{name}-{i - 1}")
        i += 1
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(edges.select(F.col("v"), F.col("v")).distinct())


def near_duplicates(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80, bands: int = 48, rows: int = 6) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; two documents
    are linked if 100 * intersection >= percent * union of their sets of
    k-word shingles. component_id is the smallest doc_id reachable over links.

    Texts that are null, empty or without words have an empty set and stay
    alone. A null doc_id has component_id null and is kept. Rows that repeat
    a doc_id stay separate rows with one component. Other columns of ``docs``
    aren't read.
    """
    ws = Workspace(spark, "neardup")
    # a chance of (1 - 0.8**6)**48 < 1e-6 to miss a pair at 0.8
    sigs = ws.keep(signed(docs, k, bands, rows), "sigs")
    full = sigs.filter("n_shingles > 0 and doc_id is not null")
    reps = ws.keep(full.groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    alone = full.join(reps.select(F.col("rep").alias("doc_id"), F.col("fp").alias("rep_fp")), "doc_id").filter("fp = rep_fp")
    keyed = ws.keep(alone.select("doc_id", F.explode("keys").alias("key")), "keyed")
    crowd = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    placed = ws.keep(_with_key(ws, keyed, crowd, "crowd").select("key", "doc_id", F.col("doc_id").alias("comp")), "placed-0")
    ws.drop("keyed", "crowd")
    short, tested, links, comps = full.select("doc_id", "sig"), None, None, None
    for i in range(STAR_ROUNDS + 1):
        found = None
        if i < STAR_ROUNDS:
            # one order for all buckets at first, so that a large group has few hubs; then another for each bucket
            rank = F.xxhash64("doc_id") if i == 0 else F.xxhash64("doc_id", "key", F.lit(i))
            hubs = placed.groupBy("key").agg(F.min_by(F.struct("doc_id", "comp"), rank).alias("hub"), F.count("*").alias("n"))
            pairs = _with_key(ws, placed, hubs, f"hubs-{i}").filter("comp <> hub.comp").select(F.col("hub.doc_id").alias("a"), F.col("doc_id").alias("b"))
        else:
            size = placed.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))
            sized = ws.keep(_with_key(ws, placed, size, "size"), "sized")
            hot = sized.filter(F.col("n") > HOT)
            found = _linked_blocks(spark, ws, hot, docs, k, percent)
            if found is not None:
                links = found if links is None else links.union(found)
            few = sized.filter(F.col("n") <= HOT).select("key", "doc_id", "comp")
            pairs = few.toDF("key", "a", "comp_a").join(few.toDF("key", "b", "comp_b"), "key").filter("comp_a < comp_b").select("a", "b")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = ws.keep(pairs, f"pairs-{i}")
        close = ws.keep(_agreeing(pairs, short, percent / 100), f"close-{i}")
        if close.limit(1).count():
            found = _linked(spark, ws, close, docs, k, percent, f"links-{i}")
            links = found if links is None else links.union(found)
        if links is not None and (i == STAR_ROUNDS or found is not None):
            comps = components(spark, ws, links, f"comps-{i}")
        if i == STAR_ROUNDS:
            break
        tested = pairs if tested is None else tested.union(pairs)
        now = placed.select("key", "doc_id")
        now = now.withColumn("comp", F.col("doc_id")) if comps is None else now.join(comps.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("comp", "doc_id").alias("comp"))
        now = ws.keep(now, "now")
        split = now.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count("*").alias("n")).filter("least < most")
        placed = ws.keep(_with_key(ws, now, split, f"split-{i}").select("key", "doc_id", "comp"), f"placed-{i + 1}")
        ws.drop("now", f"split-{i}", f"hubs-{i}", f"placed-{i}")
        if not placed.limit(1).count():
            break
    ws.drop("sized", "size", *[f"{n}-{i}" for n in ("pairs", "close", "placed") for i in range(STAR_ROUNDS + 1)])
    if comps is None:
        comps = spark.createDataFrame([], "id long, comp long")
    by_fp = reps.join(comps.withColumnRenamed("id", "rep"), "rep", "left").select("fp", F.coalesce("comp", "rep").alias("comp"))
    out = sigs.select("doc_id", "n_shingles", "fp").join(by_fp, "fp", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("comp", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.cast("long").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that aren't the first of their component, all columns as they are.

    Only rows that a fixed-size Bloom filter of the ids to drop may hold go
    through the exact anti-join; the others' texts aren't shuffled. Rows with a
    null doc_id and rows that repeat a kept doc_id stay.
    """
    ws = Workspace(spark, "neardup-drop")
    out = near_duplicates(spark, docs, k, percent)
    gone = ws.keep(out.filter(~F.col("kept")).select("doc_id").distinct(), "gone")
    bloom = BlockedBloom.of_ids(gone)
    return bloom.maybe(docs, "doc_id", hit=False).union(bloom.maybe(docs, "doc_id").join(gone, "doc_id", "left_anti").select(docs.columns))


def op6_minhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"), k=2, percent=80)


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 2 THEN [ws[1]]
        ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh FROM w),
f AS (SELECT doc_id, len(sh) AS n, list_sort(sh) AS sh FROM s),
r AS (SELECT min(doc_id) AS rep, n, sh FROM f WHERE n > 0 GROUP BY n, sh),
p AS (SELECT rep, n, unnest(sh) AS g FROM r),
c AS (SELECT a.rep AS x, b.rep AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS i
      FROM p a JOIN p b ON a.g = b.g AND a.rep < b.rep AND b.n * 5 >= a.n * 4 AND a.n * 5 >= b.n * 4 GROUP BY 1, 2),
e AS (SELECT x, y FROM c WHERE 100 * i >= 80 * (nx + ny - i)),
t AS (SELECT x AS u, y AS v FROM e UNION SELECT y, x FROM e),
reach(u, v) AS (SELECT rep, rep FROM r UNION SELECT reach.u, t.v FROM reach JOIN t ON reach.v = t.u),
m AS (SELECT u, min(v) AS comp FROM reach GROUP BY u)
SELECT f.doc_id, CAST(f.n AS BIGINT) AS n_shingles, coalesce(m.comp, f.doc_id) AS component_id,
       coalesce(m.comp, f.doc_id) = f.doc_id AS kept
FROM f LEFT JOIN r ON f.n = r.n AND f.sh = r.sh LEFT JOIN m ON r.rep = m.u
"""
