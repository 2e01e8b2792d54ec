"""Benchmark passages in documents, by latent semantic retrieval.

1. One pass turns every word of every text into one of FEATURES hashed features,
   and counts them; what finds the directions reads these numbers, not the
   texts. Features in at most MOST_SHARE of the passages carry TF-IDF weight.
2. Passages are overlapping windows of ``2 * BLOCK`` words. A distributed
   randomised SVD of all TF-IDF passages (range finder, one power iteration,
   Rayleigh-Ritz) gives the corpus's RANK leading directions and their singular
   values. Nothing of the benchmark goes into them.
3. Items are cut into passages of the same size and folded into that space, as
   the documents' passages are: coordinates over singular values. A document's
   passage is a candidate for an item's if their cosine is COSINE or more (less
   for an item shorter than a passage) and it has COVER of the item passage's
   content words.
4. A candidate is confirmed by the longest common subsequence of content words
   around it and the whole item, which must be too long to be there by chance
   (EVIDENCE); below SURE an item's answer (its last sentence) must be there as
   well.
5. RUN consecutive words of an item, or all words of a shorter item, are found
   by an exact search, whatever their features or the answer.

The directions are found once for all items. The benchmark is a stated query
set; the search over the texts takes it in blocks of at most ITEMS items and
ITEM_WORDS words, so what is broadcast is bounded. Nothing about the documents is
collected but sums over features.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riboscan.llm.core import Workspace, table
from riboscan.llm.textkit import NOT_ALNUM, Words, mix, slices, text_bytes

BLOCK = 16
#: Places between two passages of an item.
STRIDE = 8
#: A power of two; a feature's number fits 16 bits.
FEATURES = 8192
MOST_SHARE = 0.02
RANK, EXTRA = 96, 8
COSINE, COVER, SURE, LEAST, ANSWER = 0.3, 0.25, 0.6, 0.35, 0.2
#: How unlikely a common subsequence must be by chance, in nats: by the words' shares in the corpus, for any choice of the item's words, in one order.
EVIDENCE = 24.0
#: Items and words of a block of the benchmark; a single item may be longer.
ITEMS, ITEM_WORDS = 8192, 1 << 20
#: So many consecutive words of an item are a leak, whatever share of it they are.
RUN = 13
#: Words of which partial sums are made in one task, at least; passages whose vectors are handled at once.
PARTIAL, ROWS = 1 << 26, 1024
#: Bits that tell most words that an item's passage hasn't from those it has.
SEEN = 1 << 20


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, word hashes, word offsets) of slices of a text column, lower-cased."""
    for a, b in slices(text_bytes(column)[1]):
        w = Words(*text_bytes(pc.utf8_lower(column.slice(a, b - a))), NOT_ALNUM)
        yield a, b, w.hashes(), w.of


class Vocabulary:
    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.slots = np.full(1 << 18, -1, np.int32)
        slot = (self.sorted & np.uint64((1 << 18) - 1)).astype(np.int64)
        self.slots[slot] = np.arange(len(slot))
        names, n = np.unique(slot, return_counts=True)
        self.slots[names[n > 1]] = -2

    def __len__(self) -> int:
        return len(self.sorted)

    def ids(self, h: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.full(len(h), -1, np.int32)
        out = self.slots[(h & np.uint64((1 << 18) - 1)).astype(np.int64)]
        shared = np.flatnonzero(out == -2)
        out[shared] = np.minimum(np.searchsorted(self.sorted, h[shared]), len(self.sorted) - 1)
        out[self.sorted[out] != h] = -1
        return out


def lcs(masks: dict[int, int], words: list[int], n: int) -> int:
    """Length of the longest common subsequence, bit-parallel; masks: the places of each word in a sequence of n words."""
    full = (1 << n) - 1
    v = full
    for w in words:
        if m := masks.get(w, 0):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def place_masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def features_of(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(FEATURES - 1)).astype(np.int64)


def numbered(docs: DataFrame) -> DataFrame:
    """``words``: the features of each text's words, as 16-bit numbers."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, h, of in tokens(batch.column(0)):
                ids = features_of(h).astype(np.uint16)
                yield pa.record_batch([pa.array([ids[x:y].tobytes() for x, y in zip(of[:-1], of[1:], strict=True)], pa.binary())], names=["words"])

    return docs.select("text").mapInArrow(scan, "words binary")


def chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, word offsets) of slices of numbered texts."""
    raw = [np.frombuffer(x, np.uint16) for x in column.to_pylist()]
    of = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    for a, b in slices(of, 1 << 18):
        yield np.concatenate(raw[a:b]).astype(np.int64), of[a : b + 1] - of[a]


class Blocks:
    """Words of some documents in blocks of BLOCK, as rows of a table of vectors whose last row is zero.

    ``row``: of each feature. Documents are filled up to whole blocks with the zero row.
    """

    def __init__(self, ids: np.ndarray, of: np.ndarray, row: np.ndarray):
        size = np.diff(of)
        per = -(-size // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(per)])  # of each document
        self.n = int(self.first[-1])
        self.words = np.full(self.n * BLOCK, row[-1], np.intp)
        self.words[np.arange(len(ids)) + np.repeat(self.first[:-1] * BLOCK - of[:-1], size)] = row[ids]
        self.last = np.zeros(self.n, bool)  # the last block of a document
        self.last[self.first[1:][per > 0] - 1] = True
        self.single = np.zeros(self.n, bool)
        self.single[self.first[:-1][per == 1]] = True

    def sums(self, vectors: np.ndarray) -> np.ndarray:
        """For each block the sum of its words' vectors; few blocks at a time, so that they stay in the cache."""
        out, part = np.empty((self.n, vectors.shape[1]), np.float32), np.empty((ROWS, vectors.shape[1]), np.float32)
        words = self.words.reshape(-1, BLOCK)
        for a in range(0, self.n, ROWS):
            total = out[a : a + ROWS]
            np.take(vectors, words[a : a + ROWS, 0], axis=0, out=total, mode="clip")
            for k in range(1, BLOCK):
                total += np.take(vectors, words[a : a + ROWS, k], axis=0, out=part[: len(total)], mode="clip")
        return out

    def windows(self, sums: np.ndarray) -> np.ndarray:
        """For each block the passage that it begins: with the next block; zero where another passage has its words."""
        out = sums.copy()
        inner = np.flatnonzero(~self.last[:-1])
        out[inner] += sums[inner + 1]
        out[self.last & ~self.single] = 0
        return out

    def spread(self, passages: np.ndarray, total: np.ndarray) -> None:
        """Adds to the row of each word the sums of the passages that hold it."""
        back = passages.copy()
        inner = np.flatnonzero(~self.last[:-1])
        back[inner + 1] += passages[inner]
        small = self.words.astype(np.uint16)
        order = np.argsort(small, kind="stable")
        order = order[: np.searchsorted(small[order], len(total) - 1)]  # without the zero row
        word, block = self.words[order], order // BLOCK
        for a in range(0, len(word), 2 * ROWS):
            part = word[a : a + 2 * ROWS]
            start = np.flatnonzero(np.diff(part, prepend=-1))
            total[part[start]] += np.add.reduceat(back[block[a : a + 2 * ROWS]], start, axis=0)


def rows_of(weight: np.ndarray) -> np.ndarray:
    """The row of each feature in a table of those with a weight and a zero row; the last entry is that of the zero row."""
    row = np.full(len(weight) + 1, np.count_nonzero(weight))
    row[:-1][weight > 0] = np.arange(row[-1])
    return row


def frequencies(words: DataFrame) -> tuple[np.ndarray, int]:
    """How often each feature occurs, and how many passages there are; over all documents."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for ids, of in chunks(batch.column(0)):
                count += np.bincount(ids, minlength=FEATURES)
                n += int((-(-np.diff(of) // BLOCK)).sum())
        use = np.flatnonzero(count)
        yield pa.record_batch([pa.array(np.append(use, -1)), pa.array(np.append(count[use], n))], names=["word", "n"])

    rows = words.mapInArrow(scan, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r.word: r.n for r in rows}
    n = found.pop(-1, 0)
    count = np.zeros(FEATURES, np.int64)
    count[list(found)] = list(found.values())
    return count, n


def weights(count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """IDF of each feature, and the same with 0 for those in too many passages to tell any apart."""
    share = np.minimum(1, 2 * (count + 1) / (n + 1))
    return -np.log(share), np.where(share <= max(MOST_SHARE, 4 / (n + 1)), -np.log(share), 0)


def gram(words: DataFrame, weight: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A^T A right for the matrix A of TF-IDF passages, over the features with a weight; partial sums meet by feature."""
    p, used = right.shape[1], weight[weight > 0]
    if not p:
        return right
    vectors = np.vstack([right * used[:, None], np.zeros((1, p))]).astype(np.float32)
    shared = words.sparkSession.sparkContext.broadcast((rows_of(weight), vectors))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, vectors = shared.value
        total = np.zeros(vectors.shape)
        for batch in batches:
            for ids, of in chunks(batch.column(0)):
                b = Blocks(ids, of, row)
                if b.n:
                    b.spread(b.windows(b.sums(vectors)), total)
        yield _sums(np.arange(len(total) - 1), total[:-1].astype(np.float32))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for word, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[word] = total.get(word, 0) + np.frombuffer(part, np.float32).astype(float)
        if total:
            yield _sums(np.array(list(total)), np.array(list(total.values())).astype(np.float32))

    # a vector is one value, so plans and batches stay small whatever the rank
    schema = "word long, sums binary"
    sums = words.mapInArrow(scan, schema).repartition("word").mapInArrow(add, schema).toArrow()
    out = np.zeros((len(used), p))
    out[sums.column(0).to_numpy()] = np.frombuffer(b"".join(sums.column(1).to_pylist()), np.float32).reshape(-1, p)
    return out * used[:, None]


def _sums(words: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(words), pa.array([v.tobytes() for v in vectors], pa.binary())], names=["word", "sums"])


def randomised_svd(words: DataFrame, weight: np.ndarray, rank: int = RANK, extra: int = EXTRA) -> tuple[np.ndarray, np.ndarray]:
    """The leading right singular vectors (as columns, over the features with a weight) and singular values of the TF-IDF passages; only what carries any weight."""
    n = int(np.count_nonzero(weight))
    q, _ = np.linalg.qr(gram(words, weight, np.random.default_rng(3).standard_normal((n, min(rank + extra, n)))))
    z = gram(words, weight, q)
    values, turn = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
    order = np.argsort(-values)[:rank]
    order = order[values[order] > 1e-6 * max(values.max(initial=0), 1e-12)]
    return q @ turn[:, order], np.sqrt(values[order])


def latent_space(spark: SparkSession, docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(IDF and weight of each feature, the vectors of those with a weight for folding into the space of the passages of ``docs``, and a zero row)."""
    words = Workspace(spark, "latent").keep(numbered(docs), "words")
    count, n = frequencies(words)
    idf, weight = weights(count, n)
    # a task's sums are as large as the space, so there are no more tasks than it takes to use all cores or to hold PARTIAL words each
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-int(count.sum()) // PARTIAL))
    directions, values = randomised_svd(words.coalesce(parts), weight)
    folded = directions / values * weight[weight > 0][:, None]
    return idf, weight, np.vstack([folded, np.zeros((1, folded.shape[1]))]).astype(np.float32)


class Item:
    def __init__(self, item_id: int, ids: np.ndarray, answer: np.ndarray, content: np.ndarray, idf: np.ndarray):
        self.item_id, self.n_words = item_id, len(ids)
        self.words = ids[content[ids]].tolist()
        #: How little to be expected each word is where the item is looked for.
        self.nats = np.maximum(idf[self.words] - math.log(1 + len(ids) / BLOCK), 0).tolist()
        self.masks = place_masks(self.words)
        tail = answer[content[answer]].tolist()
        self.answer, self.answer_masks = len(tail), place_masks(tail)


class Runs:
    """Exact search for runs of words; ``wanted``: (item, place in the item, words) of each run, without words outside the vocabulary."""

    def __init__(self, wanted: list[tuple[int, int, np.ndarray]]):
        self.by_size: dict[int, tuple[np.ndarray, dict[bytes, list[tuple[int, int]]]]] = {}
        places: dict[int, dict[bytes, list[tuple[int, int]]]] = {}
        for j, at, words in wanted:
            if len(words):
                places.setdefault(len(words), {}).setdefault(words.astype(np.int64).tobytes(), []).append((j, at))
        for n, known in places.items():
            keys = self._hashes(np.frombuffer(b"".join(known), np.int64), np.arange(len(known)) * n, n)
            self.by_size[n] = np.unique(keys), known

    @staticmethod
    def _hashes(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """A hash of the n words from each place."""
        out = np.zeros(len(at), np.uint64)
        for k in range(n):
            out = mix(out + ids[at + k].astype(np.uint64))
        return out

    def find(self, ids: np.ndarray, of: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, item, place in the document, place in the item, words) of every run found; hashes only pick where to look."""
        if not self.by_size:
            return
        # words of the vocabulary from each place on, inside its document
        ends = np.append(ids < 0, True)
        ends[of[1:]] = True
        stop = np.flatnonzero(ends)
        inside = np.flatnonzero(ids >= 0)
        room = stop[np.searchsorted(stop, inside, "right")] - inside if len(inside) else inside
        for n, (keys, known) in self.by_size.items():
            at = inside[room >= n]
            h = self._hashes(ids, at, n)
            for p in at[keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h].tolist():
                doc = int(np.searchsorted(of, p, "right")) - 1
                for j, place in known.get(ids[p : p + n].tobytes(), ()):
                    yield doc, j, p - int(of[doc]), place, n


class Search:
    """What the search over documents needs; its size depends on a block of the benchmark and the space only."""

    def __init__(self, vocabulary: Vocabulary, items: list[tuple[int, np.ndarray, np.ndarray]], idf: np.ndarray, weight: np.ndarray, vectors: np.ndarray):
        self.vocabulary, self.vectors, self.row = vocabulary, vectors, rows_of(weight)
        feature = features_of(vocabulary.sorted)
        #: Content words carry weight or are of the rarer half of an item's words.
        self.content = weight[feature] > 0
        for _, ids, _ in items:
            own = np.unique(ids)
            self.content[own[np.argsort(-idf[feature[own]], kind="stable")][: -(-len(own) // 2)]] = True
        self.items = [Item(*i, self.content, idf[feature]) for i in items]
        self.runs = Runs([(j, at, ids[at : at + RUN]) for j, (_, ids, _) in enumerate(items) for at in range(max(1, len(ids) - RUN + 1))])
        self.owner, queries, least, keys, self.need = [], [], [], [], []
        for j, (_, ids, _) in enumerate(items):
            for at in range(0, max(1, len(ids) - 2 * BLOCK + STRIDE), STRIDE):
                part = ids[at : at + 2 * BLOCK]
                v = vectors[self.row[features_of(vocabulary.sorted[part])]].sum(0)
                known = np.unique(part[self.content[part]])
                if len(known) and (size := np.linalg.norm(v)):
                    keys.append(len(self.owner) * len(vocabulary) + known)
                    self.need.append(COVER * len(known))
                    self.owner.append(j)
                    queries.append(v / size)
                    least.append(COSINE * min(1, len(part) / (2 * BLOCK)) ** 0.25)
        self.queries = np.array(queries, np.float32).reshape(len(queries), vectors.shape[1]).T
        self.least, self.need, self.keys = np.array(least, np.float32), np.array(self.need), np.concatenate([*keys, np.zeros(0, np.int64)])
        self.maybe = np.zeros(SEEN, bool)
        self.maybe[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) & np.uint64(SEEN - 1)).astype(np.int64)

    def matches(self, h: np.ndarray, of: np.ndarray) -> dict[int, dict[int, tuple[float | None, float, int]]]:
        """For each document its confirmed items: (cosine, share of the common subsequence, first word of the passage).

        Items that only the search for runs finds have no cosine, the share of
        their words that lies in runs, and the first word of the first run.
        """
        ids = self.vocabulary.ids(h).astype(np.int64)
        found = self.latent_matches(features_of(h), ids, of)
        first: dict[tuple[int, int], int] = {}
        covered: dict[tuple[int, int], set[int]] = {}
        for doc, j, at, place, n in self.runs.find(ids, of):
            if j not in found.get(doc, ()):
                first[doc, j] = min(at, first.get((doc, j), at))
                covered.setdefault((doc, j), set()).update(range(place, place + n))
        for (doc, j), at in first.items():
            found.setdefault(doc, {})[j] = (None, len(covered[doc, j]) / self.items[j].n_words, at)
        return found

    def near(self, features: np.ndarray, of: np.ndarray) -> tuple[Blocks, np.ndarray, np.ndarray, np.ndarray]:
        """Blocks, and for each passage near an item's: its first block, the item's passage, their cosine."""
        b = Blocks(features, of, self.row)
        none = np.zeros(0, np.int64)
        if not b.n or not self.queries.size:
            return b, none, none, np.zeros(0)
        passages = b.windows(b.sums(self.vectors))
        size = np.linalg.norm(passages, axis=1)
        full = np.flatnonzero(size > 0)
        out = [(none, none, np.zeros(0, np.float32))]
        for a in range(0, len(full), ROWS):
            rows = full[a : a + ROWS]
            cosine = (passages[rows] / size[rows, None]) @ self.queries
            at, which = np.nonzero(cosine >= self.least)
            out.append((rows[at], which, cosine[at, which]))
        return b, *(np.concatenate(x) for x in zip(*out, strict=True))

    def covered(self, ids: np.ndarray, start: np.ndarray, stop: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Whether the words from ``start`` to ``stop`` have enough of the content words of the item passages ``which``."""
        place = np.flatnonzero((ids >= 0) & self.content[ids])
        word = ids[place]
        first, last = np.searchsorted(place, start), np.searchsorted(place, stop)
        n, at = np.zeros(len(which), np.int64), np.flatnonzero(last - first >= self.need[which])
        for k in range(2 * BLOCK):
            at = at[first[at] + k < last[at]]
            key = which[at] * len(self.vocabulary) + word[first[at] + k]
            hit = np.flatnonzero(self.maybe[self._slot(key)])
            hit = hit[self.keys[np.minimum(np.searchsorted(self.keys, key[hit]), len(self.keys) - 1)] == key[hit]]
            n[at[hit]] += 1
        return n >= self.need[which]

    def latent_matches(self, features: np.ndarray, ids: np.ndarray, of: np.ndarray) -> dict[int, dict[int, tuple[float | None, float, int]]]:
        """The matches of the latent search."""
        found: dict[int, dict[int, tuple[float | None, float, int]]] = {}
        b, block, which, cosine = self.near(features, of)
        if not len(block):
            return found
        doc = np.searchsorted(b.first, block, "right") - 1
        start = of[doc] + (block - b.first[doc]) * BLOCK
        keep = self.covered(ids, start, np.minimum(start + 2 * BLOCK, of[doc + 1]), which)
        seen: dict[tuple[int, int, int], float] = {}
        for d, i, x, c in zip(doc[keep].tolist(), which[keep].tolist(), (start - of[doc])[keep].tolist(), cosine[keep].tolist(), strict=True):
            key = (d, self.owner[i], x)
            seen[key] = max(c, seen.get(key, c))
        for (d, j, x), c in sorted(seen.items()):
            old = found.get(d, {}).get(j)
            if old and old[1] == 1:
                continue
            if (share := self.confirm(self.items[j], ids[of[d] : of[d + 1]], x)) and (not old or share > old[1]):
                found.setdefault(d, {})[j] = (c, share, x)
        return found

    def confirm(self, item: Item, words: np.ndarray, start: int) -> float:
        """The share of the item's content words in order around a passage; 0 if too few."""
        near = words[max(0, start - item.n_words) : start + 2 * BLOCK + item.n_words]
        near = near[near >= 0]
        near = near[self.content[near]].tolist()
        n = lcs(item.masks, near, len(item.words))
        share = n / len(item.words)
        if share < LEAST:
            return 0.0
        there = set(near)
        known = [x for w, x in zip(item.words, item.nats, strict=True) if w in there]
        evidence = n * sum(known) / len(known) + math.lgamma(n + 1) - math.log(math.comb(len(item.words), n))
        if evidence < EVIDENCE:
            return 0.0
        if share < SURE and item.answer and lcs(item.answer_masks, near, item.answer) < ANSWER * item.answer:
            return 0.0
        return share


def _read_items(rows: list) -> tuple[Vocabulary, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Vocabulary and (id, words, words of the last sentence) of benchmark rows."""
    texts, tails = [r.text or "" for r in rows], [re.split(r"(?<=[.!?])\s+", (r.text or "").strip())[-1] for r in rows]
    hashed = [[h[x:y] for _, _, h, of in tokens(pa.array(c, pa.string())) for x, y in zip(of[:-1], of[1:], strict=True)] for c in (texts, tails)]
    vocabulary = Vocabulary(np.concatenate([*hashed[0], np.zeros(0, np.uint64)]))
    return vocabulary, [(r.item_id, vocabulary.ids(x).astype(np.int64), vocabulary.ids(y).astype(np.int64)) for r, x, y in zip(rows, *hashed, strict=True)]


def _blocks(benchmark: DataFrame) -> Iterator[list]:
    """Rows of the benchmark, so many at a time that a block is bounded."""
    block, size = [], 0
    for r in benchmark.filter("item_id is not null").select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        n = len((r.text or "").split())
        if block and (len(block) >= ITEMS or size + n > ITEM_WORDS):
            yield block
            block, size = [], 0
        block.append(r)
        size += n
    if block:
        yield block


def searches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> Iterator[Search]:
    """For each block of the benchmark its Search; the space is found once."""
    space = None
    for rows in _blocks(benchmark):
        if space is None:
            space = latent_space(spark, docs)
        yield Search(*_read_items(rows), *space)


LEAKS = "doc_id long, item_id long, cosine double, lcs double, start_word long"


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, start_word): a row for each document and benchmark item found in it.

    Null and empty texts hold nothing, and items that are null or empty aren't
    looked for. Where only the exact search for RUN words of an item (or all, if
    it has fewer) finds it, the cosine is null. Repeated rows
    give repeated results; a null doc_id stays null. Other columns aren't read.
    """
    out = None
    for search in searches(spark, docs, benchmark):
        shared = spark.sparkContext.broadcast(search)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            s = shared.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for a, _, h, of in tokens(batch.column(1)):
                    rows = [(ids[a + d], s.items[j].item_id, *m) for d, x in sorted(s.matches(h, of).items()) for j, m in sorted(x.items())]
                    if rows:
                        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "cosine", "lcs", "start_word"])

        part = docs.select("doc_id", "text").mapInArrow(scan, LEAKS)
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], LEAKS)


def drop_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` in which no benchmark item is found, all their columns as they are."""
    out = docs
    at = docs.columns.index("text")
    for search in searches(spark, docs, benchmark):
        shared = spark.sparkContext.broadcast(search)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            s = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for a, _, h, of in tokens(batch.column(at)):
                    keep[[a + d for d in s.matches(h, of)]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(scan, docs.schema)
    return out


def op8_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``find_leaks`` of the benchmark in all documents."""
    return find_leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
