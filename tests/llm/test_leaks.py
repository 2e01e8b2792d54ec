import math
import random
import re

import numpy as np
import pytest

from riboscan.llm import decontaminate
from riboscan.llm.decontaminate import Runs, drop_leaks, find_leaks
from riboscan.llm.textkit import hash_word


def zipf(seed):
    """A maker of prose of Zipf-distributed words."""
    gen = np.random.default_rng(seed)
    names = np.array(["".join(x) for x in gen.choice(list("abdegiklmnoprstu"), (30000, 7))])
    p = 1 / np.arange(1, 30001)
    return lambda n: gen.choice(names, n, p=p / p.sum()).tolist()


def found(spark, items, texts):
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(spark, docs, bench).collect()}
    assert {r.doc_id for r in drop_leaks(spark, docs, bench).collect()} == set(range(len(texts))) - {d for d, _ in got}
    return got


def test_copies_of_long_items(spark):
    rng, prose = random.Random(3), zipf(3)
    items = [prose(n) for n in (20, 60, 120, 250, 300, 400, 600, 1000)] + [prose(rng.randint(15, 60)) for _ in range(150)]
    texts, want = [], set()
    for i in range(320):
        w = prose(rng.randint(50, 500))
        if i < 64:
            part = [x.upper() for x in items[i % 8]]
            if i % 16 >= 8:  # every eighth word is another
                part = [f"z{i}q{j}" if j % 8 == 3 else x for j, x in enumerate(part)]
            at = rng.randrange(len(w))
            w[at:at] = part
            want.add((i, i % 8))
        texts.append(" ".join(w))
    assert found(spark, [" ".join(x[:-8]) + ". " + " ".join(x[-8:]) + "." for x in items], texts) == want


def test_short_items_of_common_words(spark):
    prose = zipf(7)
    common = "the of and to in is it was for on are as with his they at be this from".split()
    items = [["what", "so", "what"], common[:5], common[5:15], common[15:], ["rare", "word"], ["never"]]
    rng, texts, want = random.Random(7), [], set()
    for i in range(60):
        w = [x for y in prose(rng.randint(30, 200)) for x in (y, rng.choice(common))]
        if i < 30 and i % 6 < 5:
            at = rng.randrange(len(w))
            w[at:at] = [x.upper() for x in items[i % 6]]
            want.add((i, i % 6))
        texts.append(" ".join(w))
    texts += [" ".join(items[0]), "what so", "so what what", " ".join(["x", *items[4]])]
    want |= {(60, 0), (63, 4)}
    assert found(spark, [" ".join(x) for x in items], texts) == want


def test_runs_end_with_their_document():
    runs = Runs([(0, 0, np.array([1, 2, 3])), (1, 4, np.array([2])), (2, 0, np.array([], int))])
    ids, of = np.array([1, 2, 3, 1, 2, 3, -1, 2, 1, 2, 3]), np.array([0, 3, 5, 5, 11])
    assert sorted(runs.find(ids, of)) == [(0, 0, 0, 0, 3), (0, 1, 1, 4, 1), (1, 1, 1, 4, 1), (3, 0, 3, 0, 3), (3, 1, 2, 4, 1), (3, 1, 4, 4, 1)]
    assert list(runs.find(ids[:0], of[:1])) == [] and list(Runs([]).find(ids, of)) == []


def test_runs_of_an_item(spark):
    rng, prose = random.Random(9), zipf(9)
    items = [prose(n) for n in (59, 59, 300, 40)]
    parts = [(0, items[0][:44]), (1, items[1][20:45]), (2, items[2][100:120]), (3, items[3][3:16]), (None, items[0][:12]), (None, items[2][200:206] + ["other"] + items[2][207:213])]
    texts, want = [], set()
    for i in range(60):
        w = prose(rng.randint(40, 300))
        if i < 36:
            item, part = parts[i % 6]
            at = rng.randrange(len(w))
            w[at:at] = ["Stop.", *part, "stop"]
            if item is not None:
                want.add((i, item))
        texts.append(" ".join(w))
    assert found(spark, [" ".join(x[:-9]) + ". " + " ".join(x[-9:]) + "." for x in items], texts) == want


def paraphrased(rng, prose, part, share):
    """``part`` with a share of its words replaced by others of the same prose."""
    other = prose(len(part))
    return [y if rng.random() < share else x for x, y in zip(part, other, strict=True)]


def paraphrase_case(seed):
    rng, prose = random.Random(seed), zipf(seed)
    items = [prose(rng.randint(28, 70)) for _ in range(60)]
    texts, want = [], set()
    for i in range(360):
        w = prose(rng.randint(60, 400))
        if i < 180:
            part, at = paraphrased(rng, prose, items[i % 60], rng.uniform(0.3, 0.5)), rng.randrange(len(w))
            w[at:at] = [x.upper() for x in part]
            want.add((i, i % 60))
        texts.append(" ".join(w))
    return [" ".join(x[:-9]) + ". " + " ".join(x[-9:]) + "." for x in items], texts, want


@pytest.mark.parametrize("seed", [21, 22])
def test_paraphrases_by_the_latent_space(spark, monkeypatch, seed):
    """30 to 50 % of the words are others. Without the directions, hardly any is found."""
    items, texts, want = paraphrase_case(seed)
    got = found(spark, items, texts)
    print("recall", len(got & want) / len(want), "others", len(got - want))
    assert len(got & want) >= 0.9 * len(want) and not got - want
    found_by_svd = decontaminate.randomised_svd
    monkeypatch.setattr(decontaminate, "randomised_svd", lambda words, weight: tuple(x[..., :0] for x in found_by_svd(words, weight)))
    assert len(found(spark, items, texts) & want) < 0.2 * len(want)


def test_query_against_brute_force(spark, tmp_path):
    """Every passage against every item passage in plain Python, in the space that the module found."""
    items, texts, _ = paraphrase_case(12)
    items, texts = items[:20] + ["two words", ""], texts[:60] + ["", None]
    spark.createDataFrame([*enumerate(items)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.doc_id, r.item_id): (r.cosine, r.lcs) for r in decontaminate.op8_latent_decontamination(spark, str(tmp_path)).collect()}
    idf, weight, vectors = decontaminate.latent_space(spark, spark.read.parquet(str(tmp_path / "documents.parquet")))
    words = lambda t: re.findall(r"[a-z0-9]+", (t or "").lower())
    f = lambda w: hash_word(w) & (decontaminate.FEATURES - 1)
    split = [words(t) for t in items]
    content = {w for x in split for w in x if weight[f(w)] > 0}
    for x in split:
        own = sorted(set(x), key=lambda w: (-idf[f(w)], np.uint64(hash_word(w))))
        content |= set(own[: -(-len(own) // 2)])

    row = {x: i for i, x in enumerate(np.flatnonzero(weight))}

    def fold(part):
        return sum((vectors[row[f(w)]] for w in part if weight[f(w)] > 0), np.zeros(vectors.shape[1]))

    def longest(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    want = {}
    for d, text in enumerate(texts):
        w = words(text)
        starts = range(0, max(1, -(-len(w) // 16) * 16 - 16), 16) if w else ()
        folded = [(a, fold(w[a : a + 32])) for a in starts]
        for j, x in enumerate(split):
            best = None
            tail = words(re.split(r"(?<=[.!?])\s+", items[j].strip())[-1])
            for at in range(0, max(1, len(x) - 24), 8):
                part = x[at : at + 32]
                q, known = fold(part), {y for y in part if y in content}
                for a, v in folded:
                    size = np.linalg.norm(q) * np.linalg.norm(v)
                    if not size or q @ v / size < 0.3 * min(1, len(part) / 32) ** 0.25 or sum(y in known for y in w[a : a + 32]) < 0.25 * len(known):
                        continue
                    mine, near = [y for y in x if y in content], [y for y in w[max(0, a - len(x)) : a + 32 + len(x)] if y in content]
                    n = longest(mine, near)
                    nats = [max(0, idf[f(y)] - math.log(1 + len(x) / 16)) for y in mine if y in set(near)]
                    if n < 0.35 * len(mine) or n * np.mean(nats) + math.log(math.factorial(n)) - math.log(math.comb(len(mine), n)) < 24:
                        continue
                    answer = [y for y in tail if y in content]
                    if n < 0.6 * len(mine) and answer and longest(answer, near) < 0.2 * len(answer):
                        continue
                    best = max(best or 0, n / len(mine))
            runs = [x[i : i + 13] for i in range(max(1, len(x) - 12))] if x else []
            if best is None and any(w[i : i + len(r)] == r for r in runs for i in range(len(w))):
                best = -1
            if best is not None:
                want[d, j] = best
    assert set(got) == set(want) and len(want) > 12
    assert all(got[k][0] is None if v < 0 else abs(got[k][1] - v) < 1e-9 for k, v in want.items())
