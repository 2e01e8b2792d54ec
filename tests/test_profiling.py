"""Alignments of three samples through to a normalised profile, against plain counting."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riboscan.__main__ import main
from riboscan.plans.profiling import count_records, profile, runs


def sam(rng, target, n, share):
    """SAM lines of mismatched reads, and what they count at each place."""
    lines, hits, depth = [], Counter(), Counter()
    for i in range(n):
        a = rng.randrange(0, len(target) - 30)
        seq, md, run = "", "", 0
        for p in range(a, a + 30):
            depth[p] += 1
            if rng.random() < share and (p - a) % 10 == 5:  # far enough apart to stay single
                c = rng.choice([x for x in "ACGT" if x != target[p]])
                hits[p] += 1
                seq, md, run = seq + c, md + f"{run}{target[p]}", 0
            else:
                seq, run = seq + target[p], run + 1
        lines.append(f"r{i}\t0\tt\t{a + 1}\t30\t30M\t*\t0\t0\t{seq}\t{'I' * 30}\tMD:Z:{md}{run}")
    return lines, hits, depth


def test_command_line(spark, tmp_path):
    rng = random.Random(2)
    target = "".join(rng.choices("ACGT", k=90))
    (tmp_path / "t.fa").write_text(f">t\n{target}\n")
    counted = {}
    args = ["--target", str(tmp_path / "t.fa"), "--out", str(tmp_path / "out"), "--min-depth", "1", "--max-bg", "1"]
    for s, share in (("modified", 0.6), ("untreated", 0.1), ("denatured", 0.8)):
        lines, *counted[s] = sam(rng, target, 300, share)
        (tmp_path / f"{s}.sam").write_text("\n".join(lines) + "\n")
        args += [f"--{s}", str(tmp_path / f"{s}.sam")]
    main(args)
    rows = {r.pos: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert sorted(rows) == list(range(90))
    values = []
    for p, r in rows.items():
        for s, (hits, depth) in counted.items():
            assert (r[f"{s}_mutations"], r[f"{s}_depth"]) == (hits[p], depth[p])
        rates = [h[p] / d[p] if d[p] else None for h, d in counted.values()]
        want = (rates[0] - rates[1]) / rates[2] if None not in rates and rates[2] else None
        assert r.reactivity == (pytest.approx(want) if want is not None else None)
        values += [want] if want is not None else []
    x = sorted(values)
    at = lambda q: x[int(k := q * (len(x) - 1))] + (k - int(k)) * (x[min(int(k) + 1, len(x) - 1)] - x[int(k)])
    most = max(1.5 * abs(at(0.75) - at(0.25)), x[len(x) - 1 - len(x) // 20])
    low = [v for v in x if v < most]
    factor = sum(low[-(len(x) // 10) :]) / (len(x) // 10)
    some = next(r for r in rows.values() if r.reactivity)
    assert some.norm_profile == pytest.approx(some.reactivity / factor)


def test_runs_and_empty_records(spark):
    df = spark.createDataFrame([("t", 5, [True, True, False, True]), ("t", 0, [False]), ("t", 0, [])], "rna string, left int, d array<boolean>")
    assert sorted(map(tuple, runs(df, "d").collect())) == [("t", 5, 6), ("t", 8, 8)]
    from riboscan.functions.reads import RECORD

    none = count_records(spark.createDataFrame([], RECORD), spark.createDataFrame([("t", "ACG"), ("e", "")], "rna string, seq string"))
    assert sorted((r.rna, r.pos, r.read_depth, r["AT"]) for r in none.collect()) == [("t", i, 0, 0) for i in range(3)]
    out = profile({"modified": none}, spark.createDataFrame([("t", "AcG")], "rna string, seq string"))
    assert out.filter(F.col("norm_profile").isNotNull() | F.col("reactivity").isNotNull()).count() == 0 and out.count() == 3
    with pytest.raises(ValueError):
        profile({"untreated": none}, none)
