"""``python -m riboscan``: a normalised profile from alignments and targets."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from riboscan.plans.profiling import SAMPLES, from_sam
from riboscan.sources.text import read_fasta


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="riboscan", description=__doc__)
    p.add_argument("--target", required=True, help="FASTA")
    p.add_argument("--out", required=True, help="folder for the profile, as Parquet")
    for s in SAMPLES:
        p.add_argument(f"--{s}", required=s == "modified", help="SAM")
    p.add_argument("--min-mapq", type=int, default=10)
    p.add_argument("--min-depth", type=int, default=5000)
    p.add_argument("--max-bg", type=float, default=0.05)
    p.add_argument("--min-qual", type=int, default=30)
    p.add_argument("--random-primer-len", type=int, default=0)
    p.add_argument("--indiv-norm", action="store_true")
    p.add_argument("--right-align-ambig", action="store_true")
    x = p.parse_args(args)
    if x.denatured and not x.untreated:
        p.error("--denatured needs --untreated")
    spark = SparkSession.builder.appName("riboscan").getOrCreate()
    targets = read_fasta(spark, x.target).withColumnRenamed("name", "rna")
    paths = {s: path for s in SAMPLES if (path := getattr(x, s))}
    out = from_sam(spark, paths, targets, x.min_mapq, x.max_bg, x.min_depth, not x.indiv_norm, least=x.min_qual, random_primer=x.random_primer_len, right_gaps=x.right_align_ambig, right_inserts=x.right_align_ambig)
    out.repartitionByRange("rna", "pos").sortWithinPartitions("rna", "pos").write.parquet(x.out)


if __name__ == "__main__":
    main()
