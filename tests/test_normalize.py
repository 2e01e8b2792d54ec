import random

import pytest
from pyspark.sql import functions as F

from riboscan.operators.normalize import boxplot_factor, pooled_factor


@pytest.mark.parametrize("n", [0, 5, 19, 20, 57, 99, 100, 103, 2500])
@pytest.mark.parametrize("kind", ["spread", "ties"])
def test_pooled_equals_one_group(spark, n, kind):
    rng = random.Random(n)
    draw = {"spread": lambda: rng.choice([1, 1, 1, -1]) * 10 ** rng.uniform(-6, 3), "ties": lambda: rng.choice([0.0, -0.0, 0.5, 0.25, -1.0, 7.0])}[kind]
    rows = [(draw(),) for _ in range(n)] + [(None,)] * 3
    df = spark.createDataFrame(rows, "v double").repartition(3)
    one = [(r.n, r.factor) for r in boxplot_factor(df.withColumn("k", F.lit(1)), "v", ["k"]).collect()] or [(None, None)]
    pooled = [(r.n, r.factor) for r in pooled_factor(df, "v").collect()]
    assert pooled == [(one[0][0], pytest.approx(one[0][1], rel=1e-9) if one[0][1] is not None else None)]
