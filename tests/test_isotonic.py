import random

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from loanloom.operators import evaluation, isotonic


def exact(points):
    """Pool adjacent violators over sorted (score, total, weight)."""
    blocks = []
    for s, t, w in sorted(points):
        blocks.append([s, s, t, w])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, high, t, w = blocks.pop()
            blocks[-1][1:] = [high, blocks[-1][2] + t, blocks[-1][3] + w]
    return [(a, b, t / w, w) for a, b, t, w in blocks]


def points_of(kind, n, rng):
    rates = {
        "rising": lambda i: 0.05 + 0.9 * i / n,
        "falling": lambda i: 0.95 - 0.9 * i / n,
        "saw": lambda i: (i % 40) / 40,
        "flat": lambda i: 0.5,
    }[kind]
    out = []
    for i in range(n):
        w = rng.randint(1, 4)
        out.append((i * 0.5, float(sum(rng.random() < rates(i) for _ in range(w))), float(w)))
    return out


@pytest.mark.parametrize("kind", ["rising", "falling", "saw", "flat"])
def test_blocks_of_small_ranges_are_exact(spark, kind):
    points = points_of(kind, 600, random.Random(3))
    df = spark.createDataFrame(points, "score double, total double, weight double").repartition(5)
    for size in (8, 64, 1 << 16):
        found = isotonic.isotonic_blocks(df, "score", "total", "weight", size).collect()
        assert sorted((r.low, r.high, r.value, r.weight) for r in found) == exact(points)


def test_points_that_rise_all_the_way_stay_apart(spark):
    points = [(float(i), i / 500, 1.0) for i in range(500)]
    df = spark.createDataFrame(points, "score double, total double, weight double")
    found = isotonic.isotonic_blocks(df, "score", "total", "weight", 16)
    assert found.count() == 500


def test_calibration_equals_the_whole_fit(spark):
    rng = random.Random(8)
    data = [(round(rng.random(), 3), int(rng.random() < 0.4)) for _ in range(3000)]
    df = spark.createDataFrame([*data, (None, 1), (0.5, None)], "score double, y int")
    mine = evaluation.fit_calibration(df, "score", "y", "p")
    whole = IsotonicRegression(featuresCol="score", labelCol="y", predictionCol="q").fit(
        df.where("score IS NOT NULL AND y IS NOT NULL").select("score", F.col("y").cast("double").alias("y"))
    )
    grid = spark.createDataFrame([(i / 777 - 0.1,) for i in range(1000)], "score double")
    for r in whole.transform(mine.transform(grid)).collect():
        assert r.p == pytest.approx(r.q, abs=1e-12)


def test_one_score_and_none(spark):
    df = spark.createDataFrame([(0.3, 1), (0.3, 0), (0.3, 0)], "score double, y int")
    model = evaluation.fit_calibration(df, "score", "y", "p")
    out = model.transform(spark.createDataFrame([(0.1,), (0.9,)], "score double"))
    assert [r.p for r in out.collect()] == pytest.approx([1 / 3, 1 / 3])
    none = spark.createDataFrame([], "score double, total double, weight double")
    assert isotonic.isotonic_blocks(none, "score", "total", "weight").collect() == []


def test_pool_is_associative():
    points = points_of("saw", 200, random.Random(5))
    s, t, w = (np.array(c) for c in zip(*points))
    whole = isotonic.pool(s, s, t, w)
    left = isotonic.pool(s[:90], s[:90], t[:90], w[:90])
    right = isotonic.pool(s[90:], s[90:], t[90:], w[90:])
    assert isotonic.pool(*(np.array(c) for c in zip(*left, *right))) == whole
