import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from conftest import plan_text
from loanloom.operators import bins, newton, prepare, quantiles, training
from pyspark.sql import functions as F


def rows(spark, n=400, seed=1):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        x = [rng.gauss(0, 1), rng.gauss(2, 3), 0.0, rng.choice([-1.0, 1.0])]
        y = float(x[0] + 0.3 * x[1] + rng.gauss(0, 1) > 1.5)
        data.append((Vectors.dense(x), y, 0.5 + (i % 3)))
    return spark.createDataFrame(data, ["features", "label", "weight"])


def test_same_solution_as_a_quasi_newton_search(spark):
    df = rows(spark).repartition(5).cache()
    for penalty in (1.0, 0.01, 1.0 / 400):
        mine = newton.NewtonLogistic(weightCol="weight", regParam=penalty).fit(df)
        theirs = LogisticRegression(
            weightCol="weight", regParam=penalty, standardization=False, tol=1e-14, maxIter=1000
        ).fit(df)
        assert mine.coefficients.toArray() == pytest.approx(theirs.coefficients.toArray(), abs=1e-6)
        assert mine.intercept == pytest.approx(theirs.intercept, abs=1e-6)


def test_few_passes_and_a_vanishing_gradient(spark, monkeypatch):
    df = rows(spark, 600, 2)
    passes = []
    measure = newton.measure
    monkeypatch.setattr(newton, "measure", lambda *a: passes.append(measure(*a)) or passes[-1])
    model = newton.NewtonLogistic(regParam=0.002).fit(df)
    assert len(passes) <= 15
    last = passes[-1]
    beta = np.append(model.coefficients.toArray(), 0.0)
    assert np.abs(last.gradient / last.weight + 0.002 * beta).max() < 1e-9


def test_separable_rows_and_one_feature(spark):
    data = [(Vectors.dense([v]), float(v > 0)) for v in (-3.0, -2.0, -1.0, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(data, ["features", "label"])
    model = newton.NewtonLogistic(regParam=0.1).fit(df)
    out = model.transform(df).select("prediction", "label").collect()
    assert all(r.prediction == r.label for r in out)
    assert abs(model.intercept) < 1e-9 and model.coefficients[0] > 0


def test_rows_without_label_are_left_out_and_none_is_an_error(spark):
    df = rows(spark, 50).select("features", F.when(F.rand(1) < 2, F.col("label")).alias("label"))
    more = df.unionAll(df.limit(5).withColumn("label", F.lit(None).cast("double")))
    a, b = (newton.NewtonLogistic(regParam=0.1).fit(d) for d in (df, more))
    assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), abs=1e-9)
    with pytest.raises(ValueError, match="no rows"):
        newton.NewtonLogistic().fit(df.limit(0))


def test_preparations_of_all_folds_equal_single_ones(spark):
    rng = random.Random(4)
    data = [
        (i, i % 3, rng.gauss(0, 1) if rng.random() < 0.8 else None, float(rng.randrange(4)), None, rng.choice("abc"))
        for i in range(200)
    ] + [(200, 1, None, None, None, "only here"), (201, 0, 7.0, 9.0, 1.0, None)]
    df = spark.createDataFrame(data, "id int, part int, x double, y double, z double, s string")
    stage = prepare.ColumnPreparation(exclude=["id", "part"])
    together = stage.fit_groups(df, "part", [[1, 2], [0, 2], [0, 1]])
    for g, found in enumerate(together):
        alone = stage.fit(df.where(F.col("part") != g))
        a, b = found.values, alone.values
        assert a["medians"] == b["medians"] and a["modes"] == b["modes"]
        assert a["numeric"] == b["numeric"] and a["categorical"] == b["categorical"]
        for c in a["scaling"]:
            assert a["scaling"][c] == pytest.approx(b["scaling"][c])
            plain = prepare.scaling(prepare.impute_medians(df.where(F.col("part") != g), a["medians"]), [c])
            assert a["scaling"][c] == pytest.approx(plain[c])
        assert sorted(map(tuple, found.codes.collect())) == sorted(map(tuple, alone.codes.collect()))


def test_rounds_are_planned_alike_for_few_and_many_columns(spark):
    plans = []
    for n in (20, 200):
        df = spark.createDataFrame([([float(i) for i in range(n)],)], "v array<double>")
        values = bins.long_values(df, F.col("v"), n)
        found = bins._within(values, [bins.Bracket(c, 0.0, 9.0) for c in range(n)])
        plans.append(len(plan_text(found.groupBy("k", bins._bin_number().alias("bin")).count())))
    assert abs(plans[0] - plans[1]) < 20


def test_quantiles_of_overlapping_groups(spark):
    rng = random.Random(9)
    data = [(i % 4, [rng.gauss(0, 1), float(rng.randrange(5))]) for i in range(500)]
    df = spark.createDataFrame(data, "part int, v array<double>")
    members = F.array(F.lit(0), F.col("part") + 1)
    values = bins.long_values(df, F.col("v"), 2, members)
    found = quantiles.long_quantiles(values, bins.bounds(values, 10), [0.3, 0.5])
    for g in range(5):
        held = [v for p, v in data if g == 0 or p + 1 == g]
        for c in range(2):
            assert found[2 * g + c] == pytest.approx(np.quantile([v[c] for v in held], [0.3, 0.5]))


def test_family_fits_with_newton():
    counts = training.ClassCounts(3, 1)
    built = training.LOGISTIC.build("y", counts, {})
    assert isinstance(built, newton.NewtonLogistic) and built.getOrDefault("regParam") == 0.25
