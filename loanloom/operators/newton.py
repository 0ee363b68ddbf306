"""Penalised logistic regression by Newton steps.

A step solves the weighted normal equations of the current scores. Each task adds
up its rows' part of them with one matrix product per Arrow batch, Spark adds the
tasks' parts row by row, and the driver solves a system with one equation per
feature. The error is squared at each step, so that seven or eight passes give what
takes a quasi-Newton search a hundred and more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Passes at most, and the gradient per row at which a solution is one.
MAX_PASSES = 25
TOLERANCE = 1e-11


@dataclass
class Step:
    """What one pass finds at some coefficients (the last is the intercept)."""

    loss: float
    gradient: np.ndarray
    hessian: np.ndarray
    weight: float


def measure(rows: DataFrame, beta: np.ndarray) -> Step:
    """Weighted log loss of rows (x array, y, w), its gradient and its second
    derivatives at ``beta``; nothing but sums of the size of the system is moved."""
    size = len(beta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size + 1, size + 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size - 1)
            x = np.hstack([x, np.ones((len(x), 1))])
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            margin = x @ beta
            tail = np.exp(-np.abs(margin))
            p = np.where(margin >= 0, 1.0, tail) / (1.0 + tail)
            loss = np.log1p(tail) + np.maximum(margin, 0.0) - y * margin
            sums[:size, :size] += x.T @ (x * (w * p * (1.0 - p))[:, None])
            sums[:size, size] += x.T @ (w * (p - y))
            sums[size, 0] += w @ loss
            sums[size, 1] += w.sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size + 1)), pa.array(sums.tolist(), pa.list_(pa.float64()))],
            ["at", "sums"],
        )

    parts = rows.mapInArrow(run, "at long, sums array<double>")
    total = Summarizer.metrics("sum").summary(array_to_vector("sums"))
    added = parts.groupBy("at").agg(total.alias("s")).select("at", "s.sum").collect()
    sums = np.zeros((size + 1, size + 1))
    for r in added:
        sums[r["at"]] = r["sum"].toArray()
    return Step(sums[size, 0], sums[:size, size], sums[:size, :size], sums[size, 1])


def solve(
    rows: DataFrame, features: int, penalty: float, passes: int = MAX_PASSES
) -> np.ndarray:
    """Coefficients and intercept that minimise the weighted mean log loss plus
    ``penalty`` / 2 times the squared coefficients. A step that does not lower the
    objective is halved."""
    beta = step = np.zeros(features + 1)
    shrink = np.full(features + 1, penalty)
    shrink[-1] = 0.0
    best = np.inf
    for _ in range(passes):
        found = measure(rows, beta)
        if not found.weight:
            raise ValueError("no rows to fit")
        objective = found.loss / found.weight + 0.5 * (shrink * beta) @ beta
        if objective > best * (1 + 1e-12) + 1e-15:
            step = step / 2
            beta = beta - step
            continue
        best = min(best, objective)
        gradient = found.gradient / found.weight + shrink * beta
        if np.abs(gradient).max() <= TOLERANCE:
            break
        hessian = found.hessian / found.weight + np.diag(shrink)
        step = -np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        if np.abs(step).max() <= 1e-14 * (1 + np.abs(beta).max()):
            break
        beta = beta + step
    return beta


def fixed_model(
    spark: SparkSession, coefficients: np.ndarray, intercept: float, features_col: str, label_col: str
) -> LogisticRegressionModel:
    """Spark's own logistic model with given coefficients: a fit on three rows
    whose bounds leave no other choice, so it is stored and loaded as any other."""
    n = len(coefficients)
    rows = [(Vectors.dense([v] * n), y) for v, y in ((-1.0, 0.0), (0.0, 1.0), (1.0, 1.0))]
    table = spark.createDataFrame(rows, [features_col, label_col]).coalesce(1)
    exact = DenseMatrix(1, n, list(map(float, coefficients)))
    at = DenseVector([float(intercept)])
    return LogisticRegression(
        featuresCol=features_col,
        labelCol=label_col,
        family="binomial",
        standardization=False,
        maxIter=1,
        lowerBoundsOnCoefficients=exact,
        upperBoundsOnCoefficients=exact,
        lowerBoundsOnIntercepts=at,
        upperBoundsOnIntercepts=at,
    ).fit(table)


class NewtonLogistic(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Binomial logistic regression with an L2 penalty on unscaled features; the
    same objective as ``LogisticRegression`` with ``standardization`` off, and the
    same kind of model. Rows without a label or weight are left out."""

    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "row weight", TypeConverters.toString)
    regParam = Param(Params._dummy(), "regParam", "penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "passes at most", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol: str = "features",
        labelCol: str = "label",
        weightCol: str | None = None,
        regParam: float = 0.0,
        maxIter: int = MAX_PASSES,
    ):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", regParam=0.0, maxIter=MAX_PASSES)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> LogisticRegressionModel:
        features, label = self.getOrDefault(self.featuresCol), self.getOrDefault(self.labelCol)
        weight = F.col(self.getOrDefault(self.weightCol)) if self.isSet(self.weightCol) else F.lit(1.0)
        rows = dataset.select(
            vector_to_array(features).alias("x"),
            F.col(label).cast("double").alias("y"),
            weight.cast("double").alias("w"),
        ).where("y IS NOT NULL AND w IS NOT NULL")
        first = rows.select(F.size("x")).first()
        if first is None:
            raise ValueError("no rows to fit")
        beta = solve(
            rows, first[0], self.getOrDefault(self.regParam), self.getOrDefault(self.maxIter)
        )
        return fixed_model(dataset.sparkSession, beta[:-1], beta[-1], features, label)
