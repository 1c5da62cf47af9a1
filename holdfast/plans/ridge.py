"""Ridge regressions from moments: all folds from one pass, all penalties from one decomposition, all scores from one more pass."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import replace
from functools import partial
from typing import Any

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.moments import TargetMoments, matrix_of, target_moments
from holdfast.operators.partials import Arrays, Sums, run_partials
from holdfast.operators.stats import number_array


class RidgePath:
    """The least-squares problem of one table, decomposed once for every penalty."""

    def __init__(self, moments: TargetMoments):
        self.moments = moments
        values, self.vectors = np.linalg.eigh(moments.xx)
        self.values = np.clip(values, 0.0, None)
        self.rotated = self.vectors.T @ moments.xy

    def at(self, alpha: float) -> tuple[np.ndarray, float]:
        """Weights and intercept; directions in which nothing varies get no weight."""
        scale = self.values + alpha
        least = 1e-12 * max(float(self.values.max(initial=0.0)), 1e-300)
        weights = self.vectors @ np.where(scale > least, self.rotated / np.where(scale > least, scale, 1.0), 0.0)
        return weights, float(self.moments.y_mean - weights @ self.moments.x_mean)


class ChosenPath(RidgePath):
    """The problem on some of the features; the others get no weight."""

    def __init__(self, moments: TargetMoments, chosen: Sequence[int]):
        self.whole, self.chosen = moments, list(chosen)
        at = self.chosen
        super().__init__(replace(moments, x_mean=moments.x_mean[at], xx=moments.xx[np.ix_(at, at)], xy=moments.xy[at]))

    def at(self, alpha: float) -> tuple[np.ndarray, float]:
        some, intercept = super().at(alpha)
        weights = np.zeros(len(self.whole.x_mean))
        weights[self.chosen] = some
        return weights, intercept


class RidgeRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """L2 least squares, ``|y - Xb|^2 + alpha |b|^2`` with a free intercept, from one pass of moments."""

    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, alpha=1.0, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(alpha=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "RidgeModel":
        array = vector_to_array(F.col(self.getFeaturesCol()))
        (moments,) = target_moments(dataset, [array], F.col(self.getLabelCol()), [F.lit(True)])
        return self.model(*RidgePath(moments).at(self.getOrDefault(self.alpha)))

    def model(self, weights: np.ndarray, intercept: float) -> "RidgeModel":
        return RidgeModel()._set(
            weights=[float(w) for w in weights], bias=intercept, featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol()
        )


class RidgeModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    weights = Param(Params._dummy(), "weights", "weights in feature order", TypeConverters.toListFloat)
    bias = Param(Params._dummy(), "bias", "intercept", TypeConverters.toFloat)

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.getOrDefault(self.weights))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.bias)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.getFeaturesCol()))
        terms = F.zip_with(x, number_array(self.getOrDefault(self.weights)), lambda a, b: a * b)
        return dataset.withColumn(self.getPredictionCol(), F.lit(self.intercept) + F.aggregate(terms, F.lit(0.0), lambda a, b: a + b))


def _error_sums(columns: Arrays, of: Sequence[str], weights: Sequence[np.ndarray], intercepts: Sequence[np.ndarray], shift: float) -> np.ndarray:
    """For each fold, side (held out, training) and penalty: rows, sums of absolute and squared errors, of the label and its square."""
    y, fold, out = columns["y"], columns["fold"], []
    for i, name in enumerate(of):
        x = matrix_of(columns[name])
        error = y[:, None] - (x @ weights[i] + intercepts[i] if len(x) else np.zeros((0, len(intercepts[i]))))
        for side in (fold == i, fold != i):
            rows = side & ~np.isnan(y)
            e, label = error[rows], y[rows] - shift
            ones = np.ones(e.shape[1])
            out.append(np.stack([len(e) * ones, np.abs(e).sum(0), (e * e).sum(0), label.sum() * ones, (label * label).sum() * ones], 1))
    return np.concatenate(out)


def _metrics(side: str, sums: np.ndarray) -> dict[str, float | None]:
    """As ``metrics.metric_columns`` defines them."""
    n, absolute, squared, label, label_squared = sums
    if not n:
        return {f"{side}_rmse": None, f"{side}_mae": None, f"{side}_r2": None, f"{side}_n": 0}
    spread = label_squared - label * label / n
    varies = spread > 1e-14 * label_squared
    r2 = None if n < 2 else 1.0 - squared / spread if varies else float(squared == 0)
    return {f"{side}_rmse": float(np.sqrt(squared / n)), f"{side}_mae": float(absolute / n), f"{side}_r2": r2, f"{side}_n": int(n)}


def held_out_rmse(
    folded: DataFrame, array: Column, y: Column, fold: str, models: Sequence[Sequence[tuple[np.ndarray, float]]], shift: float
) -> list[list[float]]:
    """The error of each fold's linear models, as weights and intercepts, on that fold's rows: one pass for all of them."""
    ready = folded.select(array.cast("array<double>").alias("x0"), y.cast("double").alias("y"), F.col(fold).cast("double").alias("fold"))
    work = partial(
        _error_sums, of=["x0"] * len(models), weights=[np.stack([w for w, _ in some], 1) for some in models],
        intercepts=[np.array([b for _, b in some]) for some in models], shift=shift,
    )
    sums = run_partials(ready, [Sums({"y": F.col("y"), "fold": F.col("fold")}, work)], raw=["x0"])[0].reshape(len(models), 2, -1, 5)
    return [[_metrics("test", line)["test_rmse"] for line in sums[i, 0]] for i in range(len(models))]


def ridge_folds(
    estimator: RidgeRegressor, alphas: Sequence[float], folded: DataFrame, arrays: Sequence[Column], n_splits: int, *, fold: str = "fold", label: str,
) -> list[list[dict[str, Any]]]:
    """For each penalty the score records of all folds. ``arrays`` holds each fold's features, or one array for all of them."""
    started = time.time()
    y = F.col(label)
    paths = [RidgePath(m) for m in target_moments(folded, arrays, y, [F.col(fold) != i for i in range(n_splits)])]
    solved = [[path.at(a) for a in alphas] for path in paths]
    seconds = (time.time() - started) / n_splits
    names = [f"x{i}" for i in range(len(arrays))]
    ready = folded.select(*[a.cast("array<double>").alias(n) for a, n in zip(arrays, names)], y.cast("double").alias("y"), F.col(fold).cast("double").alias("fold"))
    work = partial(
        _error_sums, of=names if len(names) > 1 else names * n_splits, weights=[np.stack([w for w, _ in s], 1) for s in solved],
        intercepts=[np.array([b for _, b in s]) for s in solved], shift=paths[0].moments.y_mean,
    )
    sums = run_partials(ready, [Sums({"y": F.col("y"), "fold": F.col("fold")}, work)], raw=names)[0].reshape(n_splits, 2, len(alphas), 5)
    return [
        [
            {"fold": i, **_metrics("test", sums[i, 0, a]), **_metrics("train", sums[i, 1, a]), "fit_seconds": seconds,
             "model": estimator.copy({estimator.alpha: alpha}).model(*solved[i][a])}
            for i in range(n_splits)
        ]
        for a, alpha in enumerate(alphas)
    ]
