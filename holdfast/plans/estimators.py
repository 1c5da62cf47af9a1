"""Regressors Spark ML lacks: train median and a stack with a ridge on top."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import config
from holdfast.operators.split import with_fold
from holdfast.operators.stats import Quantiles, fit_together, keep_all, keep_where, side_by_side
from holdfast.plans.ridge import RidgeRegressor


__all__ = ["ConstantModel", "MedianRegressor", "RidgeRegressor", "StackModel", "StackRegressor", "as_vector", "fit_ridge_cv"]


class _Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Shared column parameters."""


class MedianRegressor(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts the training median: the floor every other score is read against."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ConstantModel":
        return self._models(dataset.select(self.getLabelCol()), [keep_all])[0]

    def fit_folds(self, dataset: DataFrame, fold: str, n_splits: int) -> list["ConstantModel"]:
        """One model per fold, each from the rows outside it, all in the same passes."""
        return self._models(dataset.select(self.getLabelCol(), fold), [keep_where(F.col(fold) != i) for i in range(n_splits)])

    def _models(self, rows: DataFrame, keeps) -> list["ConstantModel"]:
        def median(keep):
            found = yield {"y": Quantiles(keep(F.col(self.getLabelCol())), (0.5,))}
            return found["y"]

        found = fit_together(rows, [median(keep) for keep in keeps])
        if None in found:
            raise ValueError("no training row holds a label")
        return [ConstantModel()._set(value=values[0], predictionCol=self.getPredictionCol()) for values in found]


class ConstantModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    value = Param(Params._dummy(), "value", "the prediction", TypeConverters.toFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getPredictionCol(), F.lit(self.getOrDefault(self.value)))


class StackRegressor(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Base learners judged by out-of-fold predictions, arbitrated by a ridge.

    Every member is fitted on each fold's complement and predicts that fold, so a row's level-one
    features come from models that never saw it. The ridge's alpha has the least leave-one-out
    error, taken in closed form from one moment matrix and one pass. Members are refitted on all rows.
    """

    folds = Param(Params._dummy(), "folds", "out-of-fold splits", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the folds", TypeConverters.toInt)
    keyCols = Param(Params._dummy(), "keyCols", "row key, orders the folds", TypeConverters.toListString)
    alphas = Param(Params._dummy(), "alphas", "ridge penalties to try", TypeConverters.toListFloat)
    parallelism = Param(Params._dummy(), "parallelism", "member fits at a time", TypeConverters.toInt)

    def __init__(self, members: dict[str, Estimator], *, keyCols: Sequence[str], folds=5, seed=config.RANDOM_SEED,
                 alphas=(0.1, 1.0, 10.0, 100.0), parallelism=4, featuresCol="features", labelCol="label",
                 predictionCol="prediction"):
        super().__init__()
        self.members = members
        self._set(keyCols=list(keyCols), folds=folds, seed=seed, alphas=list(alphas), parallelism=parallelism,
                  featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol)

    def copy(self, extra=None):
        return StackRegressor(
            {k: m.copy() for k, m in self.members.items()},
            **{p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p)},
        )._set(**{p.name: v for p, v in (extra or {}).items()})

    def out_of_fold(self, dataset: DataFrame) -> DataFrame:
        """keys, label, fold and one out-of-fold prediction column per member."""
        label, features = self.getLabelCol(), self.getFeaturesCol()
        keys, k = self.getOrDefault(self.keyCols), self.getOrDefault(self.folds)
        folded = with_fold(dataset, keys, k, seed=self.getOrDefault(self.seed)).select(*keys, label, features, "fold")
        folded = folded.persist()

        def fit(name, i):
            return self._member(name).fit(folded.where(F.col("fold") != i))

        jobs = [(name, i) for i in range(k) for name in self.members]
        fitted = dict(zip(jobs, side_by_side(
            [lambda name=name, i=i: fit(name, i) for name, i in jobs], self.getOrDefault(self.parallelism)
        )))
        parts = []
        for i in range(k):
            part = folded.where(F.col("fold") == i)
            for name in self.members:
                part = fitted[(name, i)].transform(part)
            parts.append(part.select(*keys, label, "fold", *[_level_one(name) for name in self.members]))
        self._folded = folded
        return reduce(DataFrame.unionByName, parts)

    def _member(self, name: str) -> Estimator:
        return self.members[name].copy()._set(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), predictionCol=_level_one(name)
        )

    def _fit(self, dataset: DataFrame) -> "StackModel":
        first = self.out_of_fold(dataset).persist()
        try:
            columns = [F.col(_level_one(name)) for name in self.members]
            weights, intercept, alpha = fit_ridge_cv(
                first, columns, F.col(self.getLabelCol()), self.getOrDefault(self.alphas)
            )
        finally:
            first.unpersist()
        names = list(self.members)
        models = side_by_side(
            [lambda name=name: self._member(name).fit(self._folded) for name in names],
            self.getOrDefault(self.parallelism),
        )
        self._folded.unpersist()
        return StackModel(dict(zip(names, models)))._set(
            weights=weights, intercept=intercept, alpha=alpha, predictionCol=self.getPredictionCol()
        )


def _level_one(name: str) -> str:
    return f"oof_{name}"


class StackModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    weights = Param(Params._dummy(), "weights", "ridge weights, in member order", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "ridge intercept", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "chosen penalty", TypeConverters.toFloat)

    def __init__(self, members: dict[str, Model] | None = None):
        super().__init__()
        self.members = members or {}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        prediction = F.lit(self.getOrDefault(self.intercept))
        for (name, member), weight in zip(self.members.items(), self.getOrDefault(self.weights)):
            out = member.transform(out)
            prediction = prediction + F.lit(weight) * F.col(_level_one(name))
        out = out.withColumn(self.getPredictionCol(), prediction)
        return out.drop(*[_level_one(name) for name in self.members])

    def write(self):
        return _StackWriter(self)

    @classmethod
    def read(cls):
        return _StackReader(cls)


class _StackWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        members = {k: f"{type(m).__module__}.{type(m).__name__}" for k, m in self.instance.members.items()}
        DefaultParamsWriter.saveMetadata(
            self.instance, path, self.sparkSession, extraMetadata={"members": json.dumps(members)}
        )
        for name, member in self.instance.members.items():
            member.write().overwrite().save(f"{path}/members/{name}")


class _StackReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        for name, kind in json.loads(metadata["members"]).items():
            cls = DefaultParamsReader._DefaultParamsReader__get_class(kind)
            model.members[name] = cls.load(f"{path}/members/{name}")
        return model


def fit_ridge_cv(df: DataFrame, xs: Sequence[Column], y: Column, alphas: Sequence[float]):
    """Ridge whose alpha has the smallest leave-one-out error; returns weights, intercept, alpha.

    Leaving row i out changes its error to e_i / (1 - h_i), and the leverage h_i is a quadratic form
    in the row, so all alphas are judged in one aggregation after the moments.
    """
    everything = [*xs, y]
    p = len(xs)
    moments = {"n": F.count(y), **{f"m{i}": F.avg(c) for i, c in enumerate(everything)}}
    moments.update({
        f"c{i}_{j}": F.covar_pop(everything[i], everything[j]) for i in range(p + 1) for j in range(i, p + 1)
    })
    m = df.agg(*[c.alias(k) for k, c in moments.items()]).first()
    full = np.array([[m[f"c{min(i, j)}_{max(i, j)}"] for j in range(p + 1)] for i in range(p + 1)]) * m["n"]
    means = np.array([m[f"m{i}"] for i in range(p + 1)])
    centred = [x - F.lit(float(v)) for x, v in zip(xs, means)]
    solved, errors = [], []
    for a in alphas:
        inverse = np.linalg.inv(full[:p, :p] + a * np.eye(p))
        weights = inverse @ full[:p, p]
        solved.append(weights)
        error = y - F.lit(float(means[p]))
        leverage = F.lit(1.0 / m["n"])
        for i in range(p):
            error = error - F.lit(float(weights[i])) * centred[i]
            for j in range(p):
                leverage = leverage + F.lit(float(inverse[i, j])) * centred[i] * centred[j]
        left_out = error / (1.0 - leverage)
        errors.append(F.avg(left_out * left_out))
    scores = df.agg(*[e.alias(f"e{i}") for i, e in enumerate(errors)]).first()
    best = min(range(len(alphas)), key=lambda i: scores[i])
    weights = solved[best]
    return [float(w) for w in weights], float(means[p] - weights @ means[:p]), float(alphas[best])


def as_vector(*columns: str) -> Column:
    """Plain columns as a feature vector, for models without the branches."""
    return array_to_vector(F.array(*[F.col(c).cast("double") for c in columns]))
