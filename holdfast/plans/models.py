"""The arms that can be compared: one record each of how it is built, what a search may set, what the searches chose."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

from holdfast import config
from holdfast.operators.branches import FeatureBranches
from holdfast.plans.estimators import MedianRegressor, RidgeRegressor, StackRegressor
from holdfast.plans.leafwise import LeafwiseRegressor

LABEL = config.TARGET


class Setting(NamedTuple):
    """A setting's public name: the Spark Param behind it and how a public value becomes the Param's."""

    param: str
    convert: Callable[[Any], Any]


class Arm(NamedTuple):
    """``build`` makes the estimator for a label; ``settings`` are those it takes by public name."""

    purpose: str
    build: Callable[[str], Estimator]
    settings: Mapping[str, Setting] = {}


def _share(value: float) -> str:
    return "all" if float(value) == 1.0 else str(float(value))


def _boosted(**settings) -> Callable[[str], Estimator]:
    return lambda label: GBTRegressor(labelCol=label, seed=config.RANDOM_SEED, maxBins=64, maxMemoryInMB=1024, **settings)


_ROUNDS, _STEP = Setting("maxIter", int), Setting("stepSize", float)
_LEAST_ROWS, _ROWS, _COLUMNS = Setting("minInstancesPerNode", int), Setting("subsamplingRate", float), Setting("featureSubsetStrategy", _share)
_LEAVES, _L2 = Setting("numLeaves", int), Setting("lambdaL2", float)

# Spark's boosted trees grow level by level; those with a limit of leaves are grown by leaves here.
ARMS: dict[str, Arm] = {
    "dummy": Arm("the train median: what no skill costs", lambda label: MedianRegressor(labelCol=label)),
    "linear": Arm("what the engineered columns give a model without interactions",
                  lambda label: LinearRegression(labelCol=label, regParam=0.0, solver="normal")),
    "ridge": Arm("least squares that bears collinear indicators", lambda label: RidgeRegressor(labelCol=label, alpha=1.0),
                 {"alpha": Setting("alpha", float)}),
    "rf": Arm(
        "bagged trees, which need no scaling",
        lambda label: RandomForestRegressor(
            labelCol=label, seed=config.RANDOM_SEED, numTrees=100, maxDepth=30, featureSubsetStrategy="all", maxBins=64, maxMemoryInMB=1024,
            cacheNodeIds=False),
        {"n_estimators": Setting("numTrees", int), "max_depth": Setting("maxDepth", lambda depth: 30 if depth is None else int(depth)),
         "min_samples_leaf": _LEAST_ROWS, "max_features": _COLUMNS},
    ),
    "hgb": Arm(
        "boosting as a common library sets it", lambda label: LeafwiseRegressor(labelCol=label),
        {"learning_rate": _STEP, "max_iter": _ROUNDS, "max_leaf_nodes": _LEAVES, "min_samples_leaf": _LEAST_ROWS, "l2_regularization": _L2},
    ),
    "xgb": Arm(
        "boosting by depth, on samples of rows and columns", _boosted(maxIter=100, stepSize=0.3, maxDepth=6),
        {"n_estimators": _ROUNDS, "learning_rate": _STEP, "max_depth": Setting("maxDepth", int), "subsample": _ROWS,
         "colsample_bytree": _COLUMNS, "min_child_weight": _LEAST_ROWS},
    ),
    "lgbm": Arm(
        "boosting by leaves, in small steps", lambda label: LeafwiseRegressor(labelCol=label),
        {"n_estimators": _ROUNDS, "learning_rate": _STEP, "num_leaves": _LEAVES, "min_child_samples": _LEAST_ROWS,
         "subsample": _ROWS, "colsample_bytree": Setting("featureShare", float), "reg_lambda": _L2},
    ),
    "stack": Arm("unlike learners under one ridge", lambda label: stack(["id"], label=label)),
}

# Fixed values, which must equal the published ones: the values a search may draw, by model and public name.
CHOICES: dict[str, dict[str, list[Any]]] = {
    "ridge": {"alpha": [0.01, 0.1, 1.0, 10.0, 100.0]},
    "rf": {
        "n_estimators": [100, 200, 300],
        "max_depth": [None, 10, 20, 30],
        "min_samples_leaf": [1, 2, 4, 8],
        "max_features": [0.3, 0.5, 0.7, 1.0],
    },
    "hgb": {
        "learning_rate": [0.03, 0.05, 0.1, 0.2],
        "max_iter": [200, 400, 600],
        "max_leaf_nodes": [15, 31, 63, 127],
        "min_samples_leaf": [5, 10, 20, 40],
    },
    "xgb": {
        "n_estimators": [300, 600, 1000],
        "learning_rate": [0.03, 0.05, 0.1],
        "max_depth": [4, 6, 8, 10],
        "subsample": [0.7, 0.85, 1.0],
        "colsample_bytree": [0.6, 0.8, 1.0],
        "min_child_weight": [1, 5, 20],
    },
    "lgbm": {
        "n_estimators": [300, 600, 1000],
        "learning_rate": [0.03, 0.05, 0.1],
        "num_leaves": [31, 63, 127, 255],
        "min_child_samples": [5, 20, 50],
        "subsample": [0.7, 0.85, 1.0],
        "colsample_bytree": [0.6, 0.8, 1.0],
    },
}

# The values a search may draw for the preprocessing, by public path, and the Param of each path.
FEATURE_CHOICES: dict[str, tuple[str, list[Any]]] = {
    "preprocess__heavy__impute": ("heavyImputer", ["median", "mean", "knn"]),
    "preprocess__heavy__deskew": ("deskew", ["none", "log", "yeo-johnson"]),
    "preprocess__geo__n_clusters": ("nClusters", [5, 10, 20, 30, 45]),
    "preprocess__geo__gamma": ("gamma", [0.1, 0.3, 1.0, 3.0]),
    "preprocess__binned__bin__n_bins": ("nBins", [3, 5, 8, 12, 16]),
}

# The settings that the published searches chose, and the stack's members.
CHOSEN: dict[str, dict[str, Any]] = {
    "ridge": {"alpha": 10.0},
    "rf": {"n_estimators": 200, "max_depth": None, "min_samples_leaf": 1, "max_features": 0.3},
    "hgb": {"learning_rate": 0.05, "max_iter": 600, "max_leaf_nodes": 127, "min_samples_leaf": 20},
    "xgb": {
        "n_estimators": 600, "learning_rate": 0.05, "max_depth": 8, "subsample": 0.85, "colsample_bytree": 0.8, "min_child_weight": 5,
    },
    "lgbm": {
        "n_estimators": 600, "learning_rate": 0.05, "num_leaves": 127, "min_child_samples": 20, "subsample": 0.85, "colsample_bytree": 0.8,
        "reg_lambda": 1.0,
    },
}
CHOSEN_FEATURES: dict[str, dict[str, Any]] = {
    "rf": {"nClusters": 45, "gamma": 3.0, "nBins": 8, "deskew": "none"},
    "hgb": {"nClusters": 30, "gamma": 0.1, "nBins": 5, "deskew": "log"},
    "xgb": {"nClusters": 30, "gamma": 1.0, "nBins": 3, "deskew": "yeo-johnson"},
    "lgbm": {"nClusters": 20, "gamma": 0.3, "nBins": 12, "deskew": "yeo-johnson"},
}
MEMBERS = ("lgbm", "xgb", "hgb", "ridge")
#: The stack's members see the features that were chosen for its first, so they are fitted once, not once per member.
CHOSEN_FEATURES["stack"] = CHOSEN_FEATURES[MEMBERS[0]]


def arm(name: str) -> Arm:
    try:
        return ARMS[name]
    except KeyError:
        raise KeyError(f"no arm is called {name!r}; there are {', '.join(ARMS)}") from None


def build(name: str, *, label: str = LABEL, **values) -> Estimator:
    """An arm's estimator with the given settings, by public name; one that the arm doesn't take is refused."""
    record = arm(name)
    strange = sorted(values.keys() - record.settings.keys())
    if strange:
        raise KeyError(f"{name!r} takes no {', '.join(strange)}, only {', '.join(record.settings) or 'its defaults'}")
    estimator = record.build(label)
    return estimator._set(**{record.settings[k].param: record.settings[k].convert(v) for k, v in values.items()}) if values else estimator


def chosen(name: str, *, label: str = LABEL, keys: Sequence[str] = ("id",), **values) -> Estimator:
    """An arm as the searches chose it, with single settings replaced by ``values``."""
    if name == "stack":
        return stack(keys, label=label)
    return build(name, label=label, **{**CHOSEN.get(name, {}), **values})


def chosen_features(name: str) -> dict[str, Any]:
    return dict(CHOSEN_FEATURES.get(name, {}))


def stack(keys: Sequence[str], settings: Mapping[str, Mapping[str, Any]] | None = None, *, label: str = LABEL, **options) -> StackRegressor:
    """The stack of ``MEMBERS`` as chosen; ``keys`` order its folds."""
    members = {m: chosen(m, label=label, **(settings or {}).get(m, {})) for m in MEMBERS}
    return StackRegressor(members, keyCols=list(keys), labelCol=label, **options)


def model_chain(estimator: Estimator, **preprocess) -> Pipeline:
    """Preprocessing, names and model as one estimator: what a fold must refit whole."""
    return Pipeline(stages=[FeatureBranches(**preprocess), estimator])


def chosen_chain(name: str, *, keys: Sequence[str] = ("id",)) -> Pipeline:
    return model_chain(chosen(name, keys=keys), **chosen_features(name))


def is_iterative(estimator: Estimator) -> bool:
    """Does fitting read its input many times, so that keeping it in memory pays?"""
    return isinstance(estimator, (GBTRegressor, LeafwiseRegressor, RandomForestRegressor, StackRegressor))
