"""Boosted regression trees grown leaf by leaf: the leaf whose split gains most is split next, whatever its depth.

Features are binned once, by quantiles, into one byte each. A pass over the binned rows adds up counts and residuals by
(leaf, feature, bin) for as many leaves as may still be split, of two siblings only for the one with fewer rows: the other is
what is left of their parent. The driver keeps the open leaves by gain. Splitting ahead of the queue costs histograms that may
not be needed, but no pass for each leaf, and changes nothing: a leaf becomes a split only when it is the first of the queue.

A tree's leaf values are its mean residuals, shrunk by the L2 penalty and the step. Rows and features of a round are drawn by
hash and by seed, so a lost partition comes back the same. Predictions are kept with the binned rows and brought up to date
every ``REFRESH`` rounds; rounds in between are replayed in the pass.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import config
from holdfast.operators.clusters import hashed_uniform
from holdfast.operators.partials import Arrays, Passes, Sums
from holdfast.operators.stats import Quantiles, fit_one, held

REFRESH = 10
#: Leaves whose histograms one pass adds up at most.
AHEAD = 32
#: A tree: for each node its feature (-1 for a leaf), threshold, left child (the right one follows it), and value.
Tree = tuple[list[int], list[float], list[int], list[float]]


def place(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The node that each row of ``x`` ends in; values up to a threshold go left."""
    feature, threshold, left, _ = map(np.asarray, tree)
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while len(rows):
        rows = rows[feature[node[rows]] >= 0]
        at = node[rows]
        node[rows] = left[at] + ~(x[rows, feature[at]] <= threshold[at])
    return node


def predict(trees: Sequence[Tree], x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x))
    for tree in trees:
        out += np.asarray(tree[3])[place(tree, x)]
    return out


def _unpacked(column: pa.Array, p: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, p)


def _histograms(columns: Arrays, *, p: int, bins: int, since: Sequence[Tree], tree: Tree, leaves: Sequence[int], share: float, tag: int) -> np.ndarray:
    """By leaf, the number and the summed residuals of its rows by feature and bin."""
    x = _unpacked(columns["bins"], p)
    residual = columns["y"] - columns["f"] - predict(since, x)
    node = place(tree, x)
    slot = np.full(len(tree[0]), -1)
    slot[list(leaves)] = np.arange(len(leaves))
    home = slot[node]
    if share < 1.0:
        home = np.where(hashed_uniform(columns["draw"][:, None], tag) < share, home, -1)
    inside = home >= 0
    x, residual, home = x[inside], residual[inside], home[inside]
    out = np.zeros((len(leaves), p, bins, 2))
    for j in range(p):
        at = home * bins + x[:, j]
        out[:, j, :, 0] = np.bincount(at, minlength=len(leaves) * bins).reshape(-1, bins)
        out[:, j, :, 1] = np.bincount(at, residual, len(leaves) * bins).reshape(-1, bins)
    return out.reshape(len(leaves), -1)


def best_split(histogram: np.ndarray, features: Sequence[int], least: int, penalty: float) -> tuple[float, int, int] | None:
    """gain, feature and bin of a leaf's best split, the first of equals; None if no split leaves ``least`` rows on both sides."""
    left = histogram[list(features)].cumsum(1)[:, :-1]
    total = histogram[0].sum(0)
    n, s = left[..., 0], left[..., 1]
    rest = total[0] - n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = s * s / (n + penalty) + (total[1] - s) ** 2 / (rest + penalty) - total[1] ** 2 / (total[0] + penalty)
    gain = np.where((n >= max(least, 1)) & (rest >= max(least, 1)), gain, -np.inf)
    if not gain.size or gain.max() <= 1e-12 * max(total[1] ** 2, 1.0):
        return None
    j, b = divmod(int(gain.argmax()), gain.shape[1])
    return float(gain[j, b]), features[j], b


def grow(histograms_of, p: int, bins: int, features: Sequence[int], leaves: int, least: int, penalty: float) -> Tree:
    """A tree of at most ``leaves`` leaves on bins; ``histograms_of(tree, nodes)`` answers with the nodes' histograms."""
    tree: Tree = ([-1], [0.0], [0], [0.0])
    held = {0: histograms_of(tree, [0])[0].reshape(p, bins, 2)}
    split = {0: best_split(held[0], features, least, penalty)}
    #: the tree as split ahead, and the nodes of it that are split for good
    children: dict[int, int] = {}
    queue = [(-split[0][0], 0)] if split[0] else []
    n_leaves, final = 1, set()
    while queue and n_leaves < leaves:
        if queue[0][1] not in children:
            ahead = [node for _, node in sorted(queue) if node not in children][: max(1, min(AHEAD, leaves - n_leaves))]
            for node in ahead:
                _, feature, at = split[node]
                children[node] = len(tree[0])
                tree[0][node], tree[1][node], tree[2][node] = feature, float(at), len(tree[0])
                for part, value in zip(tree, (-1, 0.0, 0, 0.0)):
                    part.extend([value, value])
            small = {}
            for node in ahead:
                _, feature, at = split[node]
                n_left, n = held[node][feature, : at + 1, 0].sum(), held[node][feature, :, 0].sum()
                small[node] = children[node] + (2 * n_left > n)
            for node, made in zip(ahead, histograms_of(tree, list(small.values()))):
                made = made.reshape(p, bins, 2)
                held[small[node]] = made
                held[2 * children[node] + 1 - small[node]] = held[node] - made
            for node in ahead:
                for child in (children[node], children[node] + 1):
                    split[child] = best_split(held[child], features, least, penalty)
        _, node = heapq.heappop(queue)
        final.add(node)
        n_leaves += 1
        for child in (children[node], children[node] + 1):
            if split[child]:
                heapq.heappush(queue, (-split[child][0], child))
    return _pruned(tree, final, held, penalty)


def _pruned(tree: Tree, final: set[int], held: dict[int, np.ndarray], penalty: float) -> Tree:
    """The tree without the nodes that were split ahead in vain."""
    out: Tree = ([], [], [], [])
    order, at = [0], 0
    while at < len(order):
        node = order[at]
        inner = node in final
        n, s = held[node][0].sum(0)
        row = (tree[0][node], tree[1][node], len(order), 0.0) if inner else (-1, 0.0, 0, float(s / (n + penalty)) if n + penalty else 0.0)
        for part, value in zip(out, row):
            part.append(value)
        if inner:
            order += [tree[2][node], tree[2][node] + 1]
        at += 1
    return out


class LeafwiseRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Least-squares boosting with leaf-wise trees."""

    maxIter = Param(Params._dummy(), "maxIter", "rounds", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "shrinkage of each round", TypeConverters.toFloat)
    numLeaves = Param(Params._dummy(), "numLeaves", "leaves of a tree at most", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows of a leaf at least", TypeConverters.toInt)
    lambdaL2 = Param(Params._dummy(), "lambdaL2", "L2 penalty on leaf values", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature at most, 2 to 256", TypeConverters.toInt)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows of each round", TypeConverters.toFloat)
    featureShare = Param(Params._dummy(), "featureShare", "share of the features of each round", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of rows and features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, maxIter=100, stepSize=0.1, numLeaves=31, minInstancesPerNode=20, lambdaL2=0.0, maxBins=255, subsamplingRate=1.0,
                 featureShare=1.0, seed=config.RANDOM_SEED, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(maxIter=100, stepSize=0.1, numLeaves=31, minInstancesPerNode=20, lambdaL2=0.0, maxBins=255, subsamplingRate=1.0,
                         featureShare=1.0, seed=config.RANDOM_SEED)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "LeafwiseModel":
        o = {param.name: self.getOrDefault(param) for param in self.params}
        if not 2 <= o["maxBins"] <= 256:
            raise ValueError("maxBins must lie between 2 and 256: a bin is one byte")
        rows = dataset.select(vector_to_array(F.col(o["featuresCol"])).alias("x"), F.col(o["labelCol"]).cast("double").alias("y")).where("y is not null")
        # Features are worked out once, for their quantiles and for the bins.
        with held(rows) as rows:
            first = rows.first()
            if first is None:
                raise ValueError("no training row holds a label")
            p = len(first["x"])
            edges = _edges(rows, p, o["maxBins"])
            start = rows.agg(F.avg("y")).first()[0]
            table = _binned(rows, edges, start).persist(StorageLevel.MEMORY_AND_DISK)
            table.count()
        bins = max(len(e) for e in edges) + 1
        rng = np.random.default_rng(o["seed"])
        trees: list[Tree] = []
        passes, since = Passes(table), 0
        try:
            for number in range(o["maxIter"]):
                features = sorted(rng.choice(p, max(1, round(o["featureShare"] * p)), replace=False).tolist())

                def histograms_of(tree: Tree, nodes: list[int], passes=passes, number=number, since=since) -> np.ndarray:
                    work = partial(_histograms, p=p, bins=bins, since=trees[since:], tree=tree, leaves=nodes, share=o["subsamplingRate"],
                                   tag=o["seed"] * 1_000_003 + number)
                    return passes.run([Sums({c: F.col(c) for c in ("y", "f", "draw")}, work)], raw=("bins",))[0]

                made = grow(histograms_of, p, bins, features, o["numLeaves"], o["minInstancesPerNode"], o["lambdaL2"])
                trees.append((*made[:3], [o["stepSize"] * v for v in made[3]]))
                if len(trees) - since >= REFRESH and number + 1 < o["maxIter"]:
                    older, table = table, _refreshed(table, p, trees[since:])
                    older.unpersist()
                    passes, since = Passes(table), len(trees)
        finally:
            table.unpersist()
        #: thresholds as values in place of bins
        valued = [(f, [edges[j][int(t)] if j >= 0 else 0.0 for j, t in zip(f, at)], left, v) for f, at, left, v in trees]
        return LeafwiseModel()._set(start=float(start), trees=json.dumps(valued), featuresCol=o["featuresCol"], predictionCol=o["predictionCol"])


def _edges(rows: DataFrame, p: int, bins: int) -> list[list[float]]:
    """For each feature the values that end its bins, from quantiles; the largest value ends none."""

    def fit():
        probs = tuple(i / bins for i in range(1, bins)) + (1.0,)
        return (yield {str(j): Quantiles(F.get("x", F.lit(j)), probs, exact=False) for j in range(p)})

    found = fit_one(rows, fit())
    return [[e for e in sorted(set(found[str(j)] or [])) if e < found[str(j)][-1]] for j in range(p)]


def _binned(rows: DataFrame, edges: list[list[float]], start: float) -> DataFrame:
    """bins (one byte a feature), y, f (the prediction so far), draw (a number that tells rows apart)."""
    cuts = [np.array(e) for e in edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            packed = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], 1).astype(np.uint8)
            draw = hashed_uniform(np.column_stack([x, y]), 1)
            columns = [pa.array([r.tobytes() for r in packed], pa.binary()), pa.array(y), pa.array(np.full(len(y), start)), pa.array(draw)]
            yield pa.RecordBatch.from_arrays(columns, ["bins", "y", "f", "draw"])

    return rows.select("x", "y").mapInArrow(run, "bins binary, y double, f double, draw double")


def _refreshed(table: DataFrame, p: int, trees: Sequence[Tree]) -> DataFrame:
    """The binned rows with predictions that know ``trees``; its lineage is cut where the cluster names a checkpoint folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.column(2).to_numpy() + predict(trees, _unpacked(batch.column(0), p))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(f), batch.column(3)], ["bins", "y", "f", "draw"])

    made = table.mapInArrow(run, table.schema)
    if table.sparkSession.sparkContext.getCheckpointDir():
        return made.checkpoint().persist(StorageLevel.MEMORY_AND_DISK)
    made = made.persist(StorageLevel.MEMORY_AND_DISK)
    made.count()
    return made


class LeafwiseModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    start = Param(Params._dummy(), "start", "the prediction before the first tree", TypeConverters.toFloat)
    trees = Param(Params._dummy(), "trees", "the trees as JSON", TypeConverters.toString)

    def fitted_trees(self) -> list[Tree]:
        return [tuple(t) for t in json.loads(self.getOrDefault(self.trees))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        start, shared = self.getOrDefault(self.start), dataset.sparkSession.sparkContext.broadcast(self.fitted_trees())

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(start + predict(shared.value, np.stack(x.to_numpy())) if len(x) else [], dtype=float)

        return dataset.withColumn(self.getPredictionCol(), score(vector_to_array(F.col(self.getFeaturesCol()))))
