"""Nearest-neighbour imputation as an exact distributed join, without comparing all pairs.

Donor points are laid into the leaves of a k-d tree cut from a bounded sample. A query first meets
the donors of its own leaf; the distance to its k-th neighbour there bounds the search, and only
leaves whose box reaches into that ball are visited next. Copies are folded first: at most k donors
per distinct point, and one query per distinct point, so hot points cost nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.keys import key_text

LEAF_ROWS = 1024
MAX_LEAVES = 1 << 16
SAMPLE_PER_LEAF = 16


class SpaceTree:
    """Median splits of a sample of points: a plain array tree with 2^depth leaves."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis = np.zeros((1 << depth) - 1, dtype=np.int64)
        self.value = np.zeros((1 << depth) - 1)
        members = {0: points}
        for node in range((1 << depth) - 1):
            inside = members.pop(node)
            if len(inside):
                self.axis[node] = int(np.argmax(inside.max(0) - inside.min(0)))
                self.value[node] = np.median(inside[:, self.axis[node]])
            right = inside[:, self.axis[node]] > self.value[node]
            members[2 * node + 1], members[2 * node + 2] = inside[~right], inside[right]

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[rows, self.axis[node]] > self.value[node])
        return node - ((1 << self.depth) - 1)


def neighbours(
    queries: DataFrame, donors: DataFrame, dims: Sequence[str], k: int, scale: float, donor_rows: int
) -> DataFrame:
    """(dims, d, donor, value): the k nearest donors of every distinct query point.

    ``donors`` holds dims, ``donor`` (order text) and ``value``; ties go to the smaller donor text.
    """
    at_point = Window.partitionBy(*dims).orderBy("donor")
    donors = donors.withColumn("__n", F.row_number().over(at_point)).where(F.col("__n") <= k).drop("__n")
    depth = min(max(int(np.ceil(np.log2(max(donor_rows, 1) / LEAF_ROWS))), 0), MAX_LEAVES.bit_length() - 1)
    every = max(donor_rows // (SAMPLE_PER_LEAF << depth), 1)
    if depth:
        sample = donors.where(F.pmod(F.xxhash64("donor"), F.lit(every)) == 0).select(*dims)
        tree = SpaceTree(sample.limit(2 * SAMPLE_PER_LEAF << depth).toPandas().to_numpy(dtype=float), depth)
    else:
        tree = SpaceTree(np.zeros((0, len(dims))), 0)
    leaf = _leaf_udf(tree)
    point = F.array(*[F.col(c) for c in dims])
    placed = donors.withColumn("leaf", leaf(point))
    boxes = placed.groupBy("leaf").agg(
        *[f(c).alias(f"{n}{i}") for i, c in enumerate(dims) for n, f in (("lo", F.min), ("hi", F.max))]
    ).toPandas()
    reach = _reach_udf(
        boxes["leaf"].to_numpy(dtype=np.int64),
        boxes[[f"lo{i}" for i in range(len(dims))]].to_numpy(dtype=float),
        boxes[[f"hi{i}" for i in range(len(dims))]].to_numpy(dtype=float),
        scale,
    )
    asked = queries.select(*dims).distinct().select(*[F.col(c).alias(f"q{i}") for i, c in enumerate(dims)])
    asked_point = F.array(*[F.col(f"q{i}") for i in range(len(dims))])
    asked = asked.withColumn("home", leaf(asked_point))
    point_columns = [f"q{i}" for i in range(len(dims))]
    total = reduce(lambda a, b: a + b, [(F.col(c) - F.col(q)) * (F.col(c) - F.col(q)) for c, q in zip(dims, point_columns)])
    distance = F.sqrt(F.lit(scale) * total)
    nearest = Window.partitionBy(*point_columns).orderBy("d", "donor")

    def meet(points: DataFrame) -> DataFrame:
        met = points.join(placed, "leaf").withColumn("d", distance)
        if "radius" in points.columns:
            met = met.where(F.col("d") <= F.col("radius"))
        return met.select(*point_columns, "d", "donor", "value")

    def closest(found: DataFrame) -> DataFrame:
        return found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k)

    first = closest(meet(asked.withColumn("leaf", F.col("home"))))
    radius = first.groupBy(*point_columns).agg(F.max(F.when(F.col("place") == k, F.col("d"))).alias("radius"))
    wider = (
        asked.join(radius, point_columns, "left")
        .withColumn("radius", F.coalesce("radius", F.lit(float("inf"))))
        .withColumn("leaf", F.explode(reach(asked_point, F.col("radius"), F.col("home"))))
    )
    # Pairs beyond the radius end in the join: what is sorted afterwards is about k rows per query.
    found = closest(first.drop("place").unionByName(meet(wider.select(*point_columns, "leaf", "radius"))))
    return found.select(*[F.col(q).alias(c) for q, c in zip(point_columns, dims)], "d", "donor", "value")


def _leaf_udf(tree: SpaceTree):
    @F.pandas_udf("bigint")
    def leaf(points: pd.Series) -> pd.Series:
        return pd.Series(tree.leaf(np.stack(points.to_numpy()).astype(float)) if len(points) else [], dtype="int64")

    return leaf


def _reach_udf(leaves: np.ndarray, low: np.ndarray, high: np.ndarray, scale: float):
    @F.pandas_udf("array<bigint>")
    def reach(points: pd.Series, radius: pd.Series, home: pd.Series) -> pd.Series:
        out = []
        for point, r, own in zip(points, radius, home):
            gap = np.maximum(np.maximum(low - point, point - high), 0.0)
            # A hair wider than the radius: rounding must not lose a tied neighbour.
            near = np.sqrt(scale * (gap * gap).sum(1)) <= r * (1 + 1e-9)
            out.append(leaves[near & (leaves != own)])
        return pd.Series(out)

    return reach


class _KnnParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns that share the distance", TypeConverters.toListString)
    keyCols = Param(Params._dummy(), "keyCols", "columns that identify a row", TypeConverters.toListString)
    nNeighbors = Param(Params._dummy(), "nNeighbors", "neighbours to average", TypeConverters.toInt)
    prefix = Param(Params._dummy(), "prefix", "prefix of the output columns", TypeConverters.toString)


class KnnImputer(Estimator, _KnnParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill nulls with the inverse-distance mean of the nearest training rows that hold a value.

    Distance is Euclidean over the columns both rows hold, scaled up for the missing ones. It runs
    before any scaling, so the widest column dominates it.
    """

    def __init__(self, *, inputCols=None, keyCols=None, nNeighbors=5, prefix=""):
        super().__init__()
        self._setDefault(nNeighbors=5, prefix="")
        self._set(inputCols=inputCols or [], keyCols=keyCols or [], nNeighbors=nNeighbors, prefix=prefix)

    def _fit(self, dataset: DataFrame) -> "KnnImputerModel":
        names = self.getOrDefault(self.inputCols)
        donors = dataset.select(
            key_text(*[F.col(k) for k in self.getOrDefault(self.keyCols)]).alias("donor"),
            *[F.col(c).cast("double").alias(c) for c in names],
        )
        means = donors.agg(*[F.avg(c).alias(c) for c in names]).first().asDict()
        empty = [c for c, v in means.items() if v is None]
        if empty:
            raise ValueError(f"cannot impute {empty}: no training row holds a value")
        patterns = [tuple(r)[:-1] + (r["count"],) for r in _patterns(donors, names).collect()]
        model = KnnImputerModel(donors=donors)
        self._copyValues(model)
        model._set(state={"means": means, "patterns": patterns})
        return model


class KnnImputerModel(Model, _KnnParams, DefaultParamsReadable, DefaultParamsWritable):
    """Holds the donor rows as a DataFrame; saved beside the parameters as parquet."""

    state = Param(Params._dummy(), "state", "column means and null patterns of the donors")

    def __init__(self, donors: DataFrame | None = None):
        super().__init__()
        self._setDefault(nNeighbors=5, prefix="")
        self.donors = donors

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names, prefix = self.getOrDefault(self.inputCols), self.getOrDefault(self.prefix)
        k = self.getOrDefault(self.nNeighbors)
        state = self.getOrDefault(self.state)
        rows = dataset.withColumns({f"{prefix}{c}": F.col(c).cast("double") for c in names})
        any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in names])
        holed = rows.where(any_null)
        result = rows.where(~any_null)
        for pattern in _patterns(holed, names).collect():
            null_of = dict(zip(names, tuple(pattern)[:-1]))
            part = holed.where(reduce(lambda a, b: a & b, [
                F.col(c).isNull() if null_of[c] else F.col(c).isNotNull() for c in names
            ]))
            known = [c for c in names if not null_of[c]]
            for target in [c for c in names if null_of[c]]:
                part = self._fill(part, target, known, names, k, state, f"{prefix}{target}")
            result = result.unionByName(part)
        return result

    def _fill(self, part: DataFrame, target, known, names, k, state, output) -> DataFrame:
        found = None
        for pattern in state["patterns"]:
            null_of, count = dict(zip(names, pattern[:-1])), pattern[-1]
            dims = [c for c in known if not null_of[c]]
            if null_of[target] or not dims:
                continue
            donors = self.donors.where(reduce(lambda a, b: a & b, [
                F.col(c).isNull() if null_of[c] else F.col(c).isNotNull() for c in names
            ])).select("donor", F.col(target).alias("value"), *dims)
            near = neighbours(part, donors, dims, k, len(names) / len(dims), count)
            if dims != known:
                near = part.select(*known).distinct().join(near, dims)
            near = near.select(*known, "d", "donor", "value")
            found = near if found is None else found.unionByName(near)
        fallback = F.lit(float(state["means"][target]))
        if found is None:
            return part.withColumn(output, fallback)
        nearest = Window.partitionBy(*known).orderBy("d", "donor")
        zero = F.col("d") == 0
        weight = F.when(F.col("touch") > 0, zero.cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("d")))
        best = (
            found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k)
            .withColumn("touch", F.sum(zero.cast("int")).over(Window.partitionBy(*known)))
            .groupBy(*known)
            .agg((F.sum(weight * F.col("value")) / F.sum(weight)).alias("__guess"))
        )
        return part.join(best, known, "left").withColumn(output, F.coalesce("__guess", fallback)).drop("__guess")

    def write(self):
        return _KnnWriter(self)

    @classmethod
    def read(cls):
        return _KnnReader(cls)


class _KnnWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.donors.write.mode("overwrite").parquet(f"{path}/donors")


class _KnnReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.donors = self.sparkSession.read.parquet(f"{path}/donors")
        return model


def _patterns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Null patterns with their row counts: at most 2^columns groups."""
    return df.groupBy(*[F.col(c).isNull().alias(c) for c in names]).count()


