"""Feature branches: six fitted column groups side by side, then one vector.

``FeatureBranches.fit`` needs as many passes as its deepest branch; ``fit_folds`` learns the
statistics of all k training complements in those same passes. The fitted model is one narrow
projection of the declared columns; every other column is left out of the vector.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import config
from holdfast.functions import expressions as fx
from holdfast.operators import steps as st
from holdfast.operators.knn import KnnImputer, KnnImputerModel
from holdfast.operators.stats import fit_one, fit_together, held, in_step, keep_all, keep_where

BRANCHES = ("geo", "ratios", "heavy", "plain", "categorical", "binned")

#: (branch, {logical name: source column}, steps)
Branch = tuple[str, dict[str, str], list[st.Step]]


def numeric_steps(imputer="median", deskew="none", scaler="standard", exact=True) -> list[st.Step]:
    return [st.Impute(kind=imputer, exact=exact), st.Deskew(kind=deskew), st.Scale(kind=scaler, exact=exact)]


def ratio_steps(imputer="median", scaler="standard", clip=0.001, exact=True, specs=None) -> list[st.Step]:
    """Impute before dividing, clip before scaling: a ratio of a null stays null, and ratios have no bound."""
    return [
        st.Impute(kind=imputer, exact=exact),
        st.Ratios(keep_original=False, specs=specs),
        st.Clip(lower=clip, upper=1.0 - clip, exact=exact),
        st.Scale(kind=scaler, exact=exact),
    ]


def categorical_steps(encoder="onehot", **options) -> list[st.Step]:
    st.one_of("encoder", encoder, st.ENCODERS)
    return [st.ImputeMode(), st.OneHot(**options) if encoder == "onehot" else st.Ordinal(**options)]


def binned_steps(n_bins=5, strategy="quantile", encoder="onehot", exact=True) -> list[st.Step]:
    return [st.Impute(kind="median", exact=exact), st.Bins(n_bins=n_bins, strategy=strategy, encoder=encoder)]


def fit_branch(columns: dict[str, Column], steps: Sequence[st.Step], keep):
    return st.fit_chain(steps, columns, keep)


class ColumnSteps(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Any list of steps over named columns, e.g. one block of the branches on its own."""

    inputCols = Param(Params._dummy(), "inputCols", "source columns", TypeConverters.toListString)
    steps = Param(Params._dummy(), "steps", "steps as [[name, options], ...]")
    keepInputs = Param(Params._dummy(), "keepInputs", "keep the other columns", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, steps=None, keepInputs=True):
        super().__init__()
        self._setDefault(keepInputs=True)
        kwargs = self._input_kwargs
        if steps is not None:
            kwargs["steps"] = st.describe(steps) if isinstance(steps[0], st.Step) else steps
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> "BranchesModel":
        columns = {c: F.col(c) for c in self.getOrDefault(self.inputCols)}
        steps = st.build(self.getOrDefault(self.steps))
        with held(dataset, list(columns)) as dataset:
            states = fit_one(dataset, st.fit_chain(steps, columns, keep_all))
        return BranchesModel()._set(
            branches=[["", {c: c for c in columns}, st.describe(steps), states]],
            keepInputs=self.getOrDefault(self.keepInputs),
        )


class FeatureBranches(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """The whole preprocessing as one estimator; every choice is a Param, so a search can set it."""

    imputer = Param(Params._dummy(), "imputer", "median, mean or iterative", TypeConverters.toString)
    heavyImputer = Param(Params._dummy(), "heavyImputer", "imputer of the heavy branch; empty = imputer", TypeConverters.toString)
    scaler = Param(Params._dummy(), "scaler", "standard, robust, minmax or none", TypeConverters.toString)
    deskew = Param(Params._dummy(), "deskew", "none, log or yeo-johnson", TypeConverters.toString)
    encoder = Param(Params._dummy(), "encoder", "onehot or ordinal", TypeConverters.toString)
    nClusters = Param(Params._dummy(), "nClusters", "geographic centres", TypeConverters.toInt)
    geoStart = Param(Params._dummy(), "geoStart", "centres that k-means begins from; empty: starts of its own", TypeConverters.toList)
    geoRounds = Param(Params._dummy(), "geoRounds", "k-means rounds at most", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "RBF width", TypeConverters.toFloat)
    nBins = Param(Params._dummy(), "nBins", "quantile bins", TypeConverters.toInt)
    clip = Param(Params._dummy(), "clip", "tail share clipped off the ratios", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the k-means starts", TypeConverters.toInt)
    exact = Param(Params._dummy(), "exact", "exact quantiles (else sketches)", TypeConverters.toBoolean)
    keyCols = Param(Params._dummy(), "keyCols", "row key, for knn ties", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "assembled vector", TypeConverters.toString)
    extraCols = Param(Params._dummy(), "extraCols", "columns forced past the whitelist", TypeConverters.toListString)
    geoCols = Param(Params._dummy(), "geoCols", "two coordinates and a weight; empty: no such branch", TypeConverters.toListString)
    ratioSpecs = Param(Params._dummy(), "ratioSpecs", "[[name, numerator, denominator], ...]; empty: no such branch")
    heavyCols = Param(Params._dummy(), "heavyCols", "heavy-tailed columns; empty: no such branch", TypeConverters.toListString)
    plainCols = Param(Params._dummy(), "plainCols", "other numeric columns; empty: no such branch", TypeConverters.toListString)
    categoryCols = Param(Params._dummy(), "categoryCols", "text columns; empty: no such branch", TypeConverters.toListString)
    binnedCols = Param(Params._dummy(), "binnedCols", "numeric columns to bin; empty: no such branch", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, imputer="median", heavyImputer="", scaler="standard", deskew="log", encoder="onehot",
                 nClusters=10, gamma=1.0, nBins=5, clip=0.001, seed=config.RANDOM_SEED, exact=True, keyCols=None,
                 outputCol="features", extraCols=None, geoStart=None, geoRounds=300, geoCols=None, ratioSpecs=None, heavyCols=None, plainCols=None,
                 categoryCols=None, binnedCols=None):
        super().__init__()
        kwargs = dict(self._input_kwargs)
        self._setDefault(imputer="median", heavyImputer="", scaler="standard", deskew="log", encoder="onehot",
                         nClusters=10, gamma=1.0, nBins=5, clip=0.001, seed=config.RANDOM_SEED, exact=True,
                         keyCols=[], outputCol="features", extraCols=[], geoStart=[], geoRounds=300, geoCols=config.GEO_COLUMNS,
                         ratioSpecs=[list(r) for r in config.RATIOS], heavyCols=config.HEAVY_TAILED_COLUMNS,
                         plainCols=config.PLAIN_COLUMNS, categoryCols=config.CATEGORICAL_COLUMNS, binnedCols=config.BINNED_COLUMNS)
        self._set(**{k: v for k, v in kwargs.items() if v is not None})

    def branches(self) -> list[Branch]:
        p = {param.name: self.getOrDefault(param) for param in self.params}
        exact, heavy = p["exact"], p["heavyImputer"] or p["imputer"]
        st.one_of("imputer", heavy, st.IMPUTERS)

        def same(names):
            return {c: c for c in names}

        def imputed(names, kind):
            return {c: f"{_KNN}{c}" for c in names} if kind == "knn" else same(names)

        def first(kind):
            return "median" if kind == "knn" else kind

        specs = [tuple(r) for r in p["ratioSpecs"]]
        geo = st.Geo(n_clusters=p["nClusters"], gamma=p["gamma"], seed=p["seed"], max_iter=p["geoRounds"], start=[list(c) for c in p["geoStart"]] or None)
        divided = self._ratio_sources()
        out = [
            ("geo", same(p["geoCols"]), [geo]),
            ("ratios", imputed(divided, p["imputer"]), ratio_steps(first(p["imputer"]), p["scaler"], p["clip"], exact, specs)),
            ("heavy", imputed(p["heavyCols"], heavy), numeric_steps(first(heavy), p["deskew"], p["scaler"], exact)),
            ("plain", same(p["plainCols"]), numeric_steps(first(p["imputer"]), "none", p["scaler"], exact)),
            ("categorical", same(p["categoryCols"]), categorical_steps(p["encoder"], **self._known_order())),
            ("binned", same(p["binnedCols"]), binned_steps(p["nBins"], "quantile", p["encoder"], exact)),
            ("extra", same(p["extraCols"]), []),
        ]
        return [branch for branch in out if branch[1]]

    def _ratio_sources(self) -> list[str]:
        """The columns that ratios divide, in the order of the heavy-tailed ones where they are among them."""
        used = {c for _, *pair in self.getOrDefault(self.ratioSpecs) for c in pair}
        heavy = self.getOrDefault(self.heavyCols)
        return [c for c in heavy if c in used] + sorted(used - set(heavy))

    def _known_order(self) -> dict:
        """The declared order of levels holds for the contract's own column only; other columns learn theirs."""
        own = list(self.getOrDefault(self.categoryCols)) == config.CATEGORICAL_COLUMNS
        return {} if own or self.getOrDefault(self.encoder) == "onehot" else {"declared": False}

    @property
    def uses_knn(self) -> bool:
        return "knn" in (self.getOrDefault(self.imputer), self.getOrDefault(self.heavyImputer))

    def _fit(self, dataset: DataFrame) -> "BranchesModel":
        branches = self.branches()
        _check_columns(dataset, branches)
        with held(dataset, [*_sources(branches), *self.getOrDefault(self.keyCols)]) as dataset:
            return self._fit_held(dataset, branches)

    def _fit_held(self, dataset: DataFrame, branches: Sequence[Branch]) -> "BranchesModel":
        knn = None
        if self.uses_knn:
            knn = KnnImputer(
                inputCols=list(dict.fromkeys([*self.getOrDefault(self.heavyCols), *self._ratio_sources()])), keyCols=self.getOrDefault(self.keyCols), prefix=_KNN
            ).fit(dataset)
            dataset = knn.transform(dataset)
        return self._model(branches, fit_one(dataset, _fit_all(branches, keep_all)), knn)

    def fit_folds(self, dataset: DataFrame, fold: str, n_splits: int) -> list["BranchesModel"]:
        """One model per fold, each learned from the rows outside it, all in the same passes."""
        return self.fit_sides_together([(self, range(n_splits))], dataset, fold)[0]

    @staticmethod
    def fit_folds_together(many: Sequence["FeatureBranches"], dataset: DataFrame, fold: str, n_splits: int) -> list[list["BranchesModel"]]:
        """``fit_folds`` of several settings in the same passes; a branch that is the same in some of them is fitted once."""
        return FeatureBranches.fit_sides_together([(one, range(n_splits)) for one in many], dataset, fold)

    @staticmethod
    def fit_sides_together(asked: Sequence[tuple["FeatureBranches", Sequence[int | None]]], dataset: DataFrame, fold: str) -> list[list["BranchesModel"]]:
        """For each setting one model per side, all in the same passes: side i are the rows outside fold i, None all rows."""
        fits, wanted = {}, []
        for one, sides in asked:
            if one.uses_knn:
                wanted.append(None)
                continue
            branches = one.branches()
            _check_columns(dataset, branches)
            keys = {name: json.dumps([sources, [[n, {k: v for k, v in o.items() if k != "gamma"}] for n, o in st.describe(steps)]]) for name, sources, steps in branches}
            for name, sources, steps in branches:
                for i in sides:
                    made = (steps, {c: F.col(s) for c, s in sources.items()}, keep_all if i is None else keep_where(F.col(fold) != i))
                    fits.setdefault((keys[name], i), made)
            wanted.append((branches, keys))
        found = {}
        if fits:
            sources = [s for w in wanted if w for s in _sources(w[0])]
            with held(dataset, [*sources, fold]) as narrow:
                found = dict(zip(fits, fit_together(narrow, [st.fit_chain(*made) for made in fits.values()])))
        return [
            [one._model(w[0], {name: found[key, i] for name, key in w[1].items()}, None) for i in sides] if w
            else [one.fit(dataset if i is None else dataset.where(F.col(fold) != i)) for i in sides]
            for (one, sides), w in zip(asked, wanted)
        ]

    def _model(self, branches, found, knn) -> "BranchesModel":
        model = BranchesModel(knn)._set(
            branches=[[name, sources, st.describe(steps), found[name]] for name, sources, steps in branches],
            outputCol=self.getOrDefault(self.outputCol),
            keepInputs=True,
        )
        return model


_KNN = "__knn_"


def _fit_all(branches: Sequence[Branch], keep):
    return in_step({
        name: st.fit_chain(steps, {c: F.col(s) for c, s in sources.items()}, keep) for name, sources, steps in branches
    })


def _sources(branches: Sequence[Branch]) -> list[str]:
    names = [s.removeprefix(_KNN) for _, sources, _ in branches for s in sources.values()]
    return list(dict.fromkeys(names))


def _check_columns(df: DataFrame, branches: Sequence[Branch]) -> None:
    for name, sources, _ in branches:
        absent = [c for c in sources if c not in df.columns]
        if absent:
            raise ValueError(f"branch {name!r} needs column(s) {absent}; got {df.columns}")


class BranchesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted branches: a projection of literals, plus the assembled vector when it has a name."""

    branches = Param(Params._dummy(), "branches", "[[name, sources, steps, states], ...]")
    outputCol = Param(Params._dummy(), "outputCol", "assembled vector; empty = plain columns", TypeConverters.toString)
    keepInputs = Param(Params._dummy(), "keepInputs", "keep the other columns", TypeConverters.toBoolean)

    def __init__(self, knn: KnnImputerModel | None = None):
        super().__init__()
        self._setDefault(outputCol="", keepInputs=True)
        self.knn = knn

    def feature_columns(self) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for name, sources, specs, states in self.getOrDefault(self.branches):
            columns = {c: F.col(f"`{s}`") for c, s in sources.items()}
            made = st.apply_chain(st.build(specs), states, columns)
            out.update({f"{name}__{c}" if name else c: x for c, x in made.items()})
        return dict(zip(fx.safe_names(list(out)), out.values()))

    def feature_names(self) -> list[str]:
        """The names the model sees, in order."""
        return list(self.feature_columns())

    def state_of(self, branch: str, step: int = 0):
        for name, _, _, states in self.getOrDefault(self.branches):
            if name == branch:
                return states[step]
        raise KeyError(branch)

    def feature_frame(self, dataset: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The named feature columns themselves, beside the columns to keep."""
        if self.knn is not None:
            dataset = self.knn.transform(dataset)
        return dataset.select(*keep, *[x.alias(n) for n, x in self.feature_columns().items()])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.knn is not None:
            dataset = self.knn.transform(dataset)
        made = self.feature_columns()
        output = self.getOrDefault(self.outputCol)
        if not output:
            kept = [c for c in dataset.columns if c not in made] if self.getOrDefault(self.keepInputs) else []
            return dataset.select(*[F.col(f"`{c}`") for c in kept], *[x.alias(n) for n, x in made.items()])
        kept = [c for c in dataset.columns if not c.startswith(_KNN)]
        wide = dataset.select(*[F.col(f"`{c}`") for c in kept], *[x.alias(n) for n, x in made.items()])
        vector = VectorAssembler(inputCols=list(made), outputCol=output, handleInvalid="error")
        return vector.transform(wide).select(*[F.col(f"`{c}`") for c in kept], output)

    def write(self):
        return _BranchesWriter(self)

    @classmethod
    def read(cls):
        return _BranchesReader(cls)


class _BranchesWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.knn is not None:
            self.instance.knn.write().overwrite().save(f"{path}/knn")


class _BranchesReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        if any(s.startswith(_KNN) for _, sources, _, _ in model.getOrDefault(model.branches) for s in sources.values()):
            model.knn = KnnImputerModel.load(f"{path}/knn")
        return model


class SanitiseNames(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Rename columns so that every consumer accepts them; collisions are refused."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return fx.sanitise_names(dataset)


def feature_names(fitted) -> list[str]:
    """Names behind the vector of a fitted model or of a fitted chain that starts with one."""
    stages = getattr(fitted, "stages", [fitted])
    return next(s for s in stages if isinstance(s, BranchesModel)).feature_names()
