"""Feature steps: each fits a small state from aggregates and applies it as a projection.

``fit(columns, keep)`` is a generator for ``operators.stats``; ``keep`` masks the rows the fit may
see. ``apply(state, columns)`` maps named column expressions to named column expressions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from holdfast import config
from holdfast.errors import DomainError, UnsafeEncoderError
from holdfast.functions import expressions as fx
from holdfast.operators.clusters import fit_kmeans
from holdfast.operators.line import fit_line_kmeans
from holdfast.operators.stats import Agg, FitSteps, Levels, Quantiles, Spread, in_step, sql_double

Columns = dict[str, Column]
Keep = Callable[[Column], Column]

IMPUTERS = ("median", "mean", "knn", "iterative")
DESKEWERS = ("none", "log", "yeo-johnson")
SCALERS = ("standard", "robust", "minmax", "none")
ENCODERS = ("onehot", "ordinal")
BIN_STRATEGIES = ("quantile", "uniform", "kmeans")


def one_of(what: str, value: str, allowed: Sequence[str]) -> str:
    if value not in allowed:
        raise ValueError(f"Unknown {what} {value!r}; expected one of {tuple(allowed)}")
    return value


class Step:
    """Base: options are plain JSON values, so a step can be stored and rebuilt."""

    defaults: dict[str, Any] = {}

    def __init__(self, **options):
        unknown = set(options) - set(self.defaults)
        if unknown:
            raise ValueError(f"{type(self).__name__} has no option {sorted(unknown)}")
        self.options = {**self.defaults, **options}
        self.check()

    def check(self) -> None:
        """Refuse options that cannot work, before any data is read."""

    def fit(self, columns: Columns, keep: Keep) -> FitSteps:
        return {}
        yield  # a generator with nothing to ask for

    def apply(self, state: dict, columns: Columns) -> Columns:
        return columns


def fit_chain(steps: Sequence[Step], columns: Columns, keep: Keep) -> FitSteps:
    """Fit steps left to right, each on the output of the one before; returns their states."""
    states = []
    for step in steps:
        state = yield from step.fit(columns, keep)
        columns = step.apply(state, columns)
        states.append(state)
    return states


def apply_chain(steps: Sequence[Step], states: Sequence[dict], columns: Columns) -> Columns:
    for step, state in zip(steps, states):
        columns = step.apply(state, columns)
    return columns


# --- imputation ----------------------------------------------------------------


class Impute(Step):
    """Fill nulls with the training median or mean, or by chained regressions."""

    defaults = {"kind": "median", "exact": True, "max_iter": 10, "tol": 1e-3}

    def check(self):
        one_of("imputer", self.options["kind"], IMPUTERS)

    def fit(self, columns, keep):
        kind = self.options["kind"]
        if kind == "iterative":
            return (yield from _fit_iterative(columns, keep, self.options["max_iter"], self.options["tol"]))
        if kind == "knn":
            raise ValueError("knn imputation joins to donor rows: use holdfast.operators.knn")
        if kind == "median":
            found = yield {c: Quantiles(keep(x), (0.5,), exact=self.options["exact"]) for c, x in columns.items()}
            fill = {c: v[0] if v else None for c, v in found.items()}
        else:
            found = yield {"mean": Agg({c: F.avg(keep(x)) for c, x in columns.items()})}
            fill = found["mean"]
        empty = [c for c, v in fill.items() if v is None]
        if empty:
            raise ValueError(f"cannot impute {empty}: no training row holds a value")
        return {"fill": fill}

    def apply(self, state, columns):
        if self.options["kind"] == "iterative":
            return _apply_iterative(state, columns)
        return {c: F.coalesce(x, F.lit(state["fill"][c])) for c, x in columns.items()}


class ImputeMode(Step):
    """Fill nulls of text columns with the most frequent value, ties to the smallest."""

    def fit(self, columns, keep):
        found = yield {c: Levels(keep(x), top=1) for c, x in columns.items()}
        return {"fill": {c: v[0][0] if v else None for c, v in found.items()}}

    def apply(self, state, columns):
        return {c: F.coalesce(x, F.lit(state["fill"][c])) for c, x in columns.items()}


def _fit_iterative(columns: Columns, keep: Keep, max_iter: int, tol: float) -> FitSteps:
    """Chained Bayesian ridge regressions on moment matrices.

    Start from means; visit the columns with the fewest nulls first; regress each on all others over
    the rows that hold it, refill it, go round again until no row moves by more than the tolerance.
    A visit is one aggregation of moments; columns without nulls change nothing, so they share one.
    """
    names = list(columns)
    first = yield {
        "nulls": Agg({c: F.count(keep(F.when(x.isNull(), 1))) for c, x in columns.items()}),
        "mean": Agg({c: F.avg(keep(x)) for c, x in columns.items()}),
        "size": Agg({c: F.max(F.abs(keep(x))) for c, x in columns.items()}),
    }
    empty = [c for c, v in first["mean"].items() if v is None]
    if empty:
        raise ValueError(f"cannot impute {empty}: no training row holds a value")
    order = sorted(names, key=lambda c: (first["nulls"][c], names.index(c)))
    holes = [c for c in order if first["nulls"][c]]
    together = order[: len(order) - max(len(holes) - 1, 0)]
    visits = [together, *[[c] for c in order[len(together):]]]
    state = {"mean": first["mean"], "visits": []}
    limit = tol * max(first["size"].values())
    before = _apply_iterative(state, columns)
    for _ in range(max_iter):
        for targets in visits:
            filled = _apply_iterative(state, columns)
            moments = yield {
                t: Agg(_moments(columns[t], [filled[c] for c in names if c != t], keep)) for t in targets
            }
            for t in targets:
                coef, intercept = _bayesian_ridge(moments[t], len(names) - 1)
                coef.insert(names.index(t), 0.0)
                state["visits"].append({"target": names.index(t), "coef": coef, "intercept": intercept})
        if max_iter == 1 or not holes:
            break
        after = _apply_iterative(state, columns)
        moved = F.lit(0.0)
        for c in holes:
            moved = moved + F.abs(after[c] - before[c])
        step = yield {"d": Agg({"d": F.max(keep(moved))})}
        if (step["d"]["d"] or 0.0) < limit:
            break
        before = after
    return state


def _moments(y: Column, xs: Sequence[Column], keep: Keep) -> dict[str, Column]:
    """Means and centred second moments over the rows that hold the target."""
    inside = [keep(F.when(y.isNotNull(), x)) for x in [*xs, y]]
    out = {"n": F.count(inside[-1])}
    for i, a in enumerate(inside):
        out[f"m{i}"] = F.avg(a)
        for j in range(i, len(inside)):
            out[f"c{i}_{j}"] = F.covar_pop(a, inside[j])
    return out


def _bayesian_ridge(m: dict[str, float], p: int, max_iter: int = 300, tol: float = 1e-3):
    """Evidence-maximising ridge from moments, with the usual weak gamma priors (all 1e-6)."""
    n = m["n"]
    full = np.array([[m[f"c{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(p + 1)] for i in range(p + 1)]) * n
    gram, cross, total = full[:p, :p], full[:p, p], full[p, p]
    values, vectors = np.linalg.eigh(gram)
    values = np.clip(values, 0.0, None)
    rotated = vectors.T @ cross
    prior = 1e-6
    alpha, lam = 1.0 / (total / n + np.finfo(float).eps), 1.0
    previous = None
    coef = np.zeros(p)
    for _ in range(max_iter):
        coef = vectors @ (rotated / (values + lam / alpha))
        error = max(total - 2 * coef @ cross + coef @ gram @ coef, 0.0)
        effective = float(np.sum(alpha * values / (lam + alpha * values)))
        lam = (effective + 2 * prior) / (coef @ coef + 2 * prior)
        alpha = (n - effective + 2 * prior) / (error + 2 * prior)
        if previous is not None and np.abs(previous - coef).sum() < tol:
            break
        previous = coef
    coef = vectors @ (rotated / (values + lam / alpha))
    means = [m[f"m{i}"] or 0.0 for i in range(p + 1)]
    return [float(c) for c in coef], float(means[p] - sum(c * v for c, v in zip(coef, means)))


def _apply_iterative(state: dict, columns: Columns) -> Columns:
    """Replay the visits on rows that hold a null, as a fold over an array of visits."""
    names = list(columns)
    start = F.array(*[F.coalesce(x, F.lit(float(state["mean"][c]))) for c, x in columns.items()])
    known = F.array(*[x.isNotNull() for x in columns.values()])
    row = start
    if state["visits"]:
        visits = F.array(*[
            F.struct(
                F.lit(v["target"]).alias("target"),
                F.array(*[F.lit(float(c)) for c in v["coef"]]).alias("coef"),
                F.lit(float(v["intercept"])).alias("intercept"),
            )
            for v in state["visits"]
        ])

        def visit(values: Column, v: Column) -> Column:
            terms = F.zip_with(values, v["coef"], lambda a, b: a * b)
            guess = v["intercept"] + F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
            return F.transform(
                values, lambda old, i: F.when((i == v["target"]) & ~F.get(known, i), guess).otherwise(old)
            )

        row = F.aggregate(visits, start, visit)
    return {c: F.coalesce(x, F.get(row, F.lit(i))) for i, (c, x) in enumerate(columns.items())}


# --- de-skew, scale, clip, ratios ------------------------------------------------


class Deskew(Step):
    """``log`` (guarded log1p), ``yeo-johnson`` (fitted lambda) or ``none``."""

    defaults = {"kind": "none", "points": 17, "rounds": 4}

    def check(self):
        one_of("deskew", self.options["kind"], DESKEWERS)

    def fit(self, columns, keep):
        if self.options["kind"] == "log":
            found = yield {"low": Agg({c: F.min(keep(x)) for c, x in columns.items()})}
            bad = {c: v for c, v in found["low"].items() if v is not None and v <= -1.0}
            if bad:
                raise DomainError(
                    "log1p is undefined at or below -1; use deskew 'none' or 'yeo-johnson' for: "
                    + "; ".join(f"{c} (min {v:.4g})" for c, v in bad.items())
                )
        if self.options["kind"] == "yeo-johnson":
            fits = {c: _fit_lambda(x, keep, self.options["points"], self.options["rounds"]) for c, x in columns.items()}
            return {"lambda": (yield from in_step(fits))}
        return {}

    def apply(self, state, columns):
        if self.options["kind"] == "log":
            return {c: fx.guarded_log1p(x, c) for c, x in columns.items()}
        if self.options["kind"] == "yeo-johnson":
            return {c: fx.yeo_johnson(x, state["lambda"][c]) for c, x in columns.items()}
        return columns

    def invert(self, columns: Columns) -> Columns:
        """The declared inverse of the log step."""
        return {c: F.expm1(x) for c, x in columns.items()} if self.options["kind"] == "log" else columns


def log_likelihood(n: float, variance: float, signed_log: float, lam: float) -> float:
    """Yeo-Johnson profile log-likelihood from its three sufficient statistics."""
    return -n / 2.0 * math.log(variance) + (lam - 1.0) * signed_log


def _fit_lambda(x: Column, keep: Keep, points: int, rounds: int) -> FitSteps:
    """Maximum likelihood: a grid of lambdas per pass, narrowed round the best, then a parabola."""
    x = keep(x)
    basics = yield {"b": Agg({
        "n": F.count(x), "s": F.sum(F.signum(x) * F.log1p(F.abs(x))), "low": F.min(x), "high": F.max(x),
    })}
    b = basics["b"]
    if not b["n"] or b["low"] == b["high"]:
        return 1.0
    low, high = -2.0, 2.0
    for done in range(rounds + 20):
        step = (high - low) / (points - 1)
        grid = [low + step * i for i in range(points)]
        spread = yield {"v": Spread(x, tuple(grid), fx.yeo_johnson)}
        score = [
            log_likelihood(b["n"], v, b["s"], lam) if v else -math.inf for v, lam in zip(spread["v"], grid)
        ]
        best = max(range(points), key=score.__getitem__)
        if best in (0, points - 1):
            # The top lies outside the bracket: slide it there at the same width.
            shift = (high - low) * (0.75 if best else -0.75)
            low, high = low + shift, high + shift
            continue
        if done >= rounds - 1:
            a, c, d = score[best - 1], score[best], score[best + 1]
            bend = a - 2 * c + d
            return grid[best] + (0.5 * step * (a - d) / bend if bend < 0 else 0.0)
        low, high = grid[best - 1], grid[best + 1]
    return (low + high) / 2.0


class Scale(Step):
    """(x - center) / scale: ``standard`` (population deviation), ``robust``, ``minmax`` or ``none``."""

    defaults = {"kind": "standard", "exact": True}

    def check(self):
        one_of("scaler", self.options["kind"], SCALERS)

    def fit(self, columns, keep):
        kind = self.options["kind"]
        if kind == "none":
            return {}
        if kind == "robust":
            found = yield {
                c: Quantiles(keep(x), (0.25, 0.5, 0.75), exact=self.options["exact"]) for c, x in columns.items()
            }
            found = {c: v or (0.0, 0.0, 0.0) for c, v in found.items()}
            return {
                "center": {c: v[1] for c, v in found.items()},
                "scale": {c: v[2] - v[0] for c, v in found.items()},
            }
        asked = {"low": F.min, "high": F.max, **({"mean": F.avg, "deviation": F.stddev_pop} if kind == "standard" else {})}
        found = yield {c: Agg({k: f(keep(x)) for k, f in asked.items()}) for c, x in columns.items()}
        found = {c: {k: v or 0.0 for k, v in one.items()} for c, one in found.items()}
        center, scale = {c: v["low"] for c, v in found.items()}, {c: v["high"] - v["low"] for c, v in found.items()}
        if kind == "standard":
            # A column of one value has no scale, whatever its mean and deviation are when merged by parts.
            center = {c: v["mean"] if scale[c] else center[c] for c, v in found.items()}
            scale = {c: v["deviation"] if scale[c] else 0.0 for c, v in found.items()}
        return {"center": center, "scale": scale}

    def apply(self, state, columns):
        if self.options["kind"] == "none":
            return columns
        return {c: fx.rescale(x, state["center"][c], state["scale"][c]) for c, x in columns.items()}


class Clip(Step):
    """Winsorise at training quantiles; 0 and 1 are the training minimum and maximum."""

    defaults = {"lower": 0.001, "upper": 0.999, "exact": True}

    def check(self):
        low, high = self.options["lower"], self.options["upper"]
        if not (0.0 <= low < high <= 1.0):
            raise ValueError(f"clip bounds must satisfy 0 <= lower < upper <= 1, not {low} and {high}")

    def fit(self, columns, keep):
        probs = (self.options["lower"], self.options["upper"])
        found = yield {c: Quantiles(keep(x), probs, exact=self.options["exact"]) for c, x in columns.items()}
        return {"bounds": found}

    def apply(self, state, columns):
        bounds = state["bounds"]
        return {c: fx.clip(x, *bounds[c]) if bounds[c] else x for c, x in columns.items()}


class Ratios(Step):
    """Engineered ratios, added to or in place of their inputs."""

    defaults = {"keep_original": True, "specs": None}

    def apply(self, state, columns):
        return fx.ratios(columns, self.options["specs"], keep_original=self.options["keep_original"])


# --- categories --------------------------------------------------------------------


class OneHot(Step):
    """Indicator columns in level order; rare levels share a last column, where unknowns go too.

    Without a rare level there is no such column and an unknown row is all zeros.
    ``handle_unknown='error'`` refuses unknowns at run time and alone permits ``drop='first'``.
    """

    defaults = {"handle_unknown": "infrequent_if_exist", "min_frequency": 10, "drop": None}

    def check(self):
        unknown, drop = self.options["handle_unknown"], self.options["drop"]
        one_of("handle_unknown", unknown, ("infrequent_if_exist", "ignore", "error"))
        if drop is not None:
            one_of("drop", drop, ("first",))
            if unknown != "error":
                raise UnsafeEncoderError(
                    f"drop={drop!r} with handle_unknown={unknown!r}: an unknown category would get the "
                    "same vector as the dropped level. Use drop=None, or handle_unknown='error'."
                )

    def fit(self, columns, keep):
        limit = self.options["min_frequency"] or 0
        totals = yield {c: Agg({"n": F.count(keep(x))}) for c, x in columns.items()}
        least = {c: limit * totals[c]["n"] if isinstance(limit, float) else limit for c in columns}
        if self.options["handle_unknown"] == "infrequent_if_exist":
            # Whatever isn't frequent goes to the last column, so rare levels need not be known by name.
            found = yield {c: Levels(keep(x), least=least[c]) for c, x in columns.items()}
            return {
                c: {"frequent": [v for v, _ in counts], "rare": sum(n for _, n in counts) < totals[c]["n"]} for c, counts in found.items()
            }
        found = yield {c: Levels(keep(x)) for c, x in columns.items()}
        return {
            c: {"frequent": [v for v, n in counts if n >= least[c]], "rare": [v for v, n in counts if n < least[c]]}
            for c, counts in found.items()
        }

    def apply(self, state, columns):
        out = {}
        for c, x in columns.items():
            frequent, rare = state[c]["frequent"], state[c]["rare"]
            if self.options["handle_unknown"] == "error":
                message = F.concat(F.lit(f"unknown category in {c}: "), F.coalesce(x.cast("string"), F.lit("null")))
                x = F.when(F.coalesce(x.isin(frequent + rare), F.lit(False)), x).otherwise(F.raise_error(message))
            for level in frequent[1 if self.options["drop"] else 0:]:
                out[f"{c}_{level}"] = F.coalesce(x == level, F.lit(False)).cast("double")
            if rare:
                hit = ~F.coalesce(x.isin(frequent), F.lit(False))
                if self.options["handle_unknown"] == "ignore":
                    hit = F.coalesce(x.isin(rare), F.lit(False))
                out[f"{c}_infrequent_sklearn"] = hit.cast("double")
        return out


class Ordinal(Step):
    """Codes 0, 1, 2, ... from a declared order, or from the sorted training levels; unknown is -1."""

    defaults = {"categories": None, "declared": True}

    def fit(self, columns, keep):
        if self.options["declared"]:
            order = self.options["categories"] or config.OCEAN_PROXIMITY_ORDER
            return {c: list(order) for c in columns}
        found = yield {c: Levels(keep(x)) for c, x in columns.items()}
        return {c: [v for v, _ in counts] for c, counts in found.items()}

    def apply(self, state, columns):
        return {c: fx.declared_codes(x, state[c]) for c, x in columns.items()}


# --- bins ----------------------------------------------------------------------------


class Bins(Step):
    """Left-closed bins with learned edges; values outside fall into the first or last bin."""

    defaults = {"n_bins": 5, "strategy": "quantile", "encoder": "onehot", "max_iter": 300}

    def check(self):
        one_of("encoder", self.options["encoder"], ENCODERS)
        one_of("strategy", self.options["strategy"], BIN_STRATEGIES)
        if self.options["n_bins"] < 2:
            raise ValueError("n_bins must be at least 2")

    def fit(self, columns, keep):
        n, strategy = self.options["n_bins"], self.options["strategy"]
        if strategy == "quantile":
            found = yield {c: Quantiles(keep(x), parts=n) for c, x in columns.items()}
            return {"edges": {c: _distinct_edges(v) for c, v in found.items()}}
        found = yield {c: Agg({"a": F.min(keep(x)), "b": F.max(keep(x))}) for c, x in columns.items()}
        # A column of one value (or none) is one bin.
        edges = {c: [v["a"], v["b"]] for c, v in found.items() if v["a"] == v["b"]}
        wide = {c: [float(e) for e in np.linspace(v["a"], v["b"], n + 1)] for c, v in found.items() if c not in edges}
        if strategy == "kmeans" and wide:
            fits = {c: fit_line_kmeans(keep(columns[c]), wide[c], self.options["max_iter"]) for c in wide}
            wide = yield from in_step(fits)
            wide = {c: _distinct_edges(e) for c, e in wide.items()}
        return {"edges": {**edges, **wide}}

    def apply(self, state, columns):
        out = {}
        for c, x in columns.items():
            inner = state["edges"][c][1:-1]
            code = F.lit(0.0)
            for edge in inner:
                code = code + (x >= edge).cast("double")
            if self.options["encoder"] == "ordinal":
                out[c] = code
            else:
                for i in range(len(inner) + 1):
                    inside = x.isNotNull()
                    if i > 0:
                        inside = inside & (x >= inner[i - 1])
                    if i < len(inner):
                        inside = inside & (x < inner[i])
                    out[f"{c}_{float(i)}"] = inside.cast("double")
        return out


def _distinct_edges(edges: list[float]) -> list[float]:
    """Drop edges that do not lie more than 1e-8 above the one before."""
    return [e for i, e in enumerate(edges) if i == 0 or e - edges[i - 1] > 1e-8]


# --- geography -------------------------------------------------------------------------


class Geo(Step):
    """Weighted k-means over coordinates, then an RBF similarity to every centre.

    ``n_init`` starts compete on the rows (see ``clusters``); with ``start`` one start goes from given centres. Centres are
    sorted, so column i means the same region after every fit, and don't depend on partitioning but for the order of sums.
    """

    defaults = {
        "n_clusters": 10, "gamma": 1.0, "weight_by": "population", "seed": config.RANDOM_SEED,
        "n_init": 10, "max_iter": 300, "tol": 1e-4, "coordinates": ["latitude", "longitude"], "start": None,
    }

    def check(self):
        start = self.options["start"]
        if start is not None and len(start) != self.options["n_clusters"]:
            raise ValueError(f"{self.options['n_clusters']} clusters can't start from {len(start)} centres")

    def _point(self, columns: Columns) -> list[Column]:
        missing = [c for c in self.options["coordinates"] if c not in columns]
        if missing:
            raise ValueError(f"cluster similarity needs {missing}; got columns {list(columns)}")
        return [columns[c] for c in self.options["coordinates"]]

    def fit(self, columns, keep):
        o = self.options
        point = self._point(columns)
        weight = F.lit(1.0)
        if o["weight_by"] and o["weight_by"] in columns:
            weight = F.greatest(columns[o["weight_by"]].cast("double"), F.lit(1e-9))
        kept = [keep(p.cast("double")) for p in point]
        extent = yield {"e": Agg({
            "n": F.count(kept[0]), **{f"sd{i}": F.var_pop(p) for i, p in enumerate(kept)},
            "nulls": F.count(keep(F.when(_any_null(point), 1))),
        })}
        e = extent["e"]
        if e["nulls"]:
            raise ValueError(f"{e['nulls']} row(s) hold a null in {o['coordinates']}: coordinates are not imputed")
        if not e["n"]:
            raise ValueError("cluster similarity needs at least one training row")
        d = len(point)
        inputs = {**{f"x{i}": p for i, p in enumerate(kept)}, "w": weight}
        centers = yield from fit_kmeans(
            inputs, d, o["n_clusters"], n=e["n"], seed=o["seed"], n_init=o["n_init"], max_iter=o["max_iter"],
            tolerance=o["tol"] * float(np.mean([e[f"sd{i}"] for i in range(d)])), start=o["start"],
        )
        return {"centers": centers}

    def apply(self, state, columns):
        similarity = fx.rbf_similarity(self._point(columns), state["centers"], self.options["gamma"])
        return {f"geo_cluster_{i}_similarity": s for i, s in enumerate(similarity)}


def _any_null(point: Sequence[Column]) -> Column:
    out = F.lit(False)
    for p in point:
        out = out | p.isNull()
    return out


def nearest_center(centers) -> str:
    """SQL text: index of the centre nearest to (x0, x1, ...), ties to the lowest; null for a null point."""
    gaps = ", ".join(
        " + ".join(f"(x{i} - {sql_double(v)}) * (x{i} - {sql_double(v)})" for i, v in enumerate(c)) for c in centers
    )
    return f"cast(array_position(array({gaps}), array_min(array({gaps}))) as int) - 1"


STEPS = {c.__name__: c for c in (Impute, ImputeMode, Deskew, Scale, Clip, Ratios, OneHot, Ordinal, Bins, Geo)}


def build(specs) -> list[Step]:
    """Steps from their JSON form [[name, options], ...]."""
    return [STEPS[name](**options) for name, options in specs]


def describe(steps: Sequence[Step]) -> list[list]:
    return [[type(s).__name__, s.options] for s in steps]
