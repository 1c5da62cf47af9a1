"""Weighted k-means over rows: parallel oversampling, all starts advanced by one pass a round.

A start's candidates come from the rows themselves. Its first is drawn by weight; then in each of a few rounds
``oversample`` x k rows are drawn by weight times squared distance to the candidates so far, as the least of exponential
races whose random numbers are hashes of the row's values, so a draw depends on neither partitioning nor task. Candidates
are weighted by the rows nearest to them and reduced to k centres on the driver. Lloyd rounds on a sample of some
``SAMPLE`` rows bring these near to where they will rest, which only saves passes; then Lloyd rounds over the rows
themselves move all starts until they rest. A centre that gets no row moves to the row farthest from its own. The start
with the least inertia wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import numpy as np
from pyspark.sql import Column

from holdfast.operators.partials import Arrays, Least, Sums

#: Rounds of drawing, and candidates drawn in each for each centre wanted.
ROUNDS, OVERSAMPLE = 3, 3
#: Lloyd rounds on the driver, rows of the sample, and different points that it must hold for each centre.
LOCAL_ROUNDS, SAMPLE, PER_CENTER = 100, 8192, 20


def _rows(columns: Arrays, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and weights of the rows that have both."""
    x = np.stack([columns[f"x{i}"] for i in range(d)], 1)
    whole = ~np.isnan(x).any(1)
    return x[whole], columns["w"][whole]


def squared_gaps(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(centers)))
    for i in range(x.shape[1]):
        gap = x[:, i, None] - centers[None, :, i]
        out += gap * gap
    return out


def nearest(x: np.ndarray, centers: np.ndarray, which: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Each row's least squared gap and, if asked for, the first centre that has it.

    The numbers are those of ``squared_gaps``; centre after centre, so that a batch stays in the processor's cache.
    """
    columns = [np.ascontiguousarray(x[:, i]) for i in range(x.shape[1])]
    least, home = np.full(len(x), np.inf), np.zeros(len(x), np.int64) if which else None
    gap, more = np.empty(len(x)), np.empty(len(x))
    for k, center in enumerate(centers.tolist()):
        for i, (column, at) in enumerate(zip(columns, center)):
            part = more if i else gap
            np.subtract(column, at, out=part)
            np.multiply(part, part, out=part)
            if i:
                gap += more
        if which:
            home[gap < least] = k
        np.minimum(least, gap, out=least)
    return least, home


def hashed_uniform(values: np.ndarray, tag: int) -> np.ndarray:
    """A number in (0, 1) for each row of ``values``, from its bits and the tag."""
    with np.errstate(over="ignore"):
        h = np.full(len(values), tag * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
        for column in values.T:
            #: -0.0 counts as 0.0
            h ^= np.ascontiguousarray(column + 0.0).view(np.uint64)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
            h ^= h >> np.uint64(31)
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _whole_keys(columns: Arrays, d: int, key) -> np.ndarray:
    """Keys of all rows from those of the whole ones; others are never drawn."""
    whole = ~np.isnan(np.stack([columns[f"x{i}"] for i in range(d)])).any(0)
    made = key(*_rows(columns, d))
    out = np.full((len(made), len(whole)), np.inf)
    out[:, whole] = made
    return out


def _race(columns: Arrays, d: int, tags: Sequence[int], centers: Sequence[np.ndarray] | None) -> np.ndarray:
    """By start, each row's arrival in a race whose rates are its weight, times the squared distance to the candidates if any."""

    def key(x, w):
        rows = []
        for i, tag in enumerate(tags):
            rate = w if centers is None else w * nearest(x, centers[i], which=False)[0]
            with np.errstate(divide="ignore"):
                rows.append(np.where(rate > 0, -np.log(hashed_uniform(np.column_stack([x, w]), tag)) / rate, np.inf))
        return np.array(rows)

    return _whole_keys(columns, d, key)


def _masses(columns: Arrays, d: int, centers: Sequence[np.ndarray]) -> np.ndarray:
    """By start, the weight of the rows nearest to each candidate."""
    x, w = _rows(columns, d)
    most = max(map(len, centers))
    return np.array([np.bincount(nearest(x, c)[1], w, most) for c in centers])


def _moments(columns: Arrays, d: int, centers: Sequence[np.ndarray]) -> np.ndarray:
    """For each centre of each start: weight, weighted coordinates and inertia of the rows nearest to it, ties to the first."""
    x, w = _rows(columns, d)
    out = []
    for c in centers:
        gaps, home = nearest(x, c)
        sums = [w, *(w * x[:, i] for i in range(d)), w * gaps]
        out.append(np.stack([np.bincount(home, s, len(c)) for s in sums], 1))
    return np.concatenate(out)


def _nearness(columns: Arrays, d: int, centers: Sequence[np.ndarray]) -> np.ndarray:
    """By start, keys whose least are the rows farthest from their centres."""

    def key(x, w):
        gaps = np.array([nearest(x, c, which=False)[0] for c in centers])
        return np.where(gaps > 0, -gaps, np.inf)

    return _whole_keys(columns, d, key)


def _reduced(x: np.ndarray, w: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k centres of weighted candidates, no more than there are different ones: k-means++ and Lloyd."""
    x, where = np.unique(x, axis=0, return_inverse=True)
    w = np.bincount(where.ravel(), w)
    centers = x[[rng.choice(len(x), p=w / w.sum())]]
    while len(centers) < min(k, len(x)):
        near = squared_gaps(x, centers).min(1)
        mass = np.where(near > 0, near * np.maximum(w, w[w > 0].min()), 0.0)
        centers = np.vstack([centers, x[[rng.choice(len(x), p=mass / mass.sum())]]])
    return _settled(x, w, centers)


def _settled(x: np.ndarray, w: np.ndarray, centers: np.ndarray, tolerance: float = 0.0) -> np.ndarray:
    """Centres after Lloyd rounds on points held here."""
    for _ in range(LOCAL_ROUNDS):
        home = squared_gaps(x, centers).argmin(1)
        mass = np.bincount(home, w, len(centers))
        moved = np.stack([np.bincount(home, w * x[:, i], len(centers)) for i in range(x.shape[1])], 1)
        moved = np.where(mass[:, None] > 0, moved / np.where(mass > 0, mass, 1.0)[:, None], centers)
        shift, centers = ((moved - centers) ** 2).sum(), moved
        if shift <= tolerance:
            break
    return centers


def _draw(columns: Arrays, d: int, tag: int, share: float) -> np.ndarray:
    """The random numbers of a share of the rows, whatever their weight."""

    def key(x, w):
        u = hashed_uniform(np.column_stack([x, w]), tag)
        return np.where(u < share, u, np.inf)[None]

    return _whole_keys(columns, d, key)


def fit_kmeans(inputs: dict[str, Column], d: int, k: int, *, n: int, seed: int, n_init: int, max_iter: int, tolerance: float, start=None):
    """Centres of n points x0, x1, ... weighted by w; with ``start`` one start from these centres.

    A generator for ``operators.stats``. A table of fewer than k different points gives some centres twice.
    """
    if start is not None:
        starts = [np.array(start, float)]
    else:
        starts = yield from _oversampled(inputs, d, k, n, seed, n_init, tolerance)
    active = list(range(len(starts)))
    for _ in range(max_iter):
        if not active:
            break
        found = (yield {"m": Sums(inputs, partial(_moments, d=d, centers=[starts[s] for s in active]))})["m"]
        moments = found.reshape(len(active), k, d + 2)
        moved = {}
        for s, m in zip(active, moments):
            mass = m[:, :1]
            moved[s] = np.where(mass > 0, m[:, 1:-1] / np.where(mass > 0, mass, 1.0), starts[s])
        lost = {s: np.flatnonzero(m[:, 0] == 0) for s, m in zip(active, moments) if not m[:, 0].all()}
        if lost:
            asked = Least(inputs, partial(_nearness, d=d, centers=[moved[s] for s in lost]), max(map(len, lost.values())))
            far = (yield {"f": asked})["f"]
            for line, (s, empty) in enumerate(lost.items()):
                for place, (_, values) in zip(empty, far.get(line, [])):
                    moved[s][place] = values[:d]
        still = [s for s in active if ((moved[s] - starts[s]) ** 2).sum() > tolerance]
        for s in active:
            starts[s] = moved[s]
        active = still
    best = 0
    if len(starts) > 1:
        best = int(np.argmin((yield from _inertia(inputs, d, k, starts))))
    return sorted([float(v) for v in c] for c in starts[best])


def _inertia(inputs: dict[str, Column], d: int, k: int, starts: list[np.ndarray]):
    found = (yield {"m": Sums(inputs, partial(_moments, d=d, centers=starts))})["m"]
    return found[:, -1].reshape(len(starts), k).sum(1)


def _oversampled(inputs: dict[str, Column], d: int, k: int, n: int, seed: int, n_init: int, tolerance: float):
    tags = [[(seed * 1_000_003 + s) * 64 + r for s in range(n_init)] for r in range(ROUNDS + 1)]
    drawn = yield {
        "first": Least(inputs, partial(_race, d=d, tags=tags[0], centers=None), 1),
        "sample": Least(inputs, partial(_draw, d=d, tag=tags[0][0] + 63, share=SAMPLE / n), 2 * SAMPLE),
    }
    candidates = [np.array([values[:d] for _, values in drawn["first"][s]]) for s in range(n_init)]
    sample = np.array([values for _, values in drawn["sample"].get(0, [])]).reshape(-1, d + 1)
    sample_helps = len(np.unique(sample[:, :d], axis=0)) >= PER_CENTER * k
    for r in range(1, ROUNDS + 1):
        asked = Least(inputs, partial(_race, d=d, tags=tags[r], centers=candidates), OVERSAMPLE * k)
        drawn = (yield {"drawn": asked})["drawn"]
        candidates = [np.array([*c, *(values[:d] for _, values in drawn.get(s, []))]) for s, c in enumerate(candidates)]
    masses = (yield {"mass": Sums(inputs, partial(_masses, d=d, centers=candidates))})["mass"]
    starts = []
    for s, c in enumerate(candidates):
        centers = _reduced(c, masses[s, : len(c)], k, np.random.default_rng([seed, s]))
        if sample_helps:
            centers = _settled(sample[:, :d], sample[:, d], centers, tolerance / 10)
        starts.append(np.concatenate([centers, np.repeat(centers[:1], k - len(centers), 0)]))
    return starts
