"""One-dimensional k-means on prefix sums: rounds on counts and sums by value, not on rows.

The column is counted and summed in cells of its range, once. A round needs only the rows below each cut, and those
are a prefix of the cells, but for the cell that a cut runs through. Rounds are first played with such cells
interpolated, which tells where the cuts will come; these cells are counted again in finer ones, many at a time, until
every cut of every round falls between cells. So the rounds are exact, and a few jobs do for all of them. A cell of a
single value is never cut, and finer cells lie between a cell's own least and greatest value, so outliers cost one
more level and no more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column

from holdfast.operators.stats import FitSteps, Grouped, sql_double

#: Cells of the whole range, cells a refined cell is cut into, and cells refined by one job: what a job returns is bounded.
ROOT_CELLS = 1 << 16
FINE_CELLS = 1 << 10
CELLS_PER_JOB = 64


class Cells:
    """Disjoint value ranges in ascending order with the count and the sum of their rows."""

    def __init__(self, rows: Sequence[dict]):
        rows = sorted(rows, key=lambda r: r["low"])
        self.low = np.array([r["low"] for r in rows], np.float64)
        self.high = np.array([r["high"] for r in rows], np.float64)
        self.n = np.array([r["n"] for r in rows], np.float64)
        self.s = np.array([r["s"] for r in rows], np.float64)
        self.n_before = np.concatenate([[0.0], np.cumsum(self.n)])
        self.s_before = np.concatenate([[0.0], np.cumsum(self.s.astype(np.longdouble))])

    def below(self, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Count and sum of the rows below each cut, and the cells that a cut runs through (interpolated)."""
        at = np.searchsorted(self.high, cuts, "left")
        inner = np.minimum(at, len(self.low) - 1)
        through = (at < len(self.low)) & (self.low[inner] < cuts)
        width = np.where(through, self.high[inner] - self.low[inner], 1.0)
        part = np.where(through, (cuts - self.low[inner]) / width, 0.0)
        return self.n_before[at] + part * self.n[inner], self.s_before[at] + part * self.s[inner], inner[through].tolist()

    def replaced(self, gone: Sequence[int], rows: Sequence[dict]) -> Cells:
        left = set(gone)
        kept = [
            {"low": a, "high": b, "n": n, "s": s}
            for i, (a, b, n, s) in enumerate(zip(self.low, self.high, self.n, self.s)) if i not in left
        ]
        return Cells([*kept, *rows])


def play(cells: Cells, centers: Sequence[float], max_iter: int) -> tuple[list[float], list[int]]:
    """Lloyd rounds until nothing moves, and the cells that a cut ran through, in the order met."""
    now, cut = np.array(centers, np.float64), {}
    for _ in range(max_iter):
        n, s, through = cells.below((now[:-1] + now[1:]) / 2)
        cut.update(dict.fromkeys(through))
        n = np.diff(np.concatenate([[0.0], n, cells.n_before[-1:]]))
        s = np.diff(np.concatenate([[0.0], s, cells.s_before[-1:]]))
        # A centre without rows stays where it is.
        moved = np.sort(np.where(n > 0, s / np.where(n > 0, n, 1.0), now).astype(np.float64))
        if (moved == now).all():
            break
        now = moved
    return now.tolist(), list(cut)


def _counted(x: Column, ranges: Sequence[tuple[float, float]], cells: int) -> Grouped:
    """Counts and sums of the rows in each of ``ranges``, cut into even cells."""

    def cased(value: Callable[[int, float, float], str]) -> str:
        arms = (f"when x between {sql_double(a)} and {sql_double(b)} then {value(i, a, b)}" for i, (a, b) in enumerate(ranges))
        return f"case {' '.join(arms)} end"

    def cell(i: int, a: float, b: float) -> str:
        return f"least(cast(floor((x - {sql_double(a)}) / {sql_double(b - a)} * {cells}) as int), {cells - 1})"

    return Grouped(
        {"x": x.cast("double")}, {"range": cased(lambda i, a, b: str(i)), "cell": cased(cell)},
        {"n": "count(x)", "s": "sum(x)", "low": "min(x)", "high": "max(x)"},
    )


def fit_line_kmeans(x: Column, edges: Sequence[float], max_iter: int) -> FitSteps:
    """Edges of one-dimensional k-means from the centres of the bins between ``edges``: midpoints between centres.

    ``edges`` must reach from the least to the greatest value.
    """
    start = [(a + b) / 2 for a, b in zip(edges, edges[1:])]
    found = yield {"c": _counted(x, [(edges[0], edges[-1])], ROOT_CELLS)}
    cells = Cells([r for r in found["c"] if r["range"] is not None])
    while True:
        centers, cut = play(cells, start, max_iter)
        if not cut:
            return [edges[0], *[(a + b) / 2 for a, b in zip(centers, centers[1:])], edges[-1]]
        finer = cut[:CELLS_PER_JOB]
        ranges = [(float(cells.low[i]), float(cells.high[i])) for i in finer]
        found = yield {"c": _counted(x, ranges, FINE_CELLS)}
        cells = cells.replaced(finer, [r for r in found["c"] if r["range"] is not None])
