"""Second moments of many columns from one scan: matrix products of each batch, summed over all rows.

``pair_moments`` is pairwise complete: every pair of columns counts the rows that hold both. ``target_moments`` takes feature
arrays and a target, for any number of row masks at once (the training sides of all folds). Columns are shifted by a value of
their own before they are multiplied, so that large means cost no digits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.partials import Arrays, Sums, run_partials

#: Rows looked at for a value to shift a column by.
SHIFT_ROWS = 100


def _pair_sums(columns: Arrays, shift: np.ndarray) -> np.ndarray:
    x = np.stack([columns[f"x{i}"] for i in range(len(shift))], 1)
    known = ~np.isnan(x)
    z, m = np.where(known, x - shift, 0.0), known.astype(float)
    return np.concatenate([m.T @ m, z.T @ m, (z * z).T @ m, z.T @ z])


@dataclass
class PairMoments:
    """n[i, j] rows hold columns i and j; over these, total[i, j] and square[i, j] sum column i and its square, product the two."""

    n: np.ndarray
    total: np.ndarray
    square: np.ndarray
    product: np.ndarray

    def correlations(self) -> np.ndarray:
        """Pearson correlations; NaN where a column does not vary over the common rows."""
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = self.square - self.total**2 / self.n
            joint = self.product - self.total * self.total.T / self.n
            flat = (spread <= 1e-14 * self.square) | (spread.T <= 1e-14 * self.square.T)
            return np.where(flat, np.nan, joint / np.sqrt(spread * spread.T))


def pair_moments(df: DataFrame, columns: Sequence[str]) -> PairMoments:
    narrow = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    p, shift = len(columns), np.zeros(len(columns))
    rows = narrow.limit(SHIFT_ROWS).collect()
    for i in range(p):
        shift[i] = next((r[i] for r in rows if r[i] is not None and np.isfinite(r[i])), 0.0)
    found = run_partials(narrow, [Sums({f"x{i}": F.col(f"x{i}") for i in range(p)}, partial(_pair_sums, shift=shift))])[0]
    found = np.zeros((4 * p, p)) if found is None else found
    return PairMoments(*np.split(found, 4))


@dataclass
class TargetMoments:
    """Rows, means and centred second moments of features x and target y."""

    n: int
    x_mean: np.ndarray
    y_mean: float
    xx: np.ndarray
    xy: np.ndarray
    yy: float


def matrix_of(lists: pa.Array) -> np.ndarray:
    """Arrays of one length as a matrix."""
    n = len(lists)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def _target_sums(columns: Arrays, of: Sequence[str], shifts: Sequence[np.ndarray]) -> np.ndarray:
    """A line for each mask: its matrix, row after row, and zeros up to the size of the largest, for folds may differ in their levels."""
    out = np.zeros((len(shifts), (max(map(len, shifts)) + 1) ** 2))
    for i, (name, shift) in enumerate(zip(of, shifts)):
        rows = (columns[f"m{i}"] > 0) & ~np.isnan(columns["y"])
        x = matrix_of(columns[name])
        if not len(x):
            continue
        z = np.column_stack([x[rows], columns["y"][rows]]) - shift
        if np.isnan(z).any():
            raise ValueError("a feature is null or NaN")
        z = np.column_stack([z, np.ones(len(z))])
        out[i, : z.shape[1] ** 2] = (z.T @ z).ravel()
    return out


def target_moments(df: DataFrame, arrays: Sequence[Column], y: Column, masks: Sequence[Column]) -> list[TargetMoments]:
    """The moments of the rows of each mask, all in one pass; one array for each mask, or one for all. Rows without a target don't count."""
    names = [f"x{i}" for i in range(len(arrays))]
    of = names if len(names) > 1 else names * len(masks)
    ready = df.select(
        *[a.cast("array<double>").alias(n) for a, n in zip(arrays, names)], y.cast("double").alias("y"),
        *[F.when(m, 1.0).otherwise(0.0).alias(f"m{i}") for i, m in enumerate(masks)],
    )
    first = ready.where("y is not null").first()
    if first is None:
        raise ValueError("no training row holds a label")
    shifts = [np.nan_to_num(np.array([*first[n], first["y"]], float)) for n in of]
    inputs = {"y": F.col("y"), **{f"m{i}": F.col(f"m{i}") for i in range(len(masks))}}
    found = run_partials(ready, [Sums(inputs, partial(_target_sums, of=of, shifts=shifts))], raw=names)[0]
    out = []
    for line, shift in zip(found, shifts):
        full = line[: (len(shift) + 1) ** 2].reshape(len(shift) + 1, -1)
        n = full[-1, -1]
        if not n:
            raise ValueError("no training row holds a label")
        mean = full[-1, :-1] / n
        centred = full[:-1, :-1] - n * np.outer(mean, mean)
        at = mean + shift
        out.append(TargetMoments(int(n), at[:-1], float(at[-1]), centred[:-1, :-1], centred[:-1, -1], float(centred[-1, -1])))
    return out
