"""The fitting engine: many fits, few passes.

A fit is a generator. It yields the statistics it needs next, receives their values, and returns a
small JSON-able state. ``fit_together`` advances any number of fits in step and answers everything
they ask for at the same depth together, in a few jobs side by side, so six feature branches times
five folds need only as many rounds as the deepest single branch.

Exact quantiles never put a column into one task, at any size: the wanted order statistics are found
by counting rows in ever narrower brackets, each pass one small shuffle. NaN counts as null; the
infinities are counted apart, so that every bracket is finite and every pass narrows it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Generator, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.partials import Least, Passes, Sums

BRACKET_BUCKETS = 1024
#: Aggregate functions per job. 45 correlations in one job took six times as long as in four (150,000
#: cached rows), probably because the loop outgrows what the JIT compiles: wide requests are dealt out.
PER_JOB = 12
SPREADS_PER_JOB = 4
#: One output column per level: beyond this many levels a wide encoding is refused.
MAX_LEVELS = 10_000

FitSteps = Generator[dict[str, Any], dict[str, Any], Any]


@dataclass(frozen=True)
class Agg:
    """Aggregate columns answered as one dict."""

    columns: dict[str, Column]


@dataclass(frozen=True)
class Quantiles:
    """Exact quantiles of a numeric expression, nulls skipped.

    ``linear`` interpolates between neighbours at (n-1)p; ``averaged`` is the averaged inverted
    distribution function at i/parts, taken by integer rank arithmetic.
    """

    column: Column
    probs: tuple[float, ...] = ()
    parts: int = 0
    exact: bool = True


@dataclass(frozen=True)
class Levels:
    """Distinct non-null values with their counts, as a list of (value, count) sorted by value."""

    column: Column
    top: int | None = None
    least: float = 0


@dataclass(frozen=True)
class Grouped:
    """Aggregates by key expressions over named inputs; the caller guarantees few groups.

    Keys and aggregates are SQL text over the input names: long lists of literals (centres) stay
    one expression to build.
    """

    inputs: dict[str, Column]
    keys: dict[str, str]
    columns: dict[str, str]


@dataclass(frozen=True)
class Spread:
    """Population variance of ``curve(column, point)`` at each of several points.

    Rows fan out over the points and are summed up by point before any shuffle.
    """

    column: Column
    points: tuple[float, ...]
    curve: Callable[[Column, Column], Column]


def keep_all(x: Column) -> Column:
    return x


def keep_where(condition: Column):
    """A row mask for a fit: rows outside it look null to every aggregate."""
    return lambda x: F.when(condition, x)


@contextmanager
def held(dataset: DataFrame, columns: Sequence[str] | None = None):
    """The needed columns, all by default, persisted for a fit of several passes unless the caller did so already."""
    if dataset.storageLevel != StorageLevel.NONE:
        yield dataset
        return
    narrow = dataset if columns is None else dataset.select(*[F.col(f"`{c}`") for c in dict.fromkeys(columns)])
    narrow = narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield narrow
    finally:
        narrow.unpersist()


def fit_together(df: DataFrame, fits: Sequence[FitSteps]) -> list[Any]:
    """Run several fits over one DataFrame, sharing every pass. A table that nobody holds is held meanwhile."""
    with held(df) as rows:
        return _fit_held(rows, fits)


def _fit_held(df: DataFrame, fits: Sequence[FitSteps]) -> list[Any]:
    results: list[Any] = [None] * len(fits)
    answers: dict[int, Any] = dict.fromkeys(range(len(fits)))
    reader = _Reader(df)
    while answers:
        asked: dict[int, dict[str, Any]] = {}
        for i, answer in answers.items():
            try:
                asked[i] = fits[i].send(answer)
            except StopIteration as stop:
                results[i] = stop.value
        answers = reader.answer(asked)
    return results


def fit_one(df: DataFrame, fit: FitSteps) -> Any:
    return fit_together(df, [fit])[0]


def in_step(fits: dict[str, FitSteps]) -> FitSteps:
    """Several fits as one, asking for everything of the same depth at once."""
    results: dict[str, Any] = {}
    answers: dict[str, Any] = dict.fromkeys(fits)
    while answers:
        asked = {}
        for name, answer in answers.items():
            try:
                asked[name] = fits[name].send(answer)
            except StopIteration as stop:
                results[name] = stop.value
        if not asked:
            break
        flat = {f"{name}/{key}": request for name, block in asked.items() for key, request in block.items()}
        replies = yield flat
        answers = {name: {key: replies[f"{name}/{key}"] for key in block} for name, block in asked.items()}
    return {name: results[name] for name in fits}


def side_by_side(jobs: Sequence[Callable[[], Any]], at_once: int = 8) -> list[Any]:
    """Run independent Spark jobs from driver threads; the first failure is raised."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    session = SparkSession.active()
    with ThreadPoolExecutor(max_workers=min(at_once, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(session)(job)) for job in jobs]]


class _Reader:
    def __init__(self, df: DataFrame):
        self.df = df
        self.passes = Passes(df)

    def answer(self, asked: dict[int, dict[str, Any]]) -> dict[int, dict[str, Any]]:
        """The jobs of one depth, side by side: scalars and spreads dealt out, one per grouping."""
        every = {(i, key): r for i, block in asked.items() for key, r in block.items()}
        # Branches that share a column ask for the same median or the same levels: compute it once.
        first: dict[str, tuple[int, str]] = {}
        same = {w: first.setdefault(repr(r), w) for w, r in every.items() if isinstance(r, (Quantiles, Levels))}
        requests = {w: r for w, r in every.items() if same.get(w, w) == w}
        found: dict[tuple[int, str], Any] = {}
        ranked = {w: r for w, r in requests.items() if isinstance(r, Quantiles) and r.exact}
        scalars = {w: r for w, r in requests.items() if isinstance(r, (Agg, Quantiles)) and w not in ranked}
        jobs = [lambda part=part: self._scalars(part, found) for part in _by_width(scalars)]
        jobs += [
            lambda part=part: self._spreads(part, found)
            for part in _parts({w: r for w, r in requests.items() if isinstance(r, Spread)}, SPREADS_PER_JOB)
        ]
        if ranked:
            jobs.append(lambda: found.update(_quantiles_by_rank(self.df, ranked)))
        batched = {w: r for w, r in requests.items() if isinstance(r, (Sums, Least))}
        if batched:
            jobs.append(lambda: found.update(zip(batched, self.passes.run(list(batched.values())))))
        for where, request in requests.items():
            if isinstance(request, (Levels, Grouped)):
                jobs.append(lambda w=where, r=request: found.__setitem__(w, self._grouped(r)))
        side_by_side(jobs)
        return {i: {key: found[same.get((i, key), (i, key))] for key in block} for i, block in asked.items()}

    def _grouped(self, request: Levels | Grouped) -> list:
        if isinstance(request, Levels):
            return levels(self.df, request.column, request.top, request.least)
        rows = self.df.select(*_named(request.inputs))
        grouped = rows.groupBy(*[F.expr(text).alias(k) for k, text in request.keys.items()])
        return [r.asDict() for r in grouped.agg(*[F.expr(t).alias(k) for k, t in request.columns.items()]).collect()]

    def _spreads(self, requests: dict[Any, Spread], found) -> None:
        most = max(len(r.points) for r in requests.values())
        rows = self.df.select(
            *[r.column.cast("double").alias(f"x{n}") for n, r in enumerate(requests.values())],
            F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("i"),
        )
        spread = [
            F.var_pop(r.curve(F.col(f"x{n}"), F.get(number_array(r.points), F.col("i"))))
            for n, r in enumerate(requests.values())
        ]
        by_point = {row["i"]: row for row in rows.groupBy("i").agg(*_named({f"v{n}": c for n, c in enumerate(spread)})).collect()}
        for n, (where, r) in enumerate(requests.items()):
            found[where] = [by_point[i][f"v{n}"] if i in by_point else None for i in range(len(r.points))]

    def _scalars(self, requests, found) -> None:
        """Every plain aggregate and every approximate quantile of this depth, in one pass where it fits."""
        inputs: dict[str, Column] = {}
        outputs: list[Column] = []
        readers: list[tuple[tuple[int, str], Any]] = []
        for n, (where, request) in enumerate(requests.items()):
            if isinstance(request, Agg):
                outputs += [c.alias(f"a{n}_{k}") for k, c in request.columns.items()]
                readers.append((where, lambda row, n=n, r=request: {k: row[f"a{n}_{k}"] for k in r.columns}))
            elif isinstance(request, Quantiles):
                inputs[f"q{n}"] = request.column.cast("double")
                probs = request.probs or tuple(i / request.parts for i in range(request.parts + 1))
                # One expression for all probabilities: hundreds of them for each of many features are slow to build one by one.
                outputs.append(F.percentile_approx(f"q{n}", number_array(probs), 10_000).alias(f"q{n}"))
                readers.append((where, lambda row, n=n: row[f"q{n}"] and [float(v) for v in row[f"q{n}"]]))
        if outputs:
            row = self.df.withColumns(inputs).agg(*outputs).first()
            for where, read in readers:
                found[where] = read(row)


def _parts(requests: dict, size: int) -> list[dict]:
    items = list(requests.items())
    return [dict(items[at:at + size]) for at in range(0, len(items), size)]


def _by_width(requests: dict) -> list[dict]:
    """Requests packed into jobs of about PER_JOB aggregate functions."""
    parts: list[dict] = []
    room = 0
    for where, request in requests.items():
        width = len(request.columns) if isinstance(request, Agg) else 1
        if width > room or not parts:
            parts.append({})
            room = PER_JOB
        parts[-1][where] = request
        room -= width
    return parts


def number_array(values: Sequence[float]) -> Column:
    """A literal array of doubles, as one expression."""
    return F.expr(f"array({', '.join(sql_double(v) for v in values)})")


def sql_double(value: float) -> str:
    return f"{float(value)!r}D"


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(k) for k, c in columns.items()]


def levels(df: DataFrame, column: Column, top: int | None = None, least: float = 0) -> list[tuple[Any, int]]:
    """(value, count) pairs; with ``top`` only the most frequent, ties to the smallest value; with ``least`` only those as frequent."""
    counts = df.select(column.alias("value")).where("value is not null").groupBy("value").count()
    if top is not None:
        rows = counts.orderBy(F.desc("count"), "value").limit(top).collect()
        return [(r["value"], r["count"]) for r in rows]
    rows = counts.where(F.col("count") >= least).limit(MAX_LEVELS + 1).collect()
    if len(rows) > MAX_LEVELS:
        raise ValueError(f"more than {MAX_LEVELS} levels: one column per level is not a table")
    return sorted((r["value"], r["count"]) for r in rows)


# --- quantiles ---------------------------------------------------------------


def _quantiles_by_rank(df: DataFrame, requests: dict[Any, Quantiles]) -> dict[Any, list[float] | None]:
    columns = {f"v{n}": F.nanvl(r.column.cast("double"), F.lit(None)) for n, r in enumerate(requests.values())}
    frame = df.select(*_named(columns))
    edges = _edges(frame, list(columns))
    plans, wanted = {}, {}
    for (where, request), name in zip(requests.items(), columns):
        n = edges[name]["all"]
        plans[where] = (name, _ranks(request, n) if n else [])
        wanted[name] = sorted({r for low, high, _ in plans[where][1] for r in (low, high)})
    values = order_statistics(frame, {k: v for k, v in wanted.items() if v}, edges)
    out = {}
    for where, (name, ranks) in plans.items():
        at = values.get(name, {})
        out[where] = [at[a] * (1.0 - w) + at[b] * w if w and at[a] != at[b] else at[a] for a, b, w in ranks] or None
    return out


def _ranks(request: Quantiles, n: int) -> list[tuple[int, int, float]]:
    """(lower rank, upper rank, weight of the upper) per quantile, ranks from 1."""
    if request.parts:
        out = []
        for i in range(request.parts + 1):
            whole, rest = divmod(n * i, request.parts)
            low = max(whole + (rest > 0), 1)
            high = min(low + 1, n) if rest == 0 and 0 < i < request.parts else low
            out.append((low, high, 0.5 if high != low else 0.0))
        return out
    out = []
    for p in request.probs:
        position = (n - 1) * p
        low = int(position)
        out.append((low + 1, min(low + 2, n), position - low))
    return out


def order_statistics(df: DataFrame, wanted: dict[str, Sequence[int]], edges: dict[str, dict] | None = None) -> dict[str, dict[int, float]]:
    """The r-th smallest non-null value of each numeric column, for every wanted rank r; ``edges`` as ``_edges`` gives them.

    Each pass counts rows per bucket of every open bracket and keeps the bucket that holds the rank;
    a bucket's own minimum and maximum become the next bracket, so ties and gaps end it at once.
    """
    if not wanted:
        return {}
    df = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(c) for c in wanted])
    edges = _edges(df, list(wanted)) if edges is None else edges
    found: dict[str, dict[int, float]] = {c: {} for c in wanted}
    # (column, low, high) -> [(rank, rows below low)]
    open_brackets: dict[tuple[str, float, float], list[tuple[int, int]]] = {}
    for c, ranks in wanted.items():
        under, within = edges[c]["under"], edges[c]["finite"]
        for rank in ranks:
            if under < rank <= under + within:
                open_brackets.setdefault((c, edges[c]["low"], edges[c]["high"]), []).append((rank, under))
            else:
                found[c][rank] = -math.inf if rank <= under else math.inf
    while open_brackets:
        for (c, low, high), ranks in list(open_brackets.items()):
            if low == high:
                found[c].update({r: low for r, _ in ranks})
                del open_brackets[(c, low, high)]
        if not open_brackets:
            break
        brackets = list(open_brackets)
        counts = _bucket_counts(df, brackets)
        following: dict[tuple[str, float, float], list[tuple[int, int]]] = {}
        for b, key in enumerate(brackets):
            for rank, below in open_brackets[key]:
                seen = below
                for bucket in counts[b]:
                    if seen + bucket["n"] >= rank:
                        following.setdefault((key[0], bucket["lo"], bucket["hi"]), []).append((rank, seen))
                        break
                    seen += bucket["n"]
        stuck = following.keys() & open_brackets.keys()
        if stuck:
            raise RuntimeError(f"no progress within {sorted(stuck)}")
        open_brackets = following
    return found


def _edges(df: DataFrame, names: Sequence[str]) -> dict[str, dict]:
    """Of each column of doubles: all values, finite ones, those that are -infinity, the least and the largest finite one."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((3, len(names)), np.int64)
        ends = np.full((2, len(names)), [[math.inf], [-math.inf]])
        for batch in batches:
            for c in range(len(names)):
                x = batch.column(c).to_numpy(zero_copy_only=False)
                finite = x[np.isfinite(x)]
                counts[:, c] += (len(x) - np.isnan(x).sum(), len(finite), (x == -math.inf).sum())
                if len(finite):
                    ends[:, c] = min(ends[0, c], finite.min()), max(ends[1, c], finite.max())
        columns = [np.arange(len(names), dtype=np.int32), *counts, *ends]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["c", "all", "finite", "under", "low", "high"])

    rows = df.select(*names).mapInArrow(look, "c int, all long, finite long, under long, low double, high double")
    sums = {n: F.sum(n) for n in ("all", "finite", "under")}
    found = {r["c"]: r for r in rows.groupBy("c").agg(*_named({**sums, "low": F.min("low"), "high": F.max("high")})).collect()}
    nothing = {"all": 0, "finite": 0, "under": 0, "low": math.inf, "high": -math.inf}
    return {name: found[c].asDict() if c in found else nothing for c, name in enumerate(names)}


def _bucket_counts(df: DataFrame, brackets: Sequence[tuple[str, float, float]]) -> list[list[dict]]:
    """Rows, minimum and maximum per bucket of each bracket: one pass, at most brackets x buckets rows of each task."""
    names = list(dict.fromkeys(c for c, _, _ in brackets))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = len(brackets), BRACKET_BUCKETS
        n, lo, hi = np.zeros(shape, np.int64), np.full(shape, math.inf), np.full(shape, -math.inf)
        for batch in batches:
            held = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(names)}
            for b, (c, low, high) in enumerate(brackets):
                v = held[c]
                v = v[(v >= low) & (v <= high)]
                if not len(v):
                    continue
                # Halved only when the bracket is so wide that its width overflows.
                half = 2.0 if math.isinf(high - low) else 1.0
                share = (v / half - low / half) / (high / half - low / half)
                k = np.minimum((share * BRACKET_BUCKETS).astype(np.int64), BRACKET_BUCKETS - 1)
                n[b] += np.bincount(k, minlength=BRACKET_BUCKETS)
                np.minimum.at(lo[b], k, v)
                np.maximum.at(hi[b], k, v)
        b, k = np.nonzero(n)
        columns = [b.astype(np.int32), k.astype(np.int32), n[b, k], lo[b, k], hi[b, k]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["b", "k", "n", "lo", "hi"])

    rows = (
        df.select(*names).mapInArrow(count, "b int, k int, n long, lo double, hi double")
        .groupBy("b", "k")
        .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .collect()
    )
    out: list[list[dict]] = [[] for _ in brackets]
    for row in sorted(rows, key=lambda r: (r["b"], r["k"])):
        out[row["b"]].append(row.asDict())
    return out
