"""What numpy can say of a batch, added up over all rows: sums of matrices, and the rows with the least keys.

A job runs any number of such requests in one pass over the columns they name. Every task adds up its own batches; the
rows of its matrices are then dealt to merging tasks by request and row, so neither the driver nor one task sees more
than the results and one partial at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

Arrays = dict[str, np.ndarray]


@dataclass(frozen=True)
class Sums:
    """The sum over all rows of ``work(columns)``, a matrix of fixed shape; nulls arrive as NaN."""

    inputs: dict[str, Column]
    work: Callable[[Arrays], np.ndarray]


@dataclass(frozen=True)
class Least:
    """For each row of ``work(columns)``, a matrix of keys by group and row, the ``size`` input rows with the least finite
    keys as (key, values), ties to the lesser values."""

    inputs: dict[str, Column]
    work: Callable[[Arrays], np.ndarray]
    size: int


#: Tasks whose partials the driver may merge.
FEW_TASKS = 16
#: A line's doubles travel as bytes: as an array, Spark would turn over each of them at every hop.
_PARTIAL = "request int, line int, key double, value binary"
_SCHEMA = pa.schema([("request", pa.int32()), ("line", pa.int32()), ("key", pa.float64()), ("value", pa.binary())])
#: Bytes that a batch of lines may pass by one line.
BATCH_BYTES = 1 << 26


def run_partials(df: DataFrame, requests: Sequence[Sums | Least], raw: Sequence[str] = ()) -> list:
    """One pass of ``Passes``."""
    return Passes(df).run(requests, raw)


class Passes:
    """Passes over one table. Once it is known that at most ``FEW_TASKS`` tasks read it, the driver merges their partials itself."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.tasks: int | None = None

    def run(self, requests: Sequence[Sums | Least], raw: Sequence[str] = ()) -> list:
        """Each request's answer, from one pass: a matrix, or None where there is no row; (key, values) by group.

        Columns named in ``raw`` reach every ``work`` as Arrow arrays.
        """
        rows, sizes = _partial_rows(self.df, requests, raw)
        if self.tasks is not None and self.tasks <= FEW_TASKS:
            merged = pa.Table.from_batches(_merged(rows.toArrow().to_batches(), sizes), _SCHEMA)
        else:
            merged = rows.repartition("request", "line").mapInArrow(partial(_merged, sizes=sizes), _PARTIAL).toArrow()
        found: list[dict[int, list]] = [{} for _ in requests]
        tasks = 0
        for row in merged.to_pylist():
            if row["request"] < 0:
                tasks += 1
            else:
                found[row["request"]].setdefault(row["line"], []).append((row["key"], np.frombuffer(row["value"])))
        self.tasks = tasks
        out: list = []
        for size, lines in zip(sizes, found):
            if size:
                out.append({line: sorted((k, tuple(v.tolist())) for k, v in rows) for line, rows in lines.items()})
            else:
                out.append(np.array([lines[line][0][1] for line in sorted(lines)]) if lines else None)
        return out


def _partial_rows(df: DataFrame, requests: Sequence[Sums | Least], raw: Sequence[str]) -> tuple[DataFrame, list[int]]:
    """Every task's own results as rows, and one row with request -1 from each task."""
    named: dict[str, tuple[str, Column]] = {}
    wanted: list[dict[str, int]] = []
    for request in requests:
        places = {}
        for name, column in request.inputs.items():
            text = repr(column)
            named.setdefault(text, (f"c{len(named)}", column))
            places[name] = int(named[text][0][1:])
        wanted.append(places)
    works = [(r.work, places, getattr(r, "size", 0)) for r, places in zip(requests, wanted)]
    sizes = [r.size if isinstance(r, Least) else 0 for r in requests]
    width = len(named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(sizes)
        held.lines[-1, TaskContext.get().partitionId()] = np.empty(0)
        for batch in batches:
            given = {name: batch.column(width + n) for n, name in enumerate(raw)}
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in range(width)]
            for i, (work, places, size) in enumerate(works):
                own = {name: columns[at] for name, at in places.items()}
                made = work({**own, **given})
                if not size:
                    held.add_matrix(i, made)
                    continue
                values = np.stack([own[name] for name in places], 1)
                for line, keys in enumerate(made):
                    near = np.argpartition(keys, size)[:size] if len(keys) > size else np.arange(len(keys))
                    #: rows as near as the last one are kept, so that ties are decided by value
                    near = np.flatnonzero(keys <= keys[near].max()) if len(near) else near
                    near = near[np.isfinite(keys[near])]
                    held.add_rows(i, line, keys[near], values[near])
        yield from held.batches()

    return df.select(*[c.cast("double").alias(name) for name, c in named.values()], *raw).mapInArrow(run, _PARTIAL), sizes


def _merged(batches: Iterator[pa.RecordBatch], sizes: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """The partials of each request and line, merged."""
    held = _Held(sizes)
    for batch in batches:
        lines = [np.frombuffer(raw.as_buffer()) for raw in batch.column(3)]
        of_line: dict[tuple[int, int], list[int]] = {}
        for n, where in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2)))):
            of_line.setdefault(where, []).append(n)
        keys = batch.column(2).to_numpy()
        for (i, line), places in of_line.items():
            values = [lines[n] for n in places]
            if i >= 0 and sizes[i]:
                held.add_rows(i, line, keys[places], np.array(values))
            else:
                held.add_line(i, line, np.sum(values, 0))
    yield from held.batches()


class _Held:
    """One task's results so far."""

    def __init__(self, sizes: Sequence[int]):
        self.sizes = sizes
        self.lines: dict[tuple[int, int], np.ndarray] = {}
        self.rows: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def add_matrix(self, request: int, made: np.ndarray) -> None:
        for line, value in enumerate(made):
            self.add_line(request, line, value)

    def add_line(self, request: int, line: int, value: np.ndarray) -> None:
        known = self.lines.get((request, line))
        self.lines[request, line] = value.copy() if known is None else known + value

    def add_rows(self, request: int, line: int, keys: np.ndarray, values: np.ndarray) -> None:
        if (request, line) in self.rows:
            known = self.rows[request, line]
            keys, values = np.concatenate([known[0], keys]), np.concatenate([known[1], values])
        if len(keys) > self.sizes[request]:
            order = np.lexsort([*values.T[::-1], keys])[: self.sizes[request]]
            keys, values = keys[order], values[order]
        self.rows[request, line] = keys, values

    def batches(self) -> Iterator[pa.RecordBatch]:
        rows = [(i, line, 0.0, v) for (i, line), v in self.lines.items()]
        rows += [(i, line, k, v) for (i, line), (keys, values) in self.rows.items() for k, v in zip(keys, values)]
        start, size = 0, 0
        for end, row in enumerate(rows, 1):
            size += row[3].nbytes
            if end == len(rows) or end - start == 1024 or size >= BATCH_BYTES:
                columns = list(zip(*rows[start:end]))
                columns[3] = [np.ascontiguousarray(v, np.float64).tobytes() for v in columns[3]]
                yield pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in zip(columns, _SCHEMA)], schema=_SCHEMA)
                start, size = end, 0
