"""What a fitted model rests on: permutation importance and partial dependence."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import config
from holdfast.functions.keys import HASH_BITS, hash_number, key_text, seeded_md5
from holdfast.operators.rank import global_rank, prefix_bits
from holdfast.operators.stats import Quantiles, fit_one, held, levels

GRID_POINTS = 100
#: Types whose values a double holds exactly; all others travel as text.
_AS_DOUBLE = {"double", "float", "int", "smallint", "tinyint"}
#: The number of a hex digit by its byte.
_DIGITS = np.array([int(chr(i), 16) if chr(i) in "0123456789abcdef" else 0 for i in range(256)])
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: How a permuted value travels.
_SENT = {"double": "__number", "string": "__word"}
#: Rows that a task cuts into buckets together, rows of a bucket of a tag's order, places whose values become rows together.
SENT_ROWS, BUCKET_ROWS, PLACES = 1 << 16, 1 << 18, 1 << 14


def permuted(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], *, n_repeats: int, seed=config.RANDOM_SEED
) -> DataFrame:
    """All shuffled variants at once: rows tagged (column, repeat) with that one column permuted.

    A row's place in key-hash order is matched with the same place in a hash order of its own per tag. Rows don't fan
    out before they meet: a task cuts the values of each tag into buckets of its order, which travel as lists and are
    sorted apart; the sorted lists follow each other, so they are cut at places and a place's values become one row,
    joined once. All orders are uniform hashes, so no bucket and no place is hot, whatever the columns hold.
    """
    n, types = df.count(), dict(df.dtypes)
    fits = [c for c in columns if types[c] in _AS_DOUBLE]
    home = global_rank(df, hash_number(seeded_md5(seed, keys)), "__place", n, ties=keys)
    tags = [(c, r) for c in columns for r in range(n_repeats)]
    kinds = ["double" if c in fits else "string" for c, _ in tags]
    met = home.join(_handed(df, tags, kinds, keys, n, seed), "__place")
    named = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(r).alias("repeat")) for c, r in tags])
    values = [
        F.struct(F.lit(i).alias("__tag"), *[(F.col(f"__v{i}") if kind == k else F.lit(None).cast(k)).alias(name) for k, name in _SENT.items()])
        for i, kind in enumerate(kinds)
    ]
    tag = F.element_at(named, F.col("__tag") + 1)
    out = met.select(*df.columns, F.inline(F.array(*values)).alias("__tag", *_SENT.values()))
    out = out.withColumns({"column": tag["column"], "repeat": tag["repeat"]}).drop("__tag")
    swapped = {
        c: F.when(F.col("column") == c, F.col("__number" if c in fits else "__word").cast(types[c])).otherwise(F.col(c))
        for c in columns
    }
    return out.withColumns(swapped).drop("__number", "__word")


def _lists(parts: list[pa.Array], ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Values cut into lists that end at ``ends``."""
    values = pa.concat_arrays(parts) if parts else pa.array([], kind)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), values)


def _numbers(md5: pa.Array) -> np.ndarray:
    """``keys.hash_number`` of a batch: in numpy, for Spark's conversion of text costs more than the md5 itself."""
    text = np.frombuffer(md5.buffers()[2], np.uint8)[32 * md5.offset :][: 32 * len(md5)].reshape(-1, 32)
    out = np.zeros(len(md5), np.int64)
    for digit in range(HASH_BITS // 4):
        out = out << 4 | _DIGITS[text[:, digit]]
    return out


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays([c.flatten() for c in column.chunks])


def _handed(df: DataFrame, tags: Sequence[tuple[str, int]], kinds: Sequence[str], keys: Sequence[str], n: int, seed) -> DataFrame:
    """__place and, for each tag, the value that its order puts there as __v0, __v1, ..."""
    shift = HASH_BITS - prefix_bits(n, BUCKET_ROWS)
    hashes = [F.md5(F.concat(F.lit(f"{seed}|{c}|{r}|"), key_text(*[F.col(k) for k in keys]))).alias(f"h{i}") for i, (c, r) in enumerate(tags)]
    sources = list(dict.fromkeys(c for c, _ in tags))
    at = [sources.index(c) for c, _ in tags]
    kind_of = dict(zip((c for c, _ in tags), kinds))
    narrow = df.select(
        *hashes, *[F.col(c).cast(kind_of[c]).alias(f"v{j}") for j, c in enumerate(sources)], *[F.col(k).alias(f"k{j}") for j, k in enumerate(keys)]
    )
    own = [f"k{j} array<{narrow.schema[f'k{j}'].dataType.simpleString()}>" for j in range(len(keys))]
    lists = "number array<double>, word array<string>"

    def pair(kind: str, values: pa.Array) -> list[pa.Array]:
        """The lists of numbers and of words, of which one is null."""
        none = {k: pa.nulls(len(values), pa.list_(pa.float64() if k == "double" else pa.string())) for k in _SENT}
        return [values if k == kind else none[k] for k in _SENT]

    def bucketed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        flat = [pa.concat_arrays(c.chunks) for c in rows.columns]
        for i, kind in enumerate(kinds):
            h = _numbers(flat[i])
            order = np.argsort(h, kind="stable")
            bucket = h[order] >> shift
            ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(h))
            places = pa.array(order)
            sent = [_lists([v.take(places)], ends, v.type) for v in (pa.array(h), flat[len(tags) + at[i]], *flat[len(tags) + len(sources) :])]
            columns = [pa.array(np.full(len(ends), i, np.int32)), pa.array(bucket[ends - 1]), sent[0], *pair(kind, sent[1]), *sent[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["tag", "bucket", "h", "number", "word", *[f"k{j}" for j in range(len(keys))]])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= SENT_ROWS:
                yield from bucketed(held)
                held, size = [], 0
        if size:
            yield from bucketed(held)

    def ordered(rows: pa.Table) -> pa.Table:
        tag = rows["tag"][0].as_py()
        h = _flat(rows["h"]).to_numpy()
        order = np.argsort(h, kind="stable")
        if (np.diff(h[order]) == 0).any():
            ties = pa.table({"h": h, **{f"k{j}": _flat(rows[f"k{j}"]) for j in range(len(keys))}})
            order = pc.sort_indices(ties, [(c, "ascending") for c in ties.column_names], null_placement="at_start").to_numpy()
        values = _flat(rows["number" if kinds[tag] == "double" else "word"]).take(pa.array(order))
        sent = pair(kinds[tag], _lists([values], np.array([len(h)]), values.type))
        return pa.table([rows["tag"].slice(0, 1), rows["bucket"].slice(0, 1), *sent], ["tag", "bucket", "number", "word"])

    dealt = narrow.mapInArrow(deal, ", ".join(["tag int, bucket long, h array<long>", lists, *own]))
    runs = dealt.groupBy("tag", "bucket").applyInArrow(ordered, f"tag int, bucket long, {lists}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(tags)):
                bucket, size = np.unique(_numbers(batch.column(i)) >> shift, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), i, np.int32)), pa.array(bucket), pa.array(size)], ["tag", "bucket", "n"])

    # The counts say where each list begins. Hashes are worked out twice for it, but no list is held.
    starts: dict[tuple[int, int], int] = {}
    upto = [0] * len(tags)
    sizes = narrow.select(*narrow.columns[: len(tags)]).mapInArrow(counted, "tag int, bucket long, n long").groupBy("tag", "bucket").agg(F.sum("n"))
    for tag, bucket, size in sorted(tuple(r) for r in sizes.collect()):
        starts[tag, bucket], upto[tag] = upto[tag], upto[tag] + size
    shared = df.sparkSession.sparkContext.broadcast(starts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tag, bucket = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                values = batch.column(2 if kinds[tag] == "double" else 3)[row].values
                start, end = shared.value[tag, bucket], shared.value[tag, bucket] + len(values)
                inner = np.arange(start // PLACES + 1, -(-end // PLACES)) * PLACES
                froms, tos = np.concatenate([[start], inner]), np.concatenate([inner, [end]])
                sent = pair(kinds[tag], _lists([values], tos - start, values.type))
                columns = [pa.array(froms // PLACES), pa.array(np.full(len(froms), tag, np.int32)), pa.array(froms), *sent]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "tag", "start", "number", "word"])

    def placed(rows: pa.Table) -> pa.Table:
        tag, start = rows["tag"].to_numpy(), rows["start"].to_numpy()
        out = []
        for i, kind in enumerate(kinds):
            mine = np.flatnonzero(tag == i)
            mine = mine[np.argsort(start[mine])]
            out.append(_flat(rows["number" if kind == "double" else "word"].take(pa.array(mine))))
        return pa.table([pa.array(np.arange(len(out[0])) + start.min() + 1), *out], ["__place", *[f"__v{i}" for i in range(len(tags))]])

    pieces = runs.mapInArrow(cut, f"chunk long, tag int, start long, {lists}")
    return pieces.groupBy("chunk").applyInArrow(placed, ", ".join(["__place long", *[f"__v{i} {k}" for i, k in enumerate(kinds)]]))


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries that begin inside remove their shuffles when they end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def importance_table(
    model: Model,
    df: DataFrame,
    keys: Sequence[str],
    *,
    columns: Sequence[str] | None = None,
    label: str = config.TARGET,
    n_repeats: int = 10,
    seed=config.RANDOM_SEED,
) -> DataFrame:
    """RMSE increase when one RAW column is shuffled: mean and spread over the repeats, largest first."""
    columns = list(columns or [*config.NUMERIC_COLUMNS, *config.CATEGORICAL_COLUMNS])
    squared = F.pow(F.col(label) - F.col("prediction"), 2)
    with held(df, list(dict.fromkeys([*keys, *columns, label, *_contract_columns(df)]))) as rows:
        base = model.transform(rows).agg(F.sqrt(F.avg(squared)).alias("rmse")).first()["rmse"]
        found = []
        # A column at a time, and its shuffles go with it: all together take the disk of all.
        for c in columns:
            with _shuffles_go(df.sparkSession):
                shuffled = permuted(rows, [c], keys, n_repeats=n_repeats, seed=seed)
                scored = model.transform(shuffled).groupBy("column", "repeat").agg(
                    (F.sqrt(F.avg(squared)) - F.lit(base)).alias("increase")
                )
                # One number per column and repeat: the answer is small by construction.
                found += scored.collect()
        scored = df.sparkSession.createDataFrame(found, scored.schema)
    return (
        scored.groupBy("column")
        .agg(F.avg("increase").alias("rmse_increase"), F.stddev_pop("increase").alias("std"))
        .orderBy(F.desc("rmse_increase"), "column")
    )


def _contract_columns(df: DataFrame) -> list[str]:
    """Columns of the contract the frame holds: a chain reads no others."""
    return [c for c in config.SCHEMA.fieldNames() if c in df.columns]


def importance_flag(table: DataFrame) -> DataFrame:
    """Mark columns whose spread reaches zero."""
    return table.withColumn("unsupported", F.col("rmse_increase") - F.col("std") <= 0)


def dependence_grid(df: DataFrame, column: str, *, points: int = GRID_POINTS, low=0.05, high=0.95) -> list:
    """All distinct values when there are few, else an even grid between two empirical quantiles; of a text
    column the most frequent values.

    The quantiles are those with plotting position (i - 0.4) / (n + 0.2).
    """
    x = F.col(column)
    if not isinstance(df.schema[column].dataType, T.NumericType):
        return [value for value, _ in levels(df, x, top=points)]
    few = df.select(x.alias("v")).where("v is not null").distinct().limit(points).collect()
    if len(few) < points:
        return sorted(r["v"] for r in few)
    n = df.where(x.isNotNull()).count()
    probs = tuple(min(max((n * p + 0.4 + 0.2 * p - 1.0) / (n - 1), 0.0), 1.0) for p in (low, high))

    def ends():
        found = yield {"q": Quantiles(x, probs)}
        return found["q"]

    a, b = fit_one(df, ends())
    return [a + (b - a) * i / (points - 1) for i in range(points)]


def partial_dependence(model: Model, df: DataFrame, columns: Sequence[str], *, points: int = GRID_POINTS) -> DataFrame:
    """Average prediction with one column set to each grid value, all columns in one pass.

    The grid is a literal of at most ``points`` values per column; rows fan out over it narrowly.
    """
    grids = {c: dependence_grid(df, c, points=points) for c in columns}
    parts = []
    for c, grid in grids.items():
        # Values between whole numbers stay as they are: the column is a double wherever it is a number.
        kind = "double" if isinstance(df.schema[c].dataType, T.NumericType) else df.schema[c].dataType
        values = F.array(*[F.lit(v).cast(kind) for v in grid])
        rows = df.withColumn("grid", F.explode(values))
        rows = rows.withColumn("feature", F.lit(c)).withColumn(c, F.col("grid")).withColumn("grid", F.col("grid").cast("string"))
        parts.append(rows)
    scored = model.transform(reduce(DataFrame.unionByName, parts))
    return scored.groupBy("feature", "grid").agg(F.avg("prediction").alias("average"))


class LinearScorer(Model):
    """A fixed linear expression as a model: a scorer any engine can repeat."""

    def __init__(self, weights: dict[str, float], intercept: float = 0.0, levels: dict[str, float] | None = None,
                 level_column: str = "ocean_proximity"):
        super().__init__()
        self.weights, self.intercept = weights, intercept
        self.levels, self.level_column = levels or {}, level_column

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for c, w in self.weights.items():
            total = total + F.lit(w) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        for level, w in self.levels.items():
            total = total + F.when(F.col(self.level_column) == level, F.lit(w)).otherwise(F.lit(0.0))
        return total

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("prediction", self.score())
