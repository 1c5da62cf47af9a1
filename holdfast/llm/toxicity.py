"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other; each category's model sees which words a text holds and the log odds
that the models before it gave. In training those are out-of-fold: a text's earlier probabilities come from models
that were trained on the other folds, so a later model meets them as it will meet them on new texts. A fold's model
chooses its own words (by the likelihood-ratio statistic against the category, on its training rows) and fits a ridge
logistic regression by Newton steps. The rows that train are a bounded sample, so a category's models are trained one after the other in one task.

At most ``SAMPLE`` labelled documents that are in the table are used for training, the first in the order of a hash of their key: the bound
is what keeps a training task's memory fixed. Every document is scored, in one narrow pass; the broadcast model has at
most ``WORDS`` words a category.

Null and empty texts hold no word. A label that is null does not train its category; documents with several label rows
take the largest label; copies of a text train once, with the labels of the first by key hash. With one class only, a category's probability is its smoothed rate;
without a row that trains it, the probability is null and the category rejects nothing. Null keys never match a label but are scored. Rows alike get rows alike; other columns pass through; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import cut, folded_words, free_name, text_of

#: Labelled documents that train the chain, folds, words of a category's model.
SAMPLE, FOLDS, WORDS = 20_000, 4, 256
#: For a word to be a feature: the least share of either class that has it, and the least statistic (a chance of one in 10 ** 5).
LEAST_SHARE, LEAST_STATISTIC = 0.01, 20.0
RIDGE, NEWTON_STEPS = 1.0, 25
THRESHOLD = 0.5
PUNCTUATION = tuple(bytes([b]) for b in range(33, 127) if not chr(b).isalnum())


class Category(NamedTuple):
    """A category and the condition on the label columns that makes a labelled document one of its kind."""

    name: str
    label: str


#: Junk is no toxicity itself; its probability helps the two that are.
CATEGORIES = (Category("junk", "quality = 0"), Category("toxic", "toxic = 1"), Category("toxic_prose", "toxic = 1 and quality = 1"))


class Model(NamedTuple):
    """A linear model: bias (None: no row trained it), weights of words (by hash), weights of the earlier categories' log odds."""

    bias: float | None
    words: dict[int, float]
    before: tuple[float, ...]

    def odds(self, present: Iterable[int], before: Sequence[float]) -> float:
        if self.bias is None:
            return 0.0
        return self.bias + sum(self.words.get(w, 0.0) for w in present) + sum(a * b for a, b in zip(self.before, before, strict=True))


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, case folded, and which ASCII punctuation marks it has."""
    return folded_words(text) + [mark for mark in PUNCTUATION if mark in text]


def hashes(text: bytes) -> set[int]:
    """The tokens' 32-bit hashes: words that share one are one feature."""
    return set(map(crc32, tokens(text)))


def statistic(with_word: np.ndarray, positive_with: np.ndarray, rows: int, positive: int) -> np.ndarray:
    """The likelihood-ratio statistic of the two-by-two tables of words against a category."""
    out = np.zeros(len(with_word))
    for total, hits in ((with_word, positive_with), (rows - with_word, positive - positive_with)):
        for seen, share in ((hits, positive / rows), (total - hits, 1 - positive / rows)):
            with np.errstate(divide="ignore", invalid="ignore"):
                out += np.where(seen > 0, 2 * seen * np.log(seen / (total * share)), 0.0)
    return out


def fit(texts: pa.ListArray, before: np.ndarray, y: np.ndarray) -> Model:
    """One category's model from the distinct word hashes of texts, earlier log odds (rows x categories) and labels."""
    rows, positive = len(y), int(y.sum())
    if not rows:
        return Model(None, {}, (0.0,) * before.shape[1])
    if not 0 < positive < rows:
        return Model(float(np.log((positive + 0.5) / (rows - positive + 0.5))), {}, (0.0,) * before.shape[1])
    names, code = np.unique(texts.flatten().to_numpy(), return_inverse=True)
    owner = np.repeat(np.arange(rows), np.diff(texts.offsets.to_numpy()))
    seen = np.bincount(code, minlength=len(names))
    hits = np.bincount(code, y[owner], len(names))
    common = (hits >= LEAST_SHARE * positive) | (seen - hits >= LEAST_SHARE * (rows - positive))
    worth = np.where(common, statistic(seen, hits, rows, positive), 0.0)
    ranked = [i for i in np.argsort(-worth, kind="stable")[: 4 * WORDS].tolist() if worth[i] >= LEAST_STATISTIC]
    chosen = sorted(ranked, key=lambda i: (-worth[i], names[i]))[:WORDS]
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((rows, len(chosen) + before.shape[1] + 1), np.float32)
    kept = place[code] >= 0
    x[owner[kept], place[code[kept]]] = 1
    x[:, len(chosen) : -1] = before
    x[:, -1] = 1
    beta = np.zeros(x.shape[1])
    beta[-1] = np.log(positive / (rows - positive))
    ridge = np.full(len(beta), RIDGE)
    ridge[-1] = 1e-6
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - ridge * beta
        slope = (x * (p * (1 - p) + 1e-6)[:, None].astype(np.float32)).T @ x
        step = np.linalg.solve(slope.astype(np.float64) + np.diag(ridge), gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-3:
            break
    words = {int(names[i]): float(b) for i, b in zip(chosen, beta, strict=False)}
    return Model(float(beta[-1]), words, tuple(beta[len(chosen) : -1].tolist()))


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: Sequence[Category], *, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """row, fold, words (distinct hashes) and y (one label per category, null where unknown) of at most ``sample`` documents."""
    asked = [F.max(F.expr(c.label).cast("int")).alias(f"y{i}") for i, c in enumerate(categories)]
    order = F.xxhash64("key")
    present = docs.filter(F.col(key).isNotNull()).select(key)
    chosen = (
        labels.join(present, key, "left_semi").groupBy(F.col(key).alias("key")).agg(*asked).orderBy(order, "key").limit(sample)
        .select("key", F.array(*[f"y{i}" for i in range(len(categories))]).alias("y"), F.pmod(F.xxhash64("key", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"))
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [np.sort(np.fromiter(hashes(v.as_buffer().to_pybytes()), np.uint32).view(np.int32)) for v in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(words, pa.list_(pa.int32()))], ["row", "fold", "y", "words"])

    texts = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    #: at most ``sample`` small rows are broadcast
    met = texts.join(F.broadcast(chosen), "key").select(F.xxhash64("key").alias("row"), "fold", "y", "text")
    once = met.groupBy(F.sha2("text", 256).alias("same")).agg(F.min(F.struct("row", "fold", "y", "text")).alias("first")).select("first.*")
    return once.dropDuplicates(["row"]).mapInArrow(split, "row long, fold int, y array<int>, words array<int>")


def _trainer(at: int) -> Callable[[pa.Table], pa.Table]:
    """Trains category ``at`` on all folds but one and tells that fold's odds, for each fold; then on all, which gives the model.

    The rows are a sample of bounded size, so they are sent once, to one task, and not once for each fold.
    """

    def one(table: pa.Table) -> pa.Table:
        fold = table.column("fold").to_numpy()
        y = np.array([labels[at] if labels[at] is not None else -1 for labels in table.column("y").to_pylist()])
        before = np.array(table.column("before").to_pylist(), np.float64).reshape(len(y), at)
        texts = pa.concat_arrays(table.column("words").chunks)
        rows = table.column("row").to_numpy()
        in_order = np.argsort(rows, kind="stable")

        def without(left_out: int) -> Model:
            order = in_order[(fold[in_order] != left_out) & (y[in_order] >= 0)]
            return fit(texts.take(pa.array(order)), before[order], y[order].astype(np.float64))

        odds = np.zeros(len(rows))
        for left_out in range(FOLDS):
            got = without(left_out)
            for i in np.flatnonzero(fold == left_out).tolist():
                odds[i] = min(9.2, max(-9.2, got.odds(texts[i].values.to_pylist(), before[i])))
        whole = without(FOLDS)
        pa.default_memory_pool().release_unused()
        nothing = [None] * len(rows)
        return pa.table({
            "row": pa.array([*rows.tolist(), None], pa.int64()),
            "odds": pa.array([*odds.tolist(), None], pa.float64()),
            "names": pa.array([*nothing, list(whole.words)], pa.list_(pa.int32())),
            "values": pa.array([*nothing, [whole.bias, *whole.before, *whole.words.values()]], pa.list_(pa.float64())),
        })

    return one


def train(docs: DataFrame, labels: DataFrame, categories: Sequence[Category] = CATEGORIES, *, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> list[Model]:
    """The chain's models, one per category, each trained on all labelled rows with out-of-fold odds of the ones before."""
    rows = cut(labelled_sample(docs, labels, categories, key=key, text=text, sample=sample))
    earlier = rows.select("row", F.array().cast("array<double>").alias("before"))
    models: list[Model] = []
    for at in range(len(categories)):
        #: one small row for each of at most ``sample`` documents
        ready = rows.join(F.broadcast(earlier), "row").withColumn("all", F.lit(True)).groupBy("all")
        got = cut(ready.applyInArrow(_trainer(at), "row long, odds double, names array<int>, values array<double>"))
        final = got.filter(F.col("values").isNotNull()).first()
        if final is None:
            models.append(Model(None, {}, (0.0,) * at))
            continue
        values = list(final["values"])
        models.append(Model(values[0], {n: v for n, v in zip(final["names"], values[1 + at :], strict=True)}, tuple(values[1 : 1 + at])))
        if at + 1 < len(categories):
            odds = got.filter(F.col("values").isNull()).select("row", "odds")
            earlier = cut(earlier.join(odds, "row").select("row", F.concat("before", F.array("odds")).alias("before")))
    return models


def classify(
    docs: DataFrame, models: Sequence[Model], categories: Sequence[Category] = CATEGORIES, *, text: str = "text", into: str = "toxicity"
) -> DataFrame:
    """``docs`` with a struct of each category's probability (null: no row trained the category)."""
    if into in docs.columns:
        raise ValueError(f"there is a column {into} already")
    kind = T.StructType([T.StructField(c.name, T.DoubleType()) for c in categories])
    schema = T.StructType([*docs.schema.fields, T.StructField(into, kind)])
    arrow = pa.struct([(c.name, pa.float64()) for c in categories])
    shared = docs.sparkSession.sparkContext.broadcast((list(models), frozenset(w & 0xFFFFFFFF for m in models for w in m.words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, known = shared.value
        for batch in batches:
            last, told = batch.num_columns - 1, []
            for value in batch.column(last):
                found = np.fromiter(known.intersection(map(crc32, tokens(value.as_buffer().to_pybytes()))), np.uint32)
                present = np.sort(found.view(np.int32)).tolist()
                odds: list[float] = []
                for model in chain:
                    odds.append(min(9.2, max(-9.2, model.odds(present, odds))))
                told.append({c.name: None if m.bias is None else float(1 / (1 + np.exp(-o))) for c, m, o in zip(categories, chain, odds, strict=True)})
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(last)], pa.array(told, arrow)], schema.fieldNames())

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], text_of(text).alias(free_name(docs, "text"))).mapInArrow(run, schema)


def is_toxic(into: str = "toxicity", category: str = "toxic", threshold: float = THRESHOLD) -> Column:
    return F.coalesce(F.col(into)[category] >= threshold, F.lit(False))


def clean_documents(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the chain doesn't call toxic, all columns as they were."""
    into = free_name(docs, "toxicity")
    told = classify(docs, train(docs, labels, key=key, text=text), text=text, into=into)
    return told.filter(~is_toxic(into)).drop(into)
