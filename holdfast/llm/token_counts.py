"""Token counts by a two-tier lookup on the map side.

A text is cut into pre-tokens where the model's pieces cannot reach across, so its token count is the sum of its
pre-tokens' counts. Tier one is a compact table of the most frequent pre-tokens and their counts, broadcast; tier two is
a bounded cache in each Python worker, filled by encoding what tier one misses with the library itself. No pre-token of
the documents is shuffled: the frequent ones are found from one bounded summary per task.

The table only saves work; counts do not depend on it. It holds at most ``FREQUENT`` pre-tokens of at most ``KEPT_CHARS``
characters, which bounds the broadcast to some 20 MB whatever the corpus.

Null and empty texts have no bytes and no tokens. Rows alike get equal counts. Other columns pass through. An empty
table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import free_name, text_of
from holdfast.llm.pieces import KEPT_CHARS, MODEL, Lattice, model_path, word_keys

#: Pre-tokens in the broadcast table; a task's summary names at most ``PER_TASK`` and keeps at most ``HELD`` meanwhile.
FREQUENT = 1 << 15
PER_TASK = 1 << 12
HELD = 1 << 18
#: Pre-tokens that a worker's cache holds before it starts anew.
CACHED = 500_000


class Library:
    """The library's own encoder, asked for one pre-token at a time."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        pieces = {n: (i, 0.0) for i, n in enumerate(names) if not (self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i))}
        self.cuts = Lattice(pieces, [], merges=False).words_apart

    def tokens(self, key: str) -> int:
        """Tokens of a pre-token; one that starts with a line feed has no space before it, so the model's own is taken off."""
        if not key:
            return 1
        return len(self.model.encode(key, num_threads=1)) - (key[0] == "\n")


class Counts(dict):
    """Token counts by pre-token: the broadcast table, then what this worker has met, then the library."""

    def __init__(self, path: str, table: dict[str, int]):
        super().__init__(table)
        self.library, self.table = Library(path), table

    def __missing__(self, key: str) -> int:
        found = self.library.tokens(key)
        if len(key) <= KEPT_CHARS:
            if len(self) >= CACHED:
                self.clear()
                self.update(self.table)
            self[key] = found
        return found

    def of(self, text: str) -> int:
        if not self.library.cuts:
            return len(self.library.model.encode(text, num_threads=1))
        return sum(map(self.__getitem__, word_keys(text)))


_COUNTS: dict[str, Counts] = {}


def worker_counts(path: str, mark: str, shared: Broadcast) -> Counts:
    """This worker's counts for the table that ``mark`` names; the last one is kept between tasks."""
    if mark not in _COUNTS:
        _COUNTS.clear()
        _COUNTS[mark] = Counts(path, shared.value)
    return _COUNTS[mark]


def frequent(docs: DataFrame, *, text: str = "text", keep: int = FREQUENT, per_task: int = PER_TASK, held: int = HELD) -> DataFrame:
    """key, n: the most frequent pre-tokens of all documents, from the most frequent of each task."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0):
                seen.update(word_keys(value.as_py()))
                if len(seen) > held:
                    seen = Counter(dict(seen.most_common(held // 2)))
        top = [(k, n) for k, n in seen.most_common(per_task) if len(k) <= KEPT_CHARS]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["key", "n"])

    parts = docs.select(text_of(text).alias("text")).mapInArrow(summary, "key string, n long")
    return parts.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(keep)


def length_table(docs: DataFrame, *, text: str = "text", model: str = MODEL, keep: int = FREQUENT) -> dict[str, int]:
    """The frequent pre-tokens and their token counts, encoded by the tasks that hold them; at most ``keep`` entries."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Library(model_path(model))
        for batch in batches:
            keys = batch.column(0)
            yield pa.RecordBatch.from_arrays([keys, pa.array([own.tokens(k) for k in keys.to_pylist()], pa.int32())], ["key", "n"])

    rows = frequent(docs, text=text, keep=keep).select("key").mapInArrow(lengths, "key string, n int")
    return {r["key"]: r["n"] for r in rows.toLocalIterator()}


def count_tokens(docs: DataFrame, *, text: str = "text", count: str = "n_tokens", model: str = MODEL, keep: int = FREQUENT) -> DataFrame:
    """``docs`` with the number of tokens that the library for ``model`` gives, without begin, end or added specials."""
    if count in docs.columns:
        raise ValueError(f"there is a column {count} already")
    shared = docs.sparkSession.sparkContext.broadcast(length_table(docs, text=text, model=model, keep=keep))
    mark = uuid.uuid4().hex
    schema = T.StructType([*docs.schema.fields, T.StructField(count, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_counts(model_path(model), mark, shared)
        for batch in batches:
            last = batch.num_columns - 1
            found = np.fromiter((own.of(v.as_py()) for v in batch.column(last)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(last)], pa.array(found)], schema.fieldNames())

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], text_of(text).alias(free_name(docs, "text"))).mapInArrow(run, schema)
