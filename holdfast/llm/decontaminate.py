"""Benchmark decontamination: prefix-filtered join of document words with the windows of benchmark items.

A window is a run of ``window`` item words (an item of fewer words is one window). A document holds a window only if it
holds each of its words, so for exact containment the necessary prefix of a window, its words put in order of rarity,
is its rarest word. Only places with such a word are looked at; the word's place in the window and the window's length
must leave the window inside the document, and then the words are compared.

Rarity is the number of documents with the word, counted over all documents. Items are taken in blocks of at most
``BLOCK_WINDOWS`` distinct windows; a block's windows and counts are what is broadcast, whatever the size of the
benchmark. Documents are never shuffled and never joined with each other, so frequent passages make no hot key.

Null and empty texts have no words: such documents have no hits, such items no window. Items alike share windows and
are all reported; an item whose id is null marks words but is not listed. Repeated documents get equal results. Other
columns pass through. An empty table on either side gives no hits.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import folded_words, free_name, text_of

WINDOW = 10
#: Distinct windows that are broadcast at a time.
BLOCK_WINDOWS = 100_000

class Probe(NamedTuple):
    """A window as found from its rarest word: the word's place in it, all its words, the items that have it."""

    place: int
    words: tuple[bytes, ...]
    items: tuple[str, ...]


def windows(items: DataFrame, *, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """words (array of binary), items (distinct ids as strings, sorted): the distinct windows of all items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = folded_words(value.as_buffer().to_pybytes())
                for start in range(max(1, len(words) - window + 1) if words else 0):
                    ids.append(name)
                    found.append(words[start : start + window])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.list_(pa.binary()))], ["item", "words"])

    narrow = items.select(F.col(item).cast("string").alias("item"), text_of(text).alias("text"))
    rows = narrow.mapInArrow(cut, "item string, words array<binary>")
    return rows.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def word_rarity(docs: DataFrame, words: set[bytes], *, text: str = "text") -> dict[bytes, int]:
    """The number of documents that hold each of ``words``; one task sends one row per word it has met."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0):
                seen.update(shared.value.intersection(folded_words(value.as_buffer().to_pybytes())))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    counts = docs.select(text_of(text).alias("text")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counts.toLocalIterator()}


def prefix_index(block: list[tuple[list[bytes], list[str]]], rarity: dict[bytes, int]) -> dict[bytes, list[Probe]]:
    """The windows of a block by their rarest word; the smaller word, then the first place, wins a tie."""
    index: dict[bytes, list[Probe]] = defaultdict(list)
    for words, items in block:
        place = min(range(len(words)), key=lambda i: (rarity.get(words[i], 0), words[i], i))
        index[words[place]].append(Probe(place, tuple(words), tuple(items)))
    return dict(index)


def find(words: list[bytes], index: dict[bytes, list[Probe]]) -> tuple[list[tuple[int, int]], set[str]]:
    """The places (first word, one past the last) of windows in ``words`` and the items they belong to."""
    spans: set[tuple[int, int]] = set()
    items: set[str] = set()
    for at, word in enumerate(words):
        if word not in index:
            continue
        for place, wanted, owners in index[word]:
            start, end = at - place, at - place + len(wanted)
            if start >= 0 and end <= len(words) and words[start:end] == list(wanted):
                spans.add((start, end))
                items.update(owners)
    return sorted(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, with those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_MARK = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_MARK_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("items", pa.list_(pa.string())),
])


def contamination(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_windows: int = BLOCK_WINDOWS, mark: str = "contamination",
) -> DataFrame:
    """``docs`` with a struct column ``mark``: n_words, spans of hit words (merged, end excluded) and items (sorted)."""
    if mark in docs.columns:
        raise ValueError(f"there is a column {mark} already")
    context = docs.sparkSession.sparkContext
    found = windows(items, item=item, text=item_text, window=window)
    out = docs.withColumn(mark, F.lit(None).cast(_MARK))
    schema = T.StructType([*docs.schema.fields, T.StructField(mark, _MARK)])
    folded = free_name(out, "folded")
    block: list[tuple[list[bytes], list[str]]] = []

    def through(df: DataFrame, block: list[tuple[list[bytes], list[str]]]) -> DataFrame:
        rarity = word_rarity(docs, {w for words, _ in block for w in words}, text=text) if block else {}
        shared = context.broadcast(prefix_index(block, rarity))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                marks = []
                texts = batch.column(batch.num_columns - 2)
                for value, before in zip(texts, batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                    words = folded_words(value.as_buffer().to_pybytes())
                    spans, names = find(words, shared.value)
                    if before:
                        spans += [(s["start"], s["end"]) for s in before["spans"]]
                        names |= set(before["items"])
                    marks.append({"n_words": len(words), "spans": [{"start": a, "end": b} for a, b in merged(spans)], "items": sorted(names)})
                kept = [batch.column(i) for i in range(batch.num_columns - 2)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(marks, _MARK_ARROW)], schema.fieldNames())

        return df.select(*[F.col(f"`{c}`") for c in docs.columns], text_of(text).alias(folded), F.col(mark)).mapInArrow(run, schema)

    for row in found.toLocalIterator():
        block.append(([bytes(w) for w in row["words"]], list(row["items"])))
        if len(block) == block_windows:
            out, block = through(out, block), []
    return through(out, block)


def clean_documents(docs: DataFrame, items: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit, all columns as they were."""
    mark = free_name(docs, "contamination")
    marked = contamination(docs, items, text=text, item=item, item_text=item_text, mark=mark)
    return marked.filter(F.size(F.col(mark)["spans"]) == 0).drop(mark)
