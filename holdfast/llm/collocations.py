"""Phrase collocation mining with an FM-index per shard over word ids.

A task cuts its texts into shards of at most ``SHARD_WORDS`` words, whatever documents they come from. A shard numbers
its words (a word of another language is another word) and holds the Burrows-Wheeler transform of its ids read in both
directions. A phrase is a pair of intervals, one in each transform; extending it by a word on the right or on the left
is one backward step in one of them, and the other interval follows from the counts of smaller ids. All intervals of
one length are extended at once, on alternating sides, down to the length asked for; an interval's size is the phrase's
count in the shard. Since no phrase is longer than the depth, suffixes need sorting by their first ``depth`` words only.

Counts of a phrase are summed across shards by Spark. There is one pass for each phrase length: a phrase of n words can
only reach the least count if its first and its last n - 1 words do, so what a pass has found is handed to the next as
a sieve, a Bloom filter of at most ``8 * SIEVE_WORDS`` bytes whatever the corpus, and shards leave out what it refuses. A
sieve never refuses a phrase that belongs to it, and what it lets through too much falls to the exact sums: results do
not depend on its size. A run of words longer than a shard is continued in the next one with the words in between
repeated, so that every occurrence lies in exactly one shard.

A null text has no words; a null language is ``und``. Repeated documents count again. Equal scores are put in order by
count and phrase. Columns other than text and language are not read. An empty table, and one without frequent phrases,
gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import text_of, written

#: Words of a shard; an index takes some 100 bytes a word while it is built.
SHARD_WORDS = 1 << 20
#: Bytes of a text that are split at a time.
CHUNK = 1 << 22
#: 64-bit words of a sieve at most (32 MB); bits set for each phrase, all in one word.
SIEVE_WORDS, SIEVE_BITS = 1 << 22, 4
#: Parts that the phrases of one frequent word are dealt to when they meet its count.
SALTS = 16
#: Words end at spaces and tabs; phrases also end at these, and A-Z are lower-cased.
_STOPS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(46 if b in _STOPS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_GAPS = b" \t."


def split_words(text: bytes) -> Iterator[list[bytes]]:
    """The words of ``text`` in runs, a full stop between any two pieces."""
    at = 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and _FOLD[text[end]] not in _GAPS:
            end += 1
        yield text[at:end].translate(_FOLD).replace(b".", b" . ").split()
        at = end


class FmIndex:
    """Both transforms of a sequence of ids, exact for patterns of at most ``depth`` ids; id 0 separates and is never part of a pattern."""

    def __init__(self, ids: np.ndarray, size: int, depth: int):
        #: a separator at either end, so that every word has neighbours
        self.ids = np.concatenate([[0], ids, [0]]).astype(np.int64)
        self.size, self.depth = size, depth
        #: where the rows that start with an id begin
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.ids, minlength=size))])
        self._sides: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def side(self, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """The transform that tells what follows (``right``) or precedes a pattern, and its occurrences as sorted (id, row) pairs."""
        if right not in self._sides:
            text = self.ids[::-1] if right else self.ids
            n = len(text)
            key = text
            if self.depth > 1:
                padded = np.concatenate([text, np.zeros(self.depth, np.int64)])
                for place in range(1, self.depth):
                    if int(key.max(initial=0)) > (1 << 62) // self.size:
                        key = np.unique(key, return_inverse=True)[1]
                    key = key * self.size + padded[place : place + n]
            bwt = text[np.argsort(key, kind="stable") - 1]
            self._sides[right] = bwt, np.sort(bwt * n + np.arange(n))
        return self._sides[right]

    def rank_start(self, right: bool, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The backward step: the row where the patterns that ``ids`` extend begin, for intervals that begin at ``rows``."""
        return np.searchsorted(self.side(right)[1], ids * len(self.ids) + rows)


class Patterns:
    """All patterns of one length with their intervals in both directions."""

    def __init__(self, words: np.ndarray, starts: dict[bool, np.ndarray], sizes: np.ndarray):
        self.words, self.starts, self.sizes = words, starts, sizes

    def kept(self, mask: np.ndarray) -> Patterns:
        return Patterns(self.words[mask], {side: s[mask] for side, s in self.starts.items()}, self.sizes[mask])


def single_words(index: FmIndex) -> Patterns:
    present = np.flatnonzero(np.diff(index.first))
    present = present[present > 0]
    starts = index.first[present]
    return Patterns(present[:, None], {True: starts, False: starts}, np.diff(index.first)[present])


def extended(index: FmIndex, patterns: Patterns, right: bool) -> Patterns:
    """Every pattern with every id that occurs on one side of it."""
    if not len(patterns.sizes):
        return Patterns(np.empty((0, patterns.words.shape[1] + 1), np.int64), patterns.starts, patterns.sizes)
    bwt, _ = index.side(right)
    ends = np.cumsum(patterns.sizes)
    owner = np.repeat(np.arange(len(ends)), patterns.sizes)
    rows = np.arange(ends[-1]) + np.repeat(patterns.starts[right] - (ends - patterns.sizes), patterns.sizes)
    pairs = np.sort(owner * index.size + bwt[rows])
    cuts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    sizes = np.diff(np.concatenate([cuts, [len(pairs)]]))
    owner, ids = np.divmod(pairs[cuts], index.size)
    #: in the other direction the longer pattern's rows lie inside the shorter one's, after those of smaller ids
    other = patterns.starts[not right][owner] + cuts - (ends - patterns.sizes)[owner]
    here = index.rank_start(right, ids, patterns.starts[right][owner])
    old, new = patterns.words[owner], ids[:, None]
    words = np.concatenate([old, new] if right else [new, old], axis=1)
    return Patterns(words, {right: here, not right: other}, sizes).kept(ids > 0)


def phrase_hash(word_hashes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the rows of a matrix of word hashes."""
    with np.errstate(over="ignore"):
        h = np.full(len(word_hashes), 0x9E3779B97F4A7C15, np.uint64)
        for column in word_hashes.T:
            h = (h ^ column) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
    return h


def sieve_cells(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each phrase the word of the sieve and the bits in it."""
    cell = (hashes >> np.uint64(24)) % np.uint64(size)
    mask = np.zeros(len(hashes), np.uint64)
    for i in range(SIEVE_BITS):
        mask |= np.uint64(1) << ((hashes >> np.uint64(6 * i)) & np.uint64(63))
    return cell.astype(np.int64), mask


def passes(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    cell, mask = sieve_cells(hashes, len(sieve))
    return (sieve[cell] & mask) == mask


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang.encode()) & 0xFFFFFFFF)


class Shard:
    """Words of a task's texts, numbered as they come."""

    def __init__(self, length: int, sieves: list[np.ndarray]):
        self.length, self.sieves = length, sieves
        self.clear()

    def clear(self) -> None:
        fresh = count(1).__next__
        self.ids: dict[str, defaultdict[bytes, int]] = defaultdict(lambda: defaultdict(fresh))
        self.parts: list[np.ndarray] = []
        self.held = 0
        #: the last words, one fewer than a phrase has
        self.tail: list[bytes] = []

    def add(self, lang: str, words: list[bytes]) -> None:
        known = self.ids[lang]
        known[b"."] = 0
        self.parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        self.held += len(words)
        most = self.length - 1
        self.tail = (self.tail + words[-most:])[-most:] if most else []

    def open_words(self) -> list[bytes]:
        """The last words since the last separator: phrases that begin with them may end in the next shard."""
        stop = next((i for i, w in enumerate(reversed(self.tail)) if w == b"."), len(self.tail))
        return self.tail[len(self.tail) - stop :]

    def phrases(self) -> tuple[pa.Array, pa.Array, pa.Array]:
        """lang, phrase, count of the shard's phrases that the sieves let through."""
        words, langs = [b""], [""]
        rows = sorted((i, w, lang) for lang, known in self.ids.items() for w, i in known.items() if i)
        words += [w for _, w, _ in rows]
        langs += [lang for _, _, lang in rows]
        ids = np.concatenate([np.empty(0, np.int32), *self.parts])
        hashes = np.zeros(len(words), np.uint64)
        if self.sieves:
            hashes[1:] = np.fromiter((word_hash(lang, w) for _, w, lang in rows), np.uint64, len(rows))
            known = passes(self.sieves[0], phrase_hash(hashes[:, None]))
            known[0] = False
            ids = np.where(known[ids], ids, 0)
        index = FmIndex(ids, len(words), self.length)
        found = single_words(index)
        for n in range(2, self.length + 1):
            right = n % 2 == 0
            found = extended(index, found, right)
            if n < self.length:
                found = found.kept(passes(self.sieves[n - 1], phrase_hash(hashes[found.words])))
            elif n > 2:
                new = found.words[:, 1:] if right else found.words[:, :-1]
                found = found.kept(passes(self.sieves[n - 2], phrase_hash(hashes[new])))
        texts = pa.array(words, pa.binary()).cast(pa.string())
        columns = [texts.take(pa.array(found.words[:, i])) for i in range(self.length)]
        phrase = pc.binary_join_element_wise(*columns, " ") if self.length > 1 else columns[0]
        return pa.array(langs, pa.string()).take(pa.array(found.words[:, 0])), phrase, pa.array(found.sizes.astype(np.int64))


_COUNTS = "lang string, phrase string, n long"


def shard_counts(docs: DataFrame, length: int, sieves: list, *, text: str = "text", lang: str = "lang", shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, phrase, n: occurrences of every phrase of ``length`` words in every shard; of single words also their number by
    language, with a null phrase. ``sieves`` are broadcasts, one for each shorter length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(length, [s.value for s in sieves])
        totals: dict[str, int] = defaultdict(int)

        def flush() -> Iterator[pa.RecordBatch]:
            found = shard.phrases()
            shard.clear()
            for start in range(0, len(found[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([c.slice(start, 1 << 16) for c in found], ["lang", "phrase", "n"])

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for words in split_words(value.as_buffer().to_pybytes()):
                    totals[name] += len(words) - words.count(b".")
                    for start in range(0, len(words), shard_words):
                        part = words[start : start + shard_words]
                        shard.add(name, part)
                        if shard.held >= shard_words:
                            unfinished = shard.open_words()
                            yield from flush()
                            shard.add(name, unfinished)
                shard.add(name, [b"."])
        yield from flush()
        if length == 1:
            langs = sorted(totals)
            counts = [pa.array(langs, pa.string()), pa.nulls(len(langs), pa.string()), pa.array([totals[k] for k in langs], pa.int64())]
            yield pa.RecordBatch.from_arrays(counts, ["lang", "phrase", "n"])

    narrow = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), text_of(f"`{text}`").alias("text"))
    return narrow.mapInArrow(run, _COUNTS)


def make_sieve(frequent: DataFrame, length: int, size: int = SIEVE_WORDS) -> np.ndarray:
    """The sieve of the phrases of ``length`` words in ``frequent`` (lang, phrase); its bits are gathered by Spark."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            hashes = [[word_hash(lang, w) for w in phrase.encode().split(b" ")] for lang, phrase in rows]
            cell, mask = sieve_cells(phrase_hash(np.array(hashes, np.uint64).reshape(-1, length)), size)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(mask.view(np.int64))], ["cell", "mask"])

    rows = frequent.select("lang", "phrase").mapInArrow(cells, "cell long, mask long").groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()
    sieve = np.zeros(size, np.uint64)
    sieve[rows["cell"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
    return sieve


def count_phrases(docs: DataFrame, *, longest: int = 3, least: int = 10, sieve_words: int = SIEVE_WORDS, **options) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, size, n of all phrases of one to ``longest`` words that occur ``least`` times or more, and lang, n of all
    words. Both are written to the shared folder, one pass over the documents for each length."""
    context = docs.sparkSession.sparkContext
    sieves, levels, totals = [], [], None
    for size in range(1, longest + 1):
        summed = shard_counts(docs, size, sieves, **options).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        level = written(summed.where(F.col("phrase").isNull() | (F.col("n") >= least)).withColumn("size", F.lit(size)), f"phrases-{size}")
        if size == 1:
            totals = level.where(F.col("phrase").isNull()).select("lang", "n")
        level = level.where(F.col("phrase").isNotNull())
        levels.append(level)
        if size < longest:
            #: sixteen bits a phrase, within the bound
            wanted = 1 << max(6, (level.count() // 4).bit_length())
            sieves.append(context.broadcast(make_sieve(level, size, min(wanted, sieve_words))))
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    return phrases.select("lang", "phrase", "size", "n"), totals


def score_phrases(phrases: DataFrame, *, longest: int = 3, share: int = 50) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates: phrases of two words or more that no longer one holds in ``share``
    per cent of their occurrences.

    A phrase meets the counts of the parts of each of its cuts; a frequent word has many phrases, so its count is sent to
    ``SALTS`` parts and its phrases are dealt among them. A million times the squared count is exact in 38 digits below 10^16.
    """
    candidates = phrases.where("size > 1").withColumnRenamed("n", "a")
    ways = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = ways.select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("before"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("after"), F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    parts = phrases.where(F.col("size") < longest).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    for part, name in (("before", "l"), ("after", "r")):
        cuts = cuts.join(parts.select("lang", "salt", F.col("phrase").alias(part), F.col("n").alias(name)), ["lang", "salt", part])
    wide = "decimal(19,0)"
    #: an integer division of exact products
    score = F.expr(f"(cast(a as {wide}) * cast(a as {wide}) * 1000000) div (cast(l as {wide}) * cast(r as {wide}))")
    scored = cuts.withColumn("cut", F.struct(score.alias("score"), "k", "l", "r")).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))
    inner = candidates.where("size > 2").withColumn("part", F.explode(_inner_parts()))
    holders = inner.groupBy("lang", F.col("part").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(holders, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _inner_parts() -> Column:
    """The different shorter phrases of two words or more inside ``phrase``."""
    return F.expr(
        "array_distinct(flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), "
        "i -> array_join(slice(split(phrase, ' '), i, m), ' ')))))"
    )


def collocations(docs: DataFrame, *, longest: int = 3, least: int = 10, share: int = 50, first: int = 2000, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases by score, count and phrase.

    Spark ranks within each partition before rows of a language meet, so no task holds more than ``first`` rows a partition.
    """
    phrases, totals = count_phrases(docs, longest=longest, least=least, **options)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = score_phrases(phrases, longest=longest, share=share).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
