"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A text is taken with one space before it, which the second tokenizer adds by itself. The first gives character offsets,
the second byte spans in its proto; tokens that begin and end at the same character in both are coarse cuts. Where
several tokens share one character, or a byte-fallback token stands for a part of one, offsets can't tell them apart: there
the bytes that the tokens decode to are the finer cuts. The byte ends of all tokens follow, ends that both have in common
cut the tokens into groups, and between any two neighbouring ends lies the link of one token with one other.

Both models are seen to keep words apart (the first splits at white space before it merges, no piece of the second holds a
space after another character), so a text is cut before every space that follows anything but white space, and a word's
alignment does not depend on its surroundings. Each distinct word is aligned once by the libraries and kept in the worker's
bounded cache; longer words are aligned each time. Models without that property are given whole texts.

Texts that are null, empty, or whose tokens do not decode to the text itself have no tokens. Rows alike get equal
alignments and count as documents of their own. Other columns pass through; a column with the name of the result is refused. An
empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import text_of, written
from holdfast.llm.pieces import MODEL, SPACE, model_path

BYTE_MODEL = "byte_bpe_50k.json"
#: Words of at most so many characters are remembered, the last so many bytes of them and at most as many before them.
KEPT_CHARS, KEPT_BYTES = 48, 100 << 20
#: Words that are tokenized as one text.
AT_ONCE = 1024
#: Bytes that an entry of the cache takes beside its strings.
ENTRY = 400
#: Pairs that are broadcast at most; more of them are joined.
BROADCAST_PAIRS = 4_000_000
#: Distinct pairs that a task holds before it passes their counts on.
HELD_PAIRS = 1 << 20
#: Parts that the documents of one pair are dealt to.
SALTS = 16
#: Between anything but white space and a space that is not the last character.
_CUT = re.compile(r"(?<=\S)(?= [\s\S])")


#: The alignment of a text: its groups as ``a1,a2|b1;a3|b2``, the numbers of tokens and groups, the pair of every link as 64 bits.
#: A plain tuple, which the garbage collector needn't visit.
Aligned = tuple[str, int, int, int, bytes]


def byte_alphabet() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    table.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)})
    return table


def char_starts(raw: bytes) -> np.ndarray:
    """The byte at which each character of a text begins, and the end."""
    units = np.frombuffer(raw, np.uint8)
    return np.append(np.flatnonzero((units & 0xC0) != 0x80), len(units))


def refined(starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The byte ends of tokens: the coarse cuts between their spans, and inside a run of tokens that share bytes the lengths of
    what they decode to. Where a run decodes to other bytes than it spans, the lengths alone decide."""
    own = np.cumsum(lengths)
    #: a token that shares no byte with the next ends at a cut; tokens of an empty span belong to the next
    cut = (ends > starts) & np.append(starts[1:] >= ends[:-1], True)
    return np.where(cut, ends, own) if (own[cut] == ends[cut]).all() else own


class Pair:
    """Two tokenizers and this worker's cache of aligned words."""

    def __init__(self, first: str, second: str, kept_bytes: int = KEPT_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        table = byte_alphabet()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(table.get(c, 0) for c in n) for n in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(pieces)]
        self.a_length, self.b_length = (np.array([len(x) for x in xs]) for xs in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = (np.array(list(map(str, range(len(x)))), object) for x in (names, pieces))
        self.b_size = len(pieces)
        split = json.loads(self.a.to_str())
        before = split.get("pre_tokenizer") or {}
        spaces_first = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not split.get("normalizer")
        inside = any(SPACE in n.lstrip(SPACE) for i, n in enumerate(pieces) if not self.b.is_control(i))
        self.words_apart = bool(spaces_first) and not inside
        self.kept_bytes = kept_bytes
        self.known: dict[str, Aligned | None] = {}
        self.older: dict[str, Aligned | None] = {}
        self.held = 0

    def words(self, spaced: str) -> list[str]:
        """``spaced`` cut where neither tokenizer reaches across."""
        return _CUT.split(spaced) if self.words_apart else [spaced]

    def _align(self, words: list[str]) -> list[Aligned] | None:
        """The alignments of words that stand side by side, read as one text; None if its tokens decode to anything else."""
        spaced = "".join(words)
        raw = spaced.encode()
        encoding, places = self.a.encode(spaced, add_special_tokens=False), self.b.encode(spaced[1:], return_type="proto").pieces
        a, b = encoding.ids, [p.id for p in places]
        if b"".join([self.a_bytes[i] for i in a]) != raw or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        a_ids, b_ids = np.array(a, np.int64), np.array(b, np.int64)
        spans = char_starts(raw)[np.fromiter(chain.from_iterable(encoding.offsets), np.int64, 2 * len(a))]
        a_ends = refined(spans[::2], spans[1::2], self.a_length[a_ids])
        #: the proto counts from the given text, which lacks the first space
        begins, b_ends = (np.fromiter(x, np.int64, len(b)) + 1 for x in ((p.begin for p in places), (p.end for p in places)))
        begins[0] = 0
        b_ends = refined(begins, b_ends, self.b_length[b_ids])
        ends = np.union1d(a_ends, b_ends)
        pairs = a_ids[np.searchsorted(a_ends, ends)] * self.b_size + b_ids[np.searchsorted(b_ends, ends)]
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        #: tokens before each group, and the group of each token
        a_first, b_first = (np.append(0, np.searchsorted(x, common) + 1) for x in (a_ends, b_ends))
        a_of, b_of = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        #: names and what stands after them, the first tokenizer's tokens of a group before the second one's
        texts = np.full(2 * (len(a) + len(b)), ",", object)
        for names, ids, at in (
            (self.a_names, a_ids, np.arange(len(a)) + b_first[a_of]), (self.b_names, b_ids, np.arange(len(b)) + a_first[b_of + 1]),
        ):
            texts[2 * at] = names[ids]
        before = a_first + b_first
        texts[2 * (before[:-1] + np.diff(a_first)) - 1] = "|"
        texts[2 * before[1:] - 1] = ";"
        stops = np.cumsum([len(w.encode()) for w in words])
        groups = np.append(0, np.searchsorted(common, stops) + 1)
        links = np.append(0, np.searchsorted(ends, stops) + 1).tolist()
        a_at, b_at, tokens = a_first[groups].tolist(), b_first[groups].tolist(), (2 * before[groups]).tolist()
        groups, texts, raw_pairs = groups.tolist(), texts.tolist(), pairs.tobytes()
        return [
            ("".join(texts[tokens[i] : tokens[i + 1] - 1]), a_at[i + 1] - a_at[i], b_at[i + 1] - b_at[i], groups[i + 1] - groups[i],
             raw_pairs[8 * links[i] : 8 * links[i + 1]])
            for i in range(len(words))
        ]

    def _align_each(self, words: list[str]) -> Iterator[tuple[str, Aligned | None]]:
        """Words with their alignments; those that can stand side by side are aligned together."""
        together = [w for w in words if self.words_apart and SPACE not in w and not w[-1].isspace()]
        for start in range(0, len(together), AT_ONCE):
            part = together[start : start + AT_ONCE]
            found = self._align(part)
            yield from zip(part, found or [(self._align([w]) or [None])[0] for w in part], strict=True)
        for word in set(words).difference(together):
            yield word, (self._align([word]) or [None])[0]

    def _keep(self, word: str, found: Aligned | None) -> None:
        if len(word) <= KEPT_CHARS:
            self.held += ENTRY + 2 * len(word) + (len(found[0]) + len(found[4]) if found else 0)
            if self.held >= self.kept_bytes:
                self.known, self.older, self.held = {}, self.known, 0
            self.known[word] = found

    def align_all(self, texts: list[str]) -> list[Aligned | None]:
        """The alignments of whole texts; None for those without tokens."""
        cut = [self.words(" " + t) if t else [] for t in texts]
        known, older = self.known, self.older
        every = set().union(*cut)
        here = {w: known[w] for w in every if w in known}
        every.difference_update(here)
        new = {w: older[w] for w in every if w in older}
        every.difference_update(new)
        new.update(self._align_each(list(every)))
        here.update(new)
        out = []
        for words in cut:
            parts = [here[w] for w in words]
            if len(parts) == 1:
                out.append(parts[0])
            elif not parts or None in parts:
                out.append(None)
            else:
                groups, n_a, n_b, n_groups, pairs = zip(*parts, strict=True)
                out.append((";".join(groups), sum(n_a), sum(n_b), sum(n_groups), b"".join(pairs)))
        for word, found in new.items():
            self._keep(word, found)
        return out


@lru_cache(1)
def worker_pair(first: str, second: str, kept_bytes: int) -> Pair:
    return Pair(model_path(first), model_path(second), kept_bytes)


ALIGNMENT = T.StructType([
    T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()),
    T.StructField("groups", T.StringType()),
    #: a pair is its first id times the number of the second tokenizer's ids, plus its second id
    T.StructField("pairs", T.ArrayType(T.LongType())),
    T.StructField("times", T.ArrayType(T.IntegerType())),
])


def align(
    docs: DataFrame, *, text: str = "text", into: str = "alignment", first: str = BYTE_MODEL, second: str = MODEL, kept_bytes: int = KEPT_BYTES,
    at_once: int = 64,
) -> DataFrame:
    """``docs`` with the alignment of each text: numbers of tokens, groups and links, the groups, and the different pairs of ids
    in ascending order with their numbers of links."""
    if into in docs.columns:
        raise ValueError(f"there is a column {into} already")
    #: numbered names on the way through Python, which takes no dots in them
    given = [T.StructField(f"given_{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    schema = T.StructType([*given, T.StructField("made", ALIGNMENT)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_pair(first, second, kept_bytes)
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                last = part.num_columns - 1
                found = own.align_all(part.column(last).to_pylist())
                keys, times, ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [0]
                for one in found:
                    if one is not None:
                        key, n = np.unique(np.frombuffer(one[4], np.int64), return_counts=True)
                        keys.append(key)
                        times.append(n)
                    ends.append(ends[-1] + (len(key) if one is not None else 0))
                offsets = pa.array(ends, pa.int32())
                counts = [[o[i] if o else 0 for o in found] for i in (1, 2, 3)] + [[len(o[4]) // 8 if o else 0 for o in found]]
                columns = [
                    *[pa.array(c, pa.int64()) for c in counts], pa.array([o[0] if o else "" for o in found], pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(keys))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(times).astype(np.int32))),
                ]
                made = pa.StructArray.from_arrays(columns, ALIGNMENT.fieldNames())
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(last)], made], schema.fieldNames())

    named = [F.col(f"`{c}`").alias(f.name) for c, f in zip(docs.columns, given, strict=True)]
    return docs.select(*named, text_of(f"`{text}`").alias("made")).mapInArrow(run, schema).toDF(*docs.columns, into)


def pair_counts(aligned: DataFrame, size: int, *, pairs: str = "pairs", held: int = HELD_PAIRS) -> DataFrame:
    """pair, n, best: in how many documents each pair of ids is linked, and whether no pair of its first id is in more.

    Tasks add up their documents before anything is shuffled; ``size`` is the number of ids of the second tokenizer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            both = np.concatenate([keys, batch.column(0).flatten().to_numpy(zero_copy_only=False)])
            weight = np.concatenate([counts, np.ones(len(both) - len(keys), np.int64)])
            keys, where = np.unique(both, return_inverse=True)
            counts = np.bincount(where, weights=weight, minlength=len(keys)).astype(np.int64)
            if len(keys) >= held:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["pair", "n"])
                keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["pair", "n"])

    summed = aligned.select(F.col(pairs)).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    #: a first id has at most ``size`` pairs
    of_first = Window.partitionBy(F.expr(f"pair div {size}"))
    return summed.withColumn("best", F.col("n") == F.max("n").over(of_first))


def link_scores(aligned: DataFrame, counts: DataFrame, *, most: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` (with a unique ``row``, ``pairs`` and ``times``) with n_best, links whose pair is its first id's best, and
    count_sum, the counts of all its links added up.

    Up to ``most`` pairs are broadcast as sorted arrays; beyond that the pairs of the documents meet the counts in a join,
    the pairs that many documents share dealt to ``SALTS`` parts.
    """
    if counts.count() <= most:
        table = counts.orderBy("pair").toArrow()
        shared = aligned.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "n", "best")))
        schema = T.StructType([*aligned.schema.fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
        at_pairs, at_times = aligned.columns.index("pairs"), aligned.columns.index("times")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pair, n, best = shared.value
            for batch in batches:
                lists = batch.column(at_pairs)
                times = batch.column(at_times).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                at = np.searchsorted(pair, lists.flatten().to_numpy(zero_copy_only=False))
                ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
                sums = [np.concatenate([[0], np.cumsum(x)])[ends] for x in (times * best[at], times * n[at])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(np.diff(s)) for s in sums]], schema.fieldNames())

        return aligned.mapInArrow(run, schema)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"), F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt"))
    dealt = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    of_row = links.join(dealt, ["pair", "salt"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    joined = aligned.join(of_row, "row", "left")
    return joined.select(*aligned.columns, *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")])


def score_alignments(aligned: DataFrame, *, into: str = "alignment", second: str = MODEL, most: int = BROADCAST_PAIRS, held: int = HELD_PAIRS) -> DataFrame:
    """The rows of ``align`` with n_best and count_sum as further fields of the alignment.

    The alignments are written once to the shared folder, so texts are not tokenized again when the counts are known.
    """
    import sentencepiece

    size = sentencepiece.SentencePieceProcessor(model_file=model_path(second)).get_piece_size()
    given = {f"given_{i}": c for i, c in enumerate(c for c in aligned.columns if c != into)}
    own = [F.col(f"`{c}`").alias(name) for name, c in given.items()]
    rows = written(aligned.select(*own, f"`{into}`.*", F.monotonically_increasing_id().alias("row")), "alignments")
    counts = written(pair_counts(rows, size, held=held), "pairs")
    scored = link_scores(rows, counts, most=most)
    fields = [*ALIGNMENT.fieldNames(), "n_best", "count_sum"]
    return scored.select(*[F.col(name).alias(c) for name, c in given.items()], F.struct(*fields).alias(into))
