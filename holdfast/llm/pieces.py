"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice has a boundary after every character and an edge for every piece. A path's weight is the sum of its pieces'
scores; for a BPE model, an edge is open only if the model's merges would leave its piece and the one before it side by
side as they are (the merges of a text leave a sequence of pieces exactly if they leave each two neighbours), so the
path found is the model's own encoding. Characters outside the vocabulary become byte pieces.

The search keeps backpointers only as far back as a surviving path needs them: a boundary from which no piece can grow
any further is dead, and as soon as all surviving paths pass through one boundary, the ids up to it are final and the
window behind it is forgotten. No piece is longer than ``longest`` characters, which bounds the living part.

In models whose pieces never hold a space after another character, all paths meet before every word, whatever the text
before it. The ids of a word therefore do not depend on its surroundings and are kept in a bounded cache of the Python
worker; words longer than ``KEPT_CHARS`` always go through the search. A model without that property is searched as a
whole.

Null and empty texts have no ids and decode to the empty string. Decoding is exact but for U+2581, which the model
itself takes for a space. Rows alike get rows alike; nothing is shuffled; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import os
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import text_of

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Words of at most so many characters are remembered.
KEPT_CHARS = 64
#: Bytes of a worker's caches: 5/16 each for the words met lately and those before them, 1/16 for parts of words and
#: some 5/32 each for pairs of pieces and for beginnings of words.
KEPT_BYTES = 256 << 20
#: What a remembered word takes beside its characters (at most four bytes each) and ids; a pair of pieces; a search begun.
WORD_BYTES, PAIR_BYTES, BEGUN_BYTES = 200, 80, 2_000
#: Beginnings of words whose search is remembered have so many characters.
BEGIN = 5


def model_path(model: str) -> str:
    """``model`` itself if it is a path, else the file of that name among the public tokenizers."""
    if os.path.isabs(model):
        return model
    import public_tokenizers

    return public_tokenizers.path(model)


def word_keys(text: str) -> list[str]:
    """``text`` cut where no piece can reach across: key k stands for a space and k, or for itself if it starts with a line feed.

    The space before the first key is the one that the model puts before every text.
    """
    if not text:
        return []
    if "  " in text or text[0] == " " or SPACE in text:
        return _spaced_keys(text)
    return text.replace("\n", " \n").split(" ")


def _spaced_keys(text: str) -> list[str]:
    """The same where runs of spaces belong to the word that follows them."""
    keys, run = [], 0
    for line_number, line in enumerate(text.replace(SPACE, " ").split("\n")):
        words = line.split(" ")
        if line_number:
            keys.append("\n" + words[0])
            words = words[1:]
        run = 0
        for word in words:
            if word:
                keys.append(SPACE * run + word)
                run = 0
            else:
                run += 1
        if run:
            keys.append(SPACE * (run - 1))
    return keys


#: The best path to a boundary: its weight, the boundary before, the piece between, what may follow that piece.
Path = tuple[float, int, str, dict[str, bool]]


class Lattice:
    """Streaming Viterbi search over the pieces of one model."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], merges: bool, pairs: int = 500_000):
        self.pieces = pieces
        self.byte_ids = byte_ids
        self.longest = max(map(len, pieces))
        #: nested by character; "" holds the piece that ends there and its score
        self.trie: dict = {}
        for piece, (_, score) in pieces.items():
            node = self.trie
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = (piece, score)
        scores = sorted({score for _, score in pieces.values()}, reverse=True)
        place = {score: i for i, score in enumerate(scores)}
        #: the order in which merges are made; single characters are there from the start
        self.rank = {p: place[score] if len(p) > 1 else -1 for p, (_, score) in pieces.items()}
        count = Counter(score for p, (_, score) in pieces.items() if len(p) > 1)
        self.tied = {p for p, (_, score) in pieces.items() if len(p) > 1 and count[score] > 1}
        self.halves: dict[str, tuple[str, str]] = {}
        self.edge = lru_cache(1 << 14)(self._edge)
        self.merges, self.pairs = merges, pairs
        self.single = {p for p in pieces if len(p) == 1}
        #: for each piece the pieces asked about after it, and the answers
        self.after: dict[str, dict[str, bool]] = {}
        self.asked = 0
        inner = [p for p in pieces if len(p) > 1]
        #: characters that stand side by side within a piece; all paths meet between any other two
        self.beside = {p[i : i + 2] for p in inner for i in range(len(p) - 1)}
        self.words_apart = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in inner)

    def _merged(self, text: str) -> list[str]:
        """What the model's merges make of a short text: the best-scored neighbours first, the first of equals."""
        parts = list(text)
        while len(parts) > 1:
            score, at = max((self.pieces[a + b][1], -i) if a + b in self.pieces else (-np.inf, -i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if score == -np.inf:
                break
            parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
        return parts

    def _halves(self, piece: str) -> tuple[str, str]:
        """The two symbols that the last merge into ``piece`` joins."""
        if piece not in self.halves:
            parts = list(piece)
            while len(parts) > 2:
                at = max(range(len(parts) - 1), key=lambda i: (self.pieces[m][1] if (m := parts[i] + parts[i + 1]) in self.pieces else -np.inf, -i))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.halves[piece] = (parts[0], parts[1])
        return self.halves[piece]

    def _edge(self, piece: str, side: int) -> list[tuple[str, int]]:
        """The symbols that stand at one end of ``piece``, last to first, with the rank of the merge that made each."""
        out = [(piece, self.rank.get(piece, -1))]
        while len(piece) > 1:
            piece = self._halves(piece)[side]
            out.append((piece, self.rank.get(piece, -1)))
        return out

    def _left_alone(self, before: str, piece: str) -> bool:
        """Whether merging ``before + piece`` gives just these two.

        The merges are taken back, last first. At each moment the two symbols that touch must have no merge of their
        own that would have come before the one taken back next; of equal ranks the left place comes first.
        """
        if before in self.tied or piece in self.tied or before + piece in self.tied:
            return self._merged(before + piece) == [before, piece]
        left, right = self.edge(before, 1), self.edge(piece, 0)
        rank, i, j, bound = self.rank, 0, 0, len(self.pieces)
        while True:
            joined = rank.get(left[i][0] + right[j][0])
            if joined is not None and joined < bound:
                return False
            a, b = left[i][1], right[j][1]
            if a < 0 and b < 0:
                return True
            if a > b:
                bound, i = a, i + 1
            else:
                bound, j = b + 1, j + 1

    def edge_open(self, after: dict[str, bool], before: str, piece: str) -> bool:
        """Whether ``piece`` may follow ``before``; remembered in ``after``."""
        if self.asked >= self.pairs:
            self.asked = 0
            self.after.clear()
        self.asked += 1
        found = after[piece] = not self.merges or not before or self._left_alone(before, piece)
        return found

    def path(self, weight: float, back: int, piece: str) -> Path:
        after = self.after.get(piece)
        if after is None:
            after = self.after[piece] = {}
        return (weight, back, piece, after)

    def ids(self, chars: str) -> Iterator[list[int]]:
        """The ids of ``chars`` in runs, each given out as soon as it is final."""
        search = Search(self)
        yield from search.read(chars)
        yield search.rest()

    def parts(self, chars: str) -> list[str]:
        """``chars`` cut wherever no piece can hold both neighbours."""
        beside = self.beside
        cuts = [i for i in range(1, len(chars)) if chars[i - 1 : i + 1] not in beside]
        return [chars[a:b] for a, b in zip([0, *cuts], [*cuts, len(chars)], strict=True)]


class Search:
    """A search under way: the living part of the lattice and the paths that lead into it."""

    __slots__ = ("at", "done", "here", "lattice", "live", "paths")

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        self.at = self.done = 0
        self.here: Path | None = lattice.path(0.0, -1, "")
        self.paths: dict[int, Path] = {0: self.here}
        #: where a piece began, the path that leads there, the node of what has been read of it
        self.live: list[tuple[int, Path, dict]] = []

    def copy(self) -> Search:
        other = Search.__new__(Search)
        other.lattice, other.at, other.done, other.here = self.lattice, self.at, self.done, self.here
        other.paths, other.live = self.paths.copy(), self.live
        return other

    def read(self, chars: str) -> Iterator[list[int]]:
        """Goes on with ``chars``; gives out ids in runs, each as soon as it is final."""
        lattice, paths, live, here, done = self.lattice, self.paths, self.live, self.here, self.done
        root, single, merges = lattice.trie, lattice.single, lattice.merges
        at = self.at
        for char in chars:
            best, still = None, []
            if here is not None:
                live = [*live, (at, here, root)]
            for item in live:
                node = item[2].get(char)
                if node is None:
                    continue
                found = node.get("")
                if found is None:
                    still.append((item[0], item[1], node))
                    continue
                path = item[1]
                if len(node) > 1:
                    still.append((item[0], path, node))
                #: merges leave one open edge to a boundary, so the first is the best
                if best is None or (not merges and path[0] + found[1] > best[0]):
                    is_open = path[3].get(found[0])
                    if is_open or (is_open is None and lattice.edge_open(path[3], path[2], found[0])):
                        best = (path[0] + found[1], item[0], found[0])
            if char not in single and here is not None and (best is None or here[0] > best[0]):
                best = (here[0], at, char)
            live = still
            at += 1
            here = None
            if best is not None:
                paths[at] = here = lattice.path(*best)
            if not live:
                yield self._final(paths, done, at)
                done, paths = at, {at: here}
            elif at - done >= 4 * lattice.longest:
                meet = self._meeting(paths, [start for start, _, _ in live] + ([at] if here is not None else []), done)
                if meet > done:
                    yield self._final(paths, done, meet)
                    paths = {b: p for b, p in paths.items() if b >= meet}
                    done = meet
        self.paths, self.live, self.here, self.done, self.at = paths, live, here, done, at

    def rest(self) -> list[int]:
        """The ids that the end of the text makes final."""
        return self._final(self.paths, self.done, self.at)

    @staticmethod
    def _meeting(paths: dict[int, Path], ends: list[int], done: int) -> int:
        """The last boundary that the paths to all ``ends`` pass through."""
        ends = sorted(set(ends))
        while len(ends) > 1:
            last = ends.pop()
            before = paths[last][1] if last > done else done
            if before not in ends:
                ends = sorted([*ends, before])
        return ends[0]

    def _final(self, paths: dict[int, Path], done: int, end: int) -> list[int]:
        back: list[str] = []
        while end > done:
            _, end, piece, _ = paths[end]
            back.append(piece)
        pieces, byte_ids, ids = self.lattice.pieces, self.lattice.byte_ids, []
        for piece in reversed(back):
            known = pieces.get(piece)
            ids += [known[0]] if known is not None else [byte_ids[b] for b in piece.encode()]
        return ids


class Vocabulary:
    """A model file's pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [i for i in range(len(names)) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.pieces = {names[i]: (i, model.get_score(i)) for i in plain}
        self.text_of_id = [b""] * len(names)
        for i in plain:
            self.text_of_id[i] = names[i].replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.text_of_id[i] = bytes([b])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``, without the space that the model puts first; byte pieces that are no UTF-8 give U+FFFD."""
        of = self.text_of_id
        return b"".join([of[i] for i in ids.tolist()]).decode("utf-8", "replace")[1:]


class Encoder:
    """Encodes whole texts with one model; holds the worker's cache of words."""

    def __init__(self, path: str, kept_bytes: int = KEPT_BYTES):
        own = vocabulary(path)
        #: merge ranks are whole numbers from 0 down, log probabilities are not
        merges = all(float(score).is_integer() for _, score in own.pieces.values())
        self.word_bytes, self.inner_bytes = kept_bytes * 5 // 16, kept_bytes // 16
        self.beginnings = max(1, kept_bytes * 5 // 32 // BEGUN_BYTES)
        self.lattice = Lattice(own.pieces, own.byte_ids, merges, max(1, kept_bytes * 5 // 32 // PAIR_BYTES))
        self.begun: dict[str, tuple[list[int], Search]] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: parts of words that no space goes before
        self.inner: dict[str, bytes] = {}
        self.known_size = self.inner_size = 0

    def _search(self, chars: str) -> bytes:
        """The ids of a part of a word; the search goes on from where it stood after the part's first characters."""
        if len(chars) <= BEGIN:
            return array("i", [i for run in self.lattice.ids(chars) for i in run]).tobytes()
        begin = chars[:BEGIN]
        known = self.begun.get(begin)
        if known is None:
            search = Search(self.lattice)
            known = ([i for run in search.read(begin) for i in run], search)
            if len(self.begun) >= self.beginnings:
                self.begun.clear()
            self.begun[begin] = known
        search = known[1].copy()
        ids = known[0] + [i for run in search.read(chars[BEGIN:]) for i in run] + search.rest()
        return array("i", ids).tobytes()

    def _word(self, key: str) -> bytes:
        """The ids of a word that was not among the words met lately when its text began."""
        found = self.known.get(key)
        if found is not None:
            return found
        found = self.older.get(key)
        if found is None:
            parts = self.lattice.parts(key if key[:1] == "\n" else SPACE + key)
            if len(parts) == 1:
                found = self._search(parts[0])
            else:
                stem = parts[0][1:] if parts[0][0] == SPACE else None
                first = self._search(parts[0]) if stem is None else self.known.get(stem) or self._word(stem)
                found = first + b"".join([self.inner.get(part) or self._inner(part) for part in parts[1:]])
        if len(key) <= KEPT_CHARS:
            size = WORD_BYTES + 4 * len(key) + len(found)
            if self.known_size + size > self.word_bytes:
                self.older, self.known, self.known_size = self.known, {}, 0
            self.known[key] = found
            self.known_size += size
        return found

    def _inner(self, part: str) -> bytes:
        found = self._search(part)
        if len(part) <= KEPT_CHARS:
            size = WORD_BYTES + 4 * len(part) + len(found)
            if self.inner_size + size > self.inner_bytes:
                self.inner.clear()
                self.inner_size = 0
            self.inner[part] = found
            self.inner_size += size
        return found

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if not self.lattice.words_apart:
            return np.frombuffer(self._search(SPACE + text.replace(" ", SPACE)), np.int32)
        known, word = self.known, self._word
        parts = [known.get(key) or word(key) for key in word_keys(text)]
        return np.frombuffer(b"".join(parts), np.int32)


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(2)
def encoder(path: str, kept_bytes: int = KEPT_BYTES) -> Encoder:
    """The worker's encoder for a model file; the collector needn't visit it again."""
    own = Encoder(path, kept_bytes)
    gc.collect()
    gc.freeze()
    return own


def _mapped(df: DataFrame, into: dict[str, T.DataType], make: Callable[[pa.Array], list[pa.Array]], source: Column) -> DataFrame:
    """``df`` with columns made from ``source``, some rows at a time."""
    taken = {c.lower() for c in df.columns} & {c.lower() for c in into}
    if taken:
        raise ValueError(f"there is a column {min(taken)} already")
    schema = T.StructType([*df.schema.fields, *[T.StructField(name, kind) for name, kind in into.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                *given, last = batch.slice(start, 256).columns
                yield pa.RecordBatch.from_arrays([*given, *make(last)], schema.fieldNames())
        pa.default_memory_pool().release_unused()

    return df.select(*[F.col(f"`{c}`") for c in df.columns], source.alias(next(iter(into)))).mapInArrow(run, schema)


def encode(df: DataFrame, *, text: str = "text", ids: str = "ids", decoded: str | None = None, model: str = MODEL, kept_bytes: int = KEPT_BYTES) -> DataFrame:
    """``df`` with the ids (array of int) of its texts and, if ``decoded`` names a column, what these ids decode to.

    A worker's caches take some ``kept_bytes``. A column of ``df`` that has one of the new names is refused.
    """
    into = {ids: T.ArrayType(T.IntegerType()), **({decoded: T.StringType()} if decoded else {})}

    def make(texts: pa.Array) -> list[pa.Array]:
        path = model_path(model)
        own = encoder(path, kept_bytes)
        found = [own.encode(t) for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        made = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *found])))]
        if decoded:
            made.append(pa.array(map(vocabulary(path).decode, found), pa.string()))
        return made

    return _mapped(df, into, make, text_of(text))


def decode(df: DataFrame, *, ids: str = "ids", decoded: str = "decoded", model: str = MODEL) -> DataFrame:
    """``df`` with the texts of its ids; a null array gives the empty text."""

    def make(lists: pa.Array) -> list[pa.Array]:
        own = vocabulary(model_path(model))
        return [pa.array([own.decode(one.values.to_numpy(zero_copy_only=False)) if one.is_valid else "" for one in lists], pa.string())]

    return _mapped(df, {decoded: T.StringType()}, make, F.coalesce(F.col(ids), F.array().cast("array<int>")))
