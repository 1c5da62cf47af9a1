"""Near-duplicates by SimHash, with pigeonring filtering of candidates.

A fingerprint has one bit per hash bit: set if it is set in over half of a text's shingle hashes, repeats included. Two texts link
if their fingerprints differ in at most ``max_distance`` bits. The bits are laid out as a ring of segments. If two rings
differ in at most t bits over m segments, then at some segment a chain starts whose first l segments differ in at most
l*t/m bits, for every l (the pigeonring principle). With m = t + 1 the first segment of that chain is equal and the
second differs in one bit at most, so the join key is a chain of two segments (26 of 64 bits for t = 4), looked up as
it is and with each 0 of the second segment set to 1. The third segment's budget prunes what meets, and the whole
ring's budget is the Hamming check. No link is lost.

Where t is too large for that, the ring of a longer fingerprint can be dealt several times in fixed random orders, and a
chain must start with two equal segments. That finds a link with a probability that grows with the number of orders.

Scale. Equal texts fall together first, so a group of copies is one node. Keys are counted before rows meet. A key
with more than ``block`` rows is cut into blocks by hash, and every two blocks meet in a task of their own: memory is
bounded, nothing is dropped. Joins are asked for by merge: Spark sizes what comes of keys and counts by the file of fingerprints and
would send it to the driver. A task returns a spanning forest of the links it finds, never all pairs; components are
then found by alternating star operations whose state is cut by checkpoints.

Null and empty texts have fingerprint zero and link like any other. A text of fewer words than a shingle is one
shingle. Null ids take part; a component of null ids only has a null id. Repeated rows get equal results. Columns
other than the two named are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import cut, free_name, text_of, written

#: Rows of one key that meet in one task, at most twice as many.
BLOCK = 2048
#: Shingles whose bits are counted at a time.
SHINGLES_AT_ONCE = 1 << 15
CHAIN_SHIFT = 40


class Ring(NamedTuple):
    """How fingerprints are made and linked."""

    shingle_words: int = 4
    words64: int = 1
    max_distance: int = 4
    segments: int = 5
    #: 0: complete search; otherwise so many random orders of the ring, each chain starting with two equal segments.
    orders: int = 0


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``words`` words, repeats included; A-Z lower-cased, words cut at ASCII space."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    count = len(parts) - words + 1
    if count <= 1:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:count].tolist()
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    return np.fromiter((digest(view[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)), np.uint64, count)


def _mixed(h: np.ndarray, word: int) -> np.ndarray:
    """Word 0 is the hash itself; further words are the hash passed through a 64-bit finaliser with another offset."""
    if word == 0:
        return h
    with np.errstate(over="ignore"):
        z = h + np.uint64(0x9E3779B97F4A7C15) * np.uint64(word)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def fingerprint(hashes: np.ndarray, words64: int = 1) -> bytes:
    """The fingerprint as big-endian bytes; all zero without shingles."""
    out = b""
    for word in range(words64):
        ones = np.zeros(64, np.int64)
        for start in range(0, len(hashes), SHINGLES_AT_ONCE):
            part = _mixed(hashes[start : start + SHINGLES_AT_ONCE], word).astype(">u8").view(np.uint8)
            ones += np.unpackbits(part.reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        out += np.packbits(ones * 2 > len(hashes)).tobytes()
    return out


def fingerprints(texts: DataFrame, ring: Ring) -> DataFrame:
    """``texts`` (a key of any type and the text) with fp (binary) in place of the text."""
    kind = texts.schema[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = (shingle_hashes(value.as_buffer().to_pybytes(), ring.shingle_words) for value in batch.column(1))
            fps = [fingerprint(h, ring.words64) for h in hashes]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.binary())], [kind.name, "fp"])

    return texts.mapInArrow(run, T.StructType([kind, T.StructField("fp", T.BinaryType())]))


def _bounds(ring: Ring) -> np.ndarray:
    return np.linspace(0, 64 * ring.words64, ring.segments + 1).round().astype(int)


def _orders(ring: Ring) -> list[np.ndarray]:
    """The bit orders that the ring is read in; the first of a complete search is the natural one."""
    bits = 64 * ring.words64
    if not ring.orders:
        return [np.arange(bits)]
    return [np.random.default_rng(1000 + i).permutation(bits) for i in range(ring.orders)]


def chain_keys(fps: DataFrame, ring: Ring) -> DataFrame:
    """key, fp: one row for each chain of two segments of each fingerprint and, in a complete search, each allowed flip."""
    bits, bounds = 64 * ring.words64, _bounds(ring)
    if not ring.orders and ring.segments != ring.max_distance + 1:
        raise ValueError("a complete search needs one segment more than the bits that may differ")
    weights = np.zeros((bits, ring.segments * max(1, ring.orders)))
    seconds: list[list[tuple[int, int]]] = []
    for o, order in enumerate(_orders(ring)):
        for s in range(ring.segments):
            column, after = o * ring.segments + s, (s + 1) % ring.segments
            first, second = order[bounds[s] : bounds[s + 1]], order[bounds[after] : bounds[after + 1]]
            chain = np.concatenate([first, second]) if after != s else first
            weights[chain, column] = 2.0 ** np.arange(len(chain))
            seconds.append([(int(b), 1 << (len(first) + i)) for i, b in enumerate(second)] if not ring.orders and after != s else [])
    offsets = np.arange(weights.shape[1], dtype=np.int64) << CHAIN_SHIFT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                column = whole.column(0).slice(start, 1024)
                raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, bits // 8)
                on = np.unpackbits(raw, axis=1)
                keys = (on @ weights).astype(np.int64) + offsets
                rows = np.repeat(np.arange(len(raw)), keys.shape[1])
                found, probe = [keys.ravel()], [np.zeros(keys.size, bool)]
                at = [rows]
                for c, flips in enumerate(seconds):
                    for bit, worth in flips:
                        zero = np.flatnonzero(on[:, bit] == 0)
                        found.append(keys[zero, c] + worth)
                        at.append(zero)
                        probe.append(np.ones(len(zero), bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found)), column.take(pa.array(np.concatenate(at))), pa.array(np.concatenate(probe))],
                    ["key", "fp", "probe"],
                )

    return fps.select("fp").mapInArrow(run, "key long, fp binary, probe boolean")


def units(rows: DataFrame, key: str, item: str, blocks: Column) -> DataFrame:
    """``rows`` dealt into units (key, lo, hi) and sorted by them: every two rows of a key share a unit.

    ``blocks`` is the number of blocks that a row's key is cut into; a row goes to its own block's unit with each block.
    """
    own = F.pmod(F.xxhash64(item, F.lit("block")), F.col("_blocks")).cast("int")
    paired = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda other: F.struct(F.least(F.col("_own"), other).alias("lo"), F.greatest(F.col("_own"), other).alias("hi")),
    )
    cut_up = rows.withColumn("_blocks", blocks.cast("int")).withColumn("_own", own)
    dealt = cut_up.withColumn("_unit", F.explode(paired)).select(*rows.columns, F.col("_unit.lo").alias("lo"), F.col("_unit.hi").alias("hi"))
    return dealt.repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi", item)


def runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """The stretches of rows that are equal in the columns ``by``, across batches, from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_pylist() for c in by]
        keys = list(zip(*columns, strict=True))
        edges = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        for a, b in zip([0, *edges], [*edges, len(keys)], strict=True):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def forest(count: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of 0..count-1; ``near(i, rest)`` gives those of the array ``rest`` that link to i."""
    rest, found, edges = np.arange(count), [], []
    while len(rest):
        if found:
            i = found.pop()
        else:
            i, rest = int(rest[0]), rest[1:]
            if not len(rest):
                break
        hit = near(i, rest)
        if len(hit):
            edges += [(i, int(j)) for j in hit]
            found += hit.tolist()
            rest = np.setdiff1d(rest, hit, assume_unique=True)
    return edges


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast, however small Spark believes it to be: it grows with the corpus."""
    return df.hint("merge")


def links(fps: DataFrame, ring: Ring, *, block: int = BLOCK) -> DataFrame:
    """a, b (binary): a spanning forest, per meeting of blocks, of the links between the distinct fingerprints ``fps``."""
    rows = chain_keys(fps, ring)
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("probe")).alias("own")).filter("n > 1 and own > 0")
    met = rows.join(merged(sizes.select("key", "n")), "key").select("key", "fp", "n")
    dealt = units(met, "key", "fp", F.ceil(F.col("n") / block))
    words, bounds, most = ring.words64, _bounds(ring), ring.max_distance
    masks = []
    if not ring.orders:
        for s in range(ring.segments):
            on = np.zeros(64 * words, np.uint8)
            for k in range(min(3, ring.segments)):
                at = (s + k) % ring.segments
                on[bounds[at] : bounds[at + 1]] = 1
            masks.append(np.packbits(on).view(">u8").astype(np.uint64))
    budget = 3 * most // ring.segments

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for table in runs(batches, ["key", "lo", "hi"]):
            if table.num_rows < 2:
                continue
            names = sorted(set(table.column("fp").to_pylist()))
            if len(names) < 2:
                continue
            raw = np.frombuffer(b"".join(names), ">u8").astype(np.uint64).reshape(-1, words)
            mask = masks[(table.column("key")[0].as_py() >> CHAIN_SHIFT) % ring.segments] if masks else None

            def near(i, rest, raw=raw, mask=mask):
                apart = raw[rest] ^ raw[i]
                if mask is not None:
                    within = np.bitwise_count(apart & mask).sum(1, dtype=np.int64) <= budget
                    rest, apart = rest[within], apart[within]
                return rest[np.bitwise_count(apart).sum(1, dtype=np.int64) <= most]

            for i, j in forest(len(names), near):
                a.append(names[i])
                b.append(names[j])
            if len(a) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return dealt.select("key", "lo", "hi", "fp").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """node, root for every end of an edge (columns a, b): root is the smallest node of its component.

    Large-star and small-star rounds until nothing changes; each round's pairs are checkpointed.
    """

    def mark(pairs: DataFrame):
        row = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    #: a > b in every pair
    pairs = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = mark(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.join(merged(low), "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(merged(least), "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(joined.select("a", F.col("low").alias("b")))
        pairs = cut(small.filter("a <> b").distinct())
        now = mark(pairs)
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def linked(nodes: DataFrame, ring: Ring) -> DataFrame:
    """fp, root (the smallest fingerprint of its component), least of the distinct fingerprints ``nodes`` (fp, least)."""
    roots = components(links(nodes, ring))
    return nodes.join(merged(roots), nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")


def near_duplicates(docs: DataFrame, ring: Ring = Ring(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fingerprint (hex) and component_id (smallest key linked to it, over any number of links) of every row."""
    marked = written(fingerprints(docs.select(F.col(key).alias("key"), text_of(text).alias("text")), ring), "fingerprints")
    of = linked(marked.groupBy("fp").agg(F.min("key").alias("least")), ring)
    groups = of.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = of.join(merged(groups), "root").select("fp", "component_id")
    return marked.join(merged(ids), "fp").select(F.col("key").alias(key), F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, ring: Ring = Ring(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row left of each component that ``near_duplicates`` finds: the one with the smallest key.

    A null key comes last; of rows alike in key the first as written stays, so rows loaded twice count once and null keys
    don't save a copy. Null texts, empty ones and those without a word are alike. All columns pass through, whatever
    their names; an empty table gives an empty result.
    """
    row = free_name(docs, "row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    order = F.struct(F.col(f"`{key}`").isNull().alias("missing"), F.col(f"`{key}`").alias("key"), F.col(row).alias("row"))
    marked = written(fingerprints(numbered.select(order.alias("own"), text_of(text).alias("text")), ring), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("own").alias("least"))
    stays = linked(nodes, ring).groupBy("root").agg(F.min("least").alias("best")).select(F.col("best.row").alias(row))
    return numbered.join(stays, row, "left_semi").drop(row)
