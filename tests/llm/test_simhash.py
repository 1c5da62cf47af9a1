import random
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from holdfast.llm import simhash
from holdfast.llm.queries import op1_simhash_components


def brute_fingerprint(text, words=4):
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, linked):
    """The smallest id linked to each of ``items`` (id, value)."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i][1], items[j][1]):
                root[find(i)] = find(j)
    groups = {}
    for i, (key, _) in enumerate(items):
        groups.setdefault(find(i), []).append(key)
    return [min((k for k in groups[find(i)] if k is not None), default=None) for i in range(len(items))]


def check(rows, docs):
    items = [(i, brute_fingerprint(t)) for i, t in docs]
    want = brute_components(items, lambda a, b: (a ^ b).bit_count() <= 4)
    assert Counter((i, f"{f:016x}", c) for (i, f), c in zip(items, want)) == Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows)


def test_query_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(op1_simhash_components(spark, sf).collect(), docs)


def test_awkward_rows(awkward, nothing):
    docs = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    check(simhash.near_duplicates(awkward).collect(), docs)
    assert simhash.near_duplicates(nothing).count() == 0


def fingerprints_in_balls(seed, balls=12, size=25):
    rng = random.Random(seed)
    found = set()
    for _ in range(balls):
        centre = rng.getrandbits(64)
        for _ in range(size):
            f = centre
            for _ in range(rng.randint(0, 6)):
                f ^= 1 << rng.randrange(64)
            found.add(f)
    return sorted(found)


def test_no_link_is_lost_in_dense_balls_however_keys_are_cut(spark):
    values = fingerprints_in_balls(3)
    df = spark.createDataFrame([(bytearray(v.to_bytes(8, "big")),) for v in values], "fp binary")
    want = brute_components([(v, v) for v in values], lambda a, b: (a ^ b).bit_count() <= 4)
    for block in (2048, 5):
        roots = {bytes(r.node): bytes(r.root) for r in simhash.components(simhash.links(df, simhash.Ring(), block=block)).collect()}
        assert [int.from_bytes(roots.get(v.to_bytes(8, "big"), v.to_bytes(8, "big")), "big") for v in values] == want


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    random.Random(1).shuffle(chain)
    star = [(1000, 1000 + i) for i in range(1, 80)]
    df = spark.createDataFrame([(bytearray(a.to_bytes(8, "big")), bytearray(b.to_bytes(8, "big"))) for a, b in chain + star], "a binary, b binary")
    roots = Counter(int.from_bytes(bytes(r.root), "big") for r in simhash.components(df).collect())
    assert roots == {0: 61, 1000: 80}


def edited(words, edits, rng):
    words = list(words)
    for i in rng.sample(range(len(words)), edits):
        words[i] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_one_of_each_component_stays(spark):
    rng = random.Random(5)
    rows = []
    for group in range(8):
        words = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
        rows.append((group * 100, " ".join(words)))
        rows += [(group * 100 + k, edited(words, 1 + k % 3, rng)) for k in range(1, 12)]
        rows += [(group * 100 + 50 + k, rows[-1][1]) for k in range(5)]
    rows += [(10_000 + i, " ".join(f"c{rng.randrange(10**6)}" for _ in range(200))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("k")).withColumn("_row", F.lit("l")).repartition(5)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    items = [(i, brute_fingerprint(t)) for i, t in rows]
    want = brute_components(items, lambda a, b: (a ^ b).bit_count() <= 4)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(set(want)) and len(set(want)) < 100


def test_random_orders_make_far_fingerprints_meet():
    wide = simhash.Ring(shingle_words=5, words64=4, max_distance=56, segments=21, orders=30)
    rng, bounds = np.random.default_rng(8), simhash._bounds(wide)
    chains = [np.concatenate([o[bounds[s] : bounds[s + 1]], o[bounds[(s + 1) % 21] : bounds[(s + 1) % 21 + 1]]]) for o in simhash._orders(wide) for s in range(21)]
    met = 0
    for _ in range(200):
        # 360 shingles in both, 44 in either one: a similarity of 0.804
        hashes = rng.integers(0, 1 << 63, 448, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 448, dtype=np.uint64)
        a, b = (np.unpackbits(np.frombuffer(simhash.fingerprint(h, 4), np.uint8)) for h in (hashes[:404], hashes[44:]))
        met += (a != b).sum() <= wide.max_distance and any((a[c] == b[c]).all() for c in chains)
    assert met >= 194


def test_stage_on_awkward_rows(awkward, nothing):
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = Counter(r.doc_id for r in kept.collect())
    # texts without a word are alike; of rows alike in key and text one stays
    assert ids[5] == 1 and ids[None] == 1 and ids[2] == 1 and ids[3] == ids[4] == 0
    assert simhash.drop_near_duplicates(nothing).count() == 0
    copies = awkward.sparkSession.createDataFrame([(None, "the same text")] * 5 + [(9, "another text"), (None, "another text")], "doc_id long, text string")
    assert Counter(simhash.drop_near_duplicates(copies.repartition(3)).collect()) == Counter([(None, "the same text"), (9, "another text")])


def test_fingerprint_bits_are_majorities():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 63, 70_000, dtype=np.uint64)
    bits = [(hashes >> np.uint64(63 - b) & np.uint64(1)).sum() * 2 > len(hashes) for b in range(64)]
    assert simhash.fingerprint(hashes) == np.packbits(bits).tobytes()
    assert simhash.fingerprint(hashes[:0], 4) == bytes(32)


def test_no_table_that_grows_is_broadcast(spark, plan, tmp_path, monkeypatch):
    rng = random.Random(7)
    made = spark.createDataFrame([(i, rng.randbytes(8)) for i in range(200)], "key long, fp binary")
    made.write.parquet(str(tmp_path / "fps"))
    marked = spark.read.parquet(str(tmp_path / "fps"))
    assert "BroadcastHashJoin" not in plan(simhash.links(marked.select("fp"), simhash.Ring()))
    rounds = []
    monkeypatch.setattr(simhash, "cut", lambda df: rounds.append(plan(df)) or df.localCheckpoint())
    monkeypatch.setattr(simhash, "written", lambda df, name: marked)
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert "BroadcastHashJoin" not in plan(simhash.near_duplicates(docs))
    pairs = spark.createDataFrame([(b"b", b"a"), (b"c", b"b")], "a binary, b binary")
    simhash.components(pairs).collect()
    assert len(rounds) > 2 and not any("BroadcastHashJoin" in text for text in rounds)
