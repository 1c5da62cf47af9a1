import zlib
from collections import Counter, defaultdict

import pytest

from holdfast.llm import shards
from holdfast.llm.queries import op4_rendezvous_shards


def check(rows, docs):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, 8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in docs)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r.slot)
        assert r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    of = defaultdict(set)
    for r in rows:
        of[r.doc_id].add((r["shard"], r["grown_shard"]))
    assert all(len(s) == 1 for s in of.values())


def test_query_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(op4_rendezvous_shards(spark, sf).collect(), docs)


def test_awkward_rows(awkward, nothing):
    rows = shards.shard_records(awkward, [1.0] * 24).collect()
    check(rows, [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()])
    assert shards.shard_records(nothing, [1.0] * 24).count() == 0


def test_slots_are_gapless_over_many_cells(spark):
    df = spark.range(5_000).selectExpr("id", "cast(if(id < 4000, 0, id % 3) as int) as shard")
    rows = shards.with_slots(df, "shard", ["id"], cell_rows=100).collect()
    found = defaultdict(list)
    for r in rows:
        found[r["shard"]].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in found.values())


def test_weights_and_growth(spark):
    df = spark.range(30_000).withColumnRenamed("id", "doc_id").selectExpr("doc_id", "'' as text")
    rows = shards.shard_records(df, [1.0, 2.0, 3.0, 0.0], grown=2.0).collect()
    counts = Counter(r["shard"] for r in rows)
    assert counts[3] == 0
    for shard, weight in enumerate((1, 2, 3)):
        assert abs(counts[shard] / len(rows) - weight / 6) < 0.02
    moved = [r for r in rows if r["grown_shard"] != r["shard"]]
    assert abs(len(moved) / len(rows) - 2 / 8) < 0.02 and {r["grown_shard"] for r in moved} == {4}
    with pytest.raises(ValueError):
        shards.rendezvous_shard(df["doc_id"], [0.0])
