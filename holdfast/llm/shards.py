"""Weighted rendezvous sharding: the key and the set of shards decide, nothing else.

Every shard draws a score from a hash of (key, shard); the smallest ``-ln(u) / weight`` wins. A shard that is
added changes no other shard's score, so a record either stays or moves to the new shard. All of it is one
projection; only ids, sizes and checksums are shuffled, for the slots, never the texts.

Slots number the records of a shard without gaps. A shard may hold a large part of all records, so its records
are cut by hash into cells whose number grows with the table; ranks are taken within a cell, and the cells'
running totals (one row per cell) shift them.

Null keys hash like the empty string's neighbour (a marker of their own), all alike; equal keys meet in one
shard and get slots of their own. Null texts have no bytes. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import text_of

#: Records per cell that slots are ranked in, on average.
CELL_ROWS = 50_000


def _score(key: Column, shard: int, weight: float, seed: int) -> Column:
    """``-ln(u) / weight`` with u in (0, 1) from 53 bits of a hash; infinite for a shard of weight 0."""
    if weight <= 0:
        return F.lit(math.inf)
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard), F.lit(seed)), 11).cast("double")
    return -F.log((bits + F.lit(0.5)) * F.lit(2.0**-53)) / F.lit(float(weight))


def rendezvous_shard(key: Column, weights: Sequence[float], *, seed: int = 0) -> Column:
    """The shard (0 to ``len(weights) - 1``) of a record key; the lower shard wins a tie."""
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a weight above 0")
    key = F.coalesce(key.cast("string"), F.lit("\0null"))
    scores = [F.struct(_score(key, i, w, seed).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    return (F.least(*scores) if len(scores) > 1 else scores[0])["shard"]


def with_slots(df: DataFrame, shard: str, order: Sequence[str], *, slot: str = "slot", cell_rows: int = CELL_ROWS) -> DataFrame:
    """``df`` with a number for each row, gapless from 0 within its shard; ``order`` breaks ties within a cell.

    Rows alike in every ``order`` column are interchangeable, so it doesn't matter which of them gets which slot.
    """
    cells = max(1, math.ceil(df.count() / cell_rows))
    dealt = df.withColumn("_cell", F.pmod(F.xxhash64(*order, F.lit("cell")), F.lit(cells)).cast("int"))
    sizes = dealt.groupBy(shard, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranks = Window.partitionBy(shard, "_cell").orderBy(*order)
    ranked = dealt.withColumn("_rank", F.row_number().over(ranks) - 1)
    return (
        ranked.join(starts, [shard, "_cell"])
        .withColumn(slot, (F.col("_start") + F.col("_rank")).cast("long"))
        .drop("_cell", "_start", "_rank")
    )


def shard_records(
    df: DataFrame, weights: Sequence[float], *, key: str = "doc_id", text: str = "text", grown: float | None = 1.0, seed: int = 0
) -> DataFrame:
    """One row per record: key, size (UTF-8 bytes plus 8), text_crc32, law, shard, slot and, with ``grown`` the weight of one
    more shard, the shard the record would then have. Other columns of ``df`` are not read.
    """
    more = [*weights, grown] if grown else None
    base = df.select(
        F.col(key),
        (F.octet_length(text_of(text)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.encode(text_of(text), "UTF-8")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard(F.col(key), weights, seed=seed).cast("int").alias("shard"),
        (rendezvous_shard(F.col(key), more, seed=seed).cast("int") if more else F.lit(None).cast("int")).alias("grown_shard"),
    )
    return with_slots(base, "shard", [key, "text_crc32", "size"]).select(
        key, "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
