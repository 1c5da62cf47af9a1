"""Exact ranks in hash order, without ever sorting a whole table in one task.

The order is that of a uniform 52-bit number. A prefix of it cuts the table into buckets of like
size whatever the data holds, so "the r-th smallest" needs bucket counts (small shuffles) and a look
into one bucket. Split, folds and samples then become a comparison with a literal.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.keys import HASH_BITS

ALL_ROWS = (1 << HASH_BITS) - 1
NO_ROWS = -1
#: Groups whose cuts travel as literals; beyond it, as a broadcast table.
LITERAL_GROUPS = 200
#: Hash bits counted per pass: a task sends at most 1,024 counts per open bucket.
PASS_BITS = 10
#: Rows that may be left to rank directly, over all groups.
RANKED_ROWS = 200_000
#: Rows of a bucket that one window ranks.
ROWS_PER_BUCKET = 1 << 14


def prefix_bits(n: int, per_bucket: int) -> int:
    """Bits of the prefix that leaves some ``per_bucket`` of n hashes in a bucket."""
    return min(HASH_BITS, max(0, math.ceil(math.log2(max(n, 1) / per_bucket))))


def hash_cuts(
    df: DataFrame,
    number: Column,
    wanted: dict[Any, Sequence[int]],
    sizes: dict[Any, int],
    group: Column | None = None,
) -> dict[Any, list[int]]:
    """For each group the hash numbers at the wanted ranks (1 = smallest).

    Each pass counts rows per next ten bits of the hash, in the buckets that still hold a wanted
    rank, and keeps the one bucket per rank: a small shuffle that narrows a thousandfold. When few
    rows are left they are ranked as they are.
    """
    group = F.lit("all") if group is None else group
    spark, kind = df.sparkSession, _type(df, group)
    rows = df.select(group.alias("g"), number.alias("h")).where("g is not null")
    # (group, rank) -> (prefix of the bucket that holds it, place in the bucket, rows in the bucket)
    places = {(g, r): (0, r, sizes[g]) for g, ranks in wanted.items() for r in ranks if 0 < r < sizes[g]}
    used = 0

    def held_in() -> DataFrame:
        listed = [(g, r, prefix, place) for (g, r), (prefix, place, _) in places.items()]
        return F.broadcast(spark.createDataFrame(listed, f"g {kind}, r bigint, prefix bigint, place bigint"))

    def inside() -> DataFrame:
        tagged = rows.withColumn("prefix", F.shiftright("h", HASH_BITS - used))
        return tagged.join(F.broadcast(held_in().select("g", "prefix").distinct()), ["g", "prefix"], "left_semi")

    while used < HASH_BITS and sum({(g, p[0]): p[2] for (g, _), p in places.items()}.values()) > RANKED_ROWS:
        bits = min(PASS_BITS, HASH_BITS - used)
        running = Window.partitionBy("g", "prefix").orderBy("k")
        counted = (
            inside().withColumn("k", F.shiftright("h", HASH_BITS - used - bits))
            .groupBy("g", "prefix", "k").count()
            .withColumn("upto", F.sum("count").over(running))
            .join(held_in(), ["g", "prefix"])
            .where("upto >= place and upto - count < place")
            .select("g", "r", "k", F.expr("place - upto + count"), "count")
        )
        places = {(g, r): (k, place, size) for g, r, k, place, size in counted.collect()}
        used += bits
    found: dict[tuple[Any, int], int] = {}
    if places:
        order = Window.partitionBy("g", "prefix").orderBy("h")
        hits = (
            inside()
            .withColumn("place", F.row_number().over(order).cast("bigint"))
            .withColumn("after", F.lead("h").over(order))
            .join(held_in(), ["g", "prefix", "place"])
            .select("g", "r", "h", "after")
        )
        for g, r, h, after in hits.collect():
            if h == after:
                raise ValueError("the key columns do not tell rows apart: no exact cut exists")
            found[(g, r)] = h
    return {
        g: [NO_ROWS if r <= 0 else ALL_ROWS if r >= sizes[g] else found[(g, r)] for r in ranks]
        for g, ranks in wanted.items()
    }


def cut_table(rows: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """The groups ``by`` with ``cut``, the hash number at rank ``r`` of their n rows: ``hash_cuts`` for groups in a table.

    ``rows`` holds the groups and the hash number ``__h``, ``wanted`` the groups with n and r. A group has the more
    buckets the more rows it has, so a hot group is counted and ranked in as many tasks as it takes; only the one
    bucket of each group that holds its rank is ranked.
    """
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / ROWS_PER_BUCKET))).cast("int")
    open_ranks = wanted.where("r > 0 and r < n").select(*by, "r", bits.alias("__bits"))
    inside = rows.join(open_ranks, [*by]).withColumn("__k", F.expr(f"shiftright(__h, {HASH_BITS} - __bits)"))
    running = Window.partitionBy(*by).orderBy("__k")
    held = (
        inside.groupBy(*by, "__k").agg(F.count("*").alias("c"), F.first("r").alias("r"))
        .withColumn("upto", F.sum("c").over(running))
        .where("upto >= r and upto - c < r")
        .select(*by, "__k", F.expr("r - upto + c").alias("place"))
    )
    order = Window.partitionBy(*by, "__k").orderBy("__h")
    alike = F.raise_error(F.lit("the key columns do not tell rows apart: no exact cut exists")).cast("bigint")
    hits = (
        inside.drop("r", "__bits").join(held, [*by, "__k"])
        .withColumn("__n", F.row_number().over(order)).withColumn("__after", F.lead("__h").over(order))
        .where("__n = place")
        .select(*by, F.when(F.col("__h") == F.col("__after"), alike).otherwise(F.col("__h")).alias("__hit"))
    )
    cut = F.when(F.col("r") <= 0, NO_ROWS).when(F.col("r") >= F.col("n"), ALL_ROWS).otherwise(F.col("__hit"))
    return wanted.join(hits, [*by], "left").select(*by, cut.alias("cut"))


def up_to_cut(df: DataFrame, number: Column, cuts: dict[Any, int], group: Column) -> tuple[DataFrame, Column]:
    """The table and a boolean column: does the row's hash lie at or below its group's cut?"""
    if len(cuts) <= LITERAL_GROUPS:
        table = F.create_map(*[F.lit(v) for g, c in cuts.items() for v in (g, c)])
        return df, number <= F.try_element_at(table, group)
    small = df.sparkSession.createDataFrame(list(cuts.items()), f"__g {_type(df, group)}, __cut bigint")
    joined = df.withColumn("__g", group).join(F.broadcast(small), "__g", "left").drop("__g")
    return joined, number <= F.col("__cut")


def global_rank(
    df: DataFrame, number: Column, name: str, n: int, by: Sequence[str] = (), ties: Sequence[str] = ()
) -> DataFrame:
    """Add the exact rank 1..n in hash order (within each group of ``by``, of n rows each) as column ``name``.

    Buckets are ranked apart and shifted by the bucket counts before them. There are more buckets the more rows there
    are, so a task's share stays the same; their offsets are joined as a table of one row a bucket, without a hint.
    """
    bits = prefix_bits(n, ROWS_PER_BUCKET)
    rows = df.withColumn("__h", number).withColumn("__k", F.shiftright("__h", HASH_BITS - bits))
    here = F.row_number().over(Window.partitionBy(*by, "__k").orderBy("__h", *ties))
    if bits == 0:
        return rows.withColumn(name, here).drop("__h", "__k")
    before = Window.partitionBy(*by).orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*by, "__k").count()
        .select(*by, "__k", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    )
    return (
        rows.withColumn(name, here)
        .join(offsets, [*by, "__k"])
        .withColumn(name, F.col(name) + F.col("__before"))
        .drop("__h", "__k", "__before")
    )


def _type(df: DataFrame, column: Column) -> str:
    return df.select(column.alias("g")).schema["g"].dataType.simpleString()
