"""Places in an order, for tables too long for one task: range-partitioned, counted, shifted."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: ``monotonically_increasing_id`` counts the rows of a partition in its lower bits.
_PLACE_BITS = 33


def settled(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the folder that all executors share; a temporary one only in local mode."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="holdfast-"))
    return df.checkpoint()


def with_place(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the place 1..n of each row in ``order`` as column ``name``.

    The sort is Spark's own range partitioning. It is checkpointed, so that a row's partition, and its place there, stay
    what they are; the rows before each partition are a table of one row a partition.
    """
    at = F.monotonically_increasing_id()
    rows = settled(df.orderBy(*order).withColumn("__at", at)).withColumn("__part", F.shiftright("__at", _PLACE_BITS))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("__part").count().select(
        "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before")
    )
    here = F.col("__at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1
    return (
        rows.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + here)
        .drop("__at", "__part", "__before")
    )


def level_codes(df: DataFrame, value: Column) -> DataFrame:
    """value, code: the distinct non-null values with their places 0, 1, 2, ... in ascending order, however many there are."""
    levels = df.select(value.alias("value")).where("value is not null").distinct()
    return with_place(levels, [F.col("value")], "code").withColumn("code", F.col("code") - 1)


@dataclass(frozen=True)
class LevelCodes:
    """Ordinal codes of a column with any number of levels: a table of the training levels, joined when applied.

    ``steps.Ordinal`` holds its levels as literals, which suits the few levels of a category. Codes are doubles; a level
    that wasn't trained is -1, and so is null, as there. Extra columns pass through.
    """

    column: str
    codes: DataFrame

    @classmethod
    def fit(cls, df: DataFrame, column: str) -> LevelCodes:
        return cls(column, level_codes(df, F.col(f"`{column}`")))

    def transform(self, df: DataFrame) -> DataFrame:
        codes = self.codes.select(F.col("value").alias("__value"), F.col("code").cast("double").alias("__code"))
        joined = df.join(codes, F.col(f"`{self.column}`") == F.col("__value"), "left")
        return joined.withColumn(self.column, F.coalesce("__code", F.lit(-1.0))).drop("__value", "__code")
