"""What the operators share: the shared folder, word rules, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these six ASCII characters; ``bytes.split()`` without arguments cuts at the same six.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a temporary one only where it is unset (local runs)."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="holdfast-llm-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read again: a lost executor then costs a read and no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(df: DataFrame, base: str) -> str:
    """``base`` with as many underscores before it as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of ``text`` as an array, without the empty strings that leading and trailing space leave."""
    return F.array_remove(F.split(text, SPACE_RUN, -1), "")


#: Words are runs of digits, letters and anything beyond ASCII; A-Z are lower-cased.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def folded_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()
