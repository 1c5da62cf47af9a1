"""From raw documents to token ids: quality rules, toxicity, near-duplicates, benchmark passages, piece ids.

Each stage reads what the one before has written. The first four drop documents and keep every column; the last adds
the ids and says whether they decode to the text.

Null and empty texts break a quality rule and go. Of rows alike in key and text one stays, whether the key is null or
not. Extra columns pass through all stages whatever their names, but a given ``ids``, ``n_ids`` or ``round_trip`` gives way
to the last stage's own. An empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import decontaminate, pieces, quality, simhash, toxicity
from holdfast.llm.common import free_name, text_of, written

#: Bytes of the caches of the last stage's workers: they also run the other stages, so it is little.
KEPT_BYTES = 96 << 20


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that break a quality rule."""
    return quality.kept_only(docs)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the chain, trained on the labelled ones among ``docs``, calls toxic."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group that the fingerprints link: four-word shingles, at most four of 64 bits apart."""
    return simhash.drop_near_duplicates(docs, simhash.Ring())


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the piece ids of every document, their number, and whether they decode to its text."""
    docs = docs.drop("ids", "n_ids", "round_trip")
    decoded = free_name(docs, "decoded")
    both = pieces.encode(docs, decoded=decoded, kept_bytes=KEPT_BYTES)
    same = F.col(decoded) == F.translate(text_of("text"), pieces.SPACE, " ")
    return both.withColumn("n_ids", F.size("ids").cast("long")).withColumn("round_trip", same).drop(decoded)


STAGES = [
    ("quality rules", good),
    ("toxicity", civil),
    ("simhash near-duplicates", distinct),
    ("benchmark decontamination", unseen),
    ("piece encoding and decoding", encoded),
]

#: SQL can't train the chain, make fingerprints or encode pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
