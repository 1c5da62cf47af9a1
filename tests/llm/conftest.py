"""Small tables with every awkward case, and a query's rows as plain values."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("row", T.StringType()),
])

AWKWARD = [
    (1, "the cat sat on the mat and the dog lay by the door of the house " * 6, "a", True, "x"),
    (2, None, None, None, None),
    (3, "", "b", False, "y"),
    (4, " \t\n\x0b\x0c\r ", "c", True, "z"),
    (5, "One", "d", True, "w"),
    (5, "One", "d", True, "w"),
    (None, "no id at all in this row", "e", None, "v"),
    (6, "ÀÉ中文 é▁x \x00 \\ <s> [INST] naïve ﬁ ①", "f", True, "u"),
    (7, "long " * 30_000 + "end", "g", True, "t"),
    (8, "a" * 5_000 + " " * 300 + "b", "h", True, "s"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns whose names the operators use inside."""
    return spark.createDataFrame(AWKWARD, DOCUMENT)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def sf(tmp_path_factory, spark):
    """A folder with the tables that the queries read: the smallest given documents, and the awkward ones."""
    return "/root/testdata/sf0.001"
