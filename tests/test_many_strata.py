"""Strata by the hundred within one level: no level is gathered in one task."""

from pyspark.sql import functions as F

from holdfast.operators import split


def test_strata_of_one_level_meet_in_no_window(spark, plan, monkeypatch):
    monkeypatch.setattr(split, "LISTED_STRATA", 10)
    rows = spark.range(400).select("id", (F.col("id") % 50).alias("band"), F.lit("one level").alias("level"))
    found = split.strata(rows, F.col("band"), F.col("level"), min_per_stratum=2)
    assert found.sizes is None and found.size_table.count() == 50
    assert "Window" not in plan(found.collapsed_table)
    table = split.stratum_table(rows, F.col("band"), F.col("level"))
    assert "Window" not in plan(table) and table.select("stratum").distinct().count() == 50


def test_a_level_with_a_small_group_is_one_stratum(spark, monkeypatch):
    monkeypatch.setattr(split, "LISTED_STRATA", 2)
    rows = spark.createDataFrame([(i, i % 4, "a") for i in range(40)] + [(100, 0, "b"), (101, 1, "b")], "id long, band int, level string")
    found = split.strata(rows, F.col("band"), F.col("level"), min_per_stratum=2)
    assert {r["stratum"]: r["n"] for r in found.size_table.collect()} == {"0|a": 10, "1|a": 10, "2|a": 10, "3|a": 10, "b": 2}
