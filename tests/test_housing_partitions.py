"""The derived table's partitions grow in number with its rows, not in size."""

from checks import housing


def test_a_partition_holds_a_bounded_number_of_rows(spark, monkeypatch):
    few = housing.housing(spark, "/root/testdata/sf0.001").rdd.getNumPartitions()
    assert few == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(housing, "PARTITION_ROWS", 100)
    assert housing.housing(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == 15
