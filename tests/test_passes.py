"""What a fit reads and how often: tables held once, folds in shared passes."""

import pytest
from pyspark.sql import functions as F

from holdfast.operators import split, stats
from holdfast.plans import cv
from holdfast.plans.estimators import MedianRegressor


def test_fit_reads_an_unheld_table_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 3000, numPartitions=3).select((F.col("id") * 0.37).alias("x")).mapInArrow(count, "x double")

    def fit():
        median = (yield {"q": stats.Quantiles(F.col("x"), (0.5,))})["q"][0]
        return (yield {"n": stats.Agg({"n": F.count_if(F.col("x") < median)})})["n"]["n"]

    assert stats.fit_one(rows, fit()) == 1500
    assert read.value == 3000


def test_order_statistics_of_odd_values(spark):
    values = [None, float("nan"), float("inf"), float("-inf"), -1.7e308, 1.7e308, -0.0, 0.0, 2.0, 2.0, 5e-324, -3.5]
    rows = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    known = sorted(v for v in values if v is not None and v == v)
    found = stats.order_statistics(rows, {"x": list(range(1, len(known) + 1))})["x"]
    assert [found[i + 1] for i in range(len(known))] == known


def test_median_folds_equal_one_fold_at_a_time(house):
    folded = split.with_fold(house, ["id"], 3)
    label = cv.LABEL
    found = cv.score_folds(MedianRegressor(labelCol=label), folded, None, 3)
    for i, scores in enumerate(found):
        model = MedianRegressor(labelCol=label).fit(folded.where(F.col("fold") != i))
        for name, value in cv.fold_scores(folded, "fold", i, model).items():
            assert scores[name] == pytest.approx(value, rel=1e-12)
