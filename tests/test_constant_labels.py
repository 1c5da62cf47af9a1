"""A label or column of one value varies by nothing, however its rows are dealt out."""

import pytest
from pyspark.sql import functions as F

from holdfast.operators import metrics, steps
from holdfast.operators.stats import fit_one, keep_all
from holdfast.plans import cv
from holdfast.plans.estimators import MedianRegressor


@pytest.fixture
def dealt(spark):
    """Partitions of 22 equal values, 11 to a fold: merged with an empty buffer, the mean of 11 or 22 of them isn't the value any more."""
    columns = {cv.LABEL: F.lit(500001.0), "prediction": F.lit(250000.0), "ocean_proximity": F.lit("INLAND"), "fold": (F.col("id") % 2).cast("int")}
    return spark.range(0, 88, numPartitions=4).withColumns(columns)


def test_r2_of_a_constant_label_is_zero(dealt):
    assert metrics.regression_metrics(dealt, cv.LABEL).first()["r2"] == 0.0
    found = {r["segment"]: r for r in metrics.segment_table(dealt).collect()}
    assert {s: found[s]["r2"] for s in ("all", "censored", "inland")} == {"all": 0.0, "censored": 0.0, "inland": 0.0}
    assert (found["all"]["n"], found["coastal"]["n"], found["coastal"]["r2"]) == (88, 0, None)


def test_r2_of_a_constant_fold_is_one_where_the_median_hits(dealt):
    for fold in cv.score_folds(MedianRegressor(labelCol=cv.LABEL), dealt, None, 2):
        assert (fold["test_r2"], fold["train_r2"]) == (1.0, 1.0)


def test_a_constant_column_has_no_scale(dealt):
    state = fit_one(dealt, steps.Scale().fit({"x": F.col(cv.LABEL)}, keep_all))
    assert state == {"center": {"x": 500001.0}, "scale": {"x": 0.0}}
