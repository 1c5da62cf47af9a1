"""The fitting engine: exact statistics, few passes, masks."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st_
from pyspark.sql import functions as F

from holdfast.operators.stats import (
    Agg,
    Quantiles,
    _ranks,
    fit_one,
    fit_together,
    keep_where,
    levels,
    order_statistics,
)


def ask(**requests):
    found = yield requests
    return found


def averaged(values, parts):
    """Averaged inverted distribution function by the textbook."""
    x, n = sorted(values), len(values)
    out = []
    for i in range(parts + 1):
        whole, rest = divmod(n * i, parts)
        if rest:
            out.append(x[whole])
        elif i in (0, parts):
            out.append(x[0] if i == 0 else x[-1])
        else:
            out.append((x[whole - 1] + x[whole]) / 2)
    return out


def test_quantiles_are_exact(house):
    x = [r[0] for r in house.select("total_bedrooms").collect() if r[0] is not None]
    found = fit_one(
        house,
        ask(a=Quantiles(F.col("total_bedrooms"), (0.0, 0.001, 0.25, 0.5, 0.999, 1.0)), b=Quantiles(F.col("total_bedrooms"), parts=12)),
    )
    assert np.allclose(found["a"], np.quantile(x, [0.0, 0.001, 0.25, 0.5, 0.999, 1.0]), rtol=1e-12)
    assert found["b"] == averaged(x, 12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st_.lists(st_.one_of(st_.floats(-1e300, 1e300), st_.sampled_from([0.0, 1.0, 5e-324, float("inf"), -float("inf")])), min_size=1, max_size=40))
def test_order_statistics_hold_for_any_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranks = sorted({1, len(values), (len(values) + 1) // 2})
    found = order_statistics(df, {"v": ranks})["v"]
    assert found == {r: sorted(values)[r - 1] for r in ranks}


def test_a_value_that_fills_a_third_of_the_table(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("v"))
    x = np.sort(np.array([7.0 if i % 3 == 0 else float(i) for i in range(30000)]))
    found = order_statistics(df, {"v": [1, 5000, 10004, 15000, 30000]})["v"]
    assert found == {r: x[r - 1] for r in found}


def test_ranks_are_integer_arithmetic():
    assert _ranks(Quantiles(F.lit(1), parts=10), 10)[7] == (7, 8, 0.5)
    assert _ranks(Quantiles(F.lit(1), parts=3), 10)[1] == (4, 4, 0.0)


def test_all_null_column_has_no_quantile(frame):
    df = frame([(None,), (None,)], "v double")
    assert fit_one(df, ask(q=Quantiles(F.col("v"), (0.5,))))["q"] is None


def test_nan_counts_as_null_and_infinities_as_ends(frame):
    x = [float("nan"), float("inf"), -float("inf"), 3.0, 1.0, None, float("inf")]
    found = fit_one(frame([(v,) for v in x], "v double"), ask(q=Quantiles(F.col("v"), (0.0, 0.25, 0.5, 1.0))))["q"]
    assert found == [-float("inf"), 1.0, 3.0, float("inf")]
    only = fit_one(frame([(float("nan"),), (float("inf"),)], "v double"), ask(q=Quantiles(F.col("v"), (0.5,))))["q"]
    assert only == [float("inf")]


def test_masks_equal_filters(house):
    even = F.col("id") % 2 == 0
    keep = keep_where(even)
    masked, filtered = (
        fit_one(house, ask(m=Agg({"a": F.avg(keep(F.col("population")))}), q=Quantiles(keep(F.col("population")), (0.3,)))),
        fit_one(house.where(even), ask(m=Agg({"a": F.avg("population")}), q=Quantiles(F.col("population"), (0.3,)))),
    )
    assert masked["q"] == filtered["q"]
    assert abs(masked["m"]["a"] - filtered["m"]["a"]) < 1e-9


def test_fits_of_the_same_depth_share_their_pass(house, monkeypatch):
    from holdfast.operators import stats

    passes = []
    real = stats._Reader.answer
    monkeypatch.setattr(stats._Reader, "answer", lambda self, asked: passes.append(len(asked)) or real(self, asked))

    def two_deep(c):
        first = yield {"m": Agg({"m": F.avg(c)})}
        second = yield {"s": Agg({"s": F.sum(F.col(c) - first["m"]["m"])})}
        return second["s"]["s"]

    sums = fit_together(house, [two_deep("population"), two_deep("households"), two_deep("total_rooms")])
    assert all(abs(s) < 1e-4 for s in sums)
    assert passes == [3, 3, 0]


def test_levels_are_sorted_and_mode_ties_take_the_smallest(frame):
    df = frame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "v string")
    assert levels(df, F.col("v")) == [("a", 2), ("b", 2), ("c", 1)]
    assert levels(df, F.col("v"), top=1) == [("a", 2)]
