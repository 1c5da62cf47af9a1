"""Requests for hundreds of quantiles of each column, and partials of long lines."""

import numpy as np
from pyspark.sql import functions as F

from holdfast.operators import partials, stats


def test_many_sketched_quantiles_are_one_expression_a_column(spark, monkeypatch):
    made, lit = [], F.lit
    monkeypatch.setattr(stats.F, "lit", lambda x: made.append(x) or lit(x))
    probs = tuple(i / 255 for i in range(1, 255))

    def fit():
        return (yield {str(c): stats.Quantiles(F.col("id") * (c + 1), probs, exact=False) for c in range(4)})

    found = stats.fit_one(spark.range(1, 1001).coalesce(2), fit())
    assert len(made) < 50
    want = spark.range(1, 1001).agg(F.percentile_approx("id", list(probs), 10_000)).first()[0]
    assert [found[str(c)] for c in range(4)] == [[float(v * (c + 1)) for v in want] for c in range(4)]


def test_long_lines_and_least_rows_add_up(spark, monkeypatch):
    assert dict(f.split() for f in partials._PARTIAL.split(", "))["value"] == "binary"
    monkeypatch.setattr(partials, "BATCH_BYTES", 1 << 12)
    rows = spark.range(0, 40, numPartitions=20).select(F.col("id").cast("double").alias("x"))
    wide = partials.Sums({"x": F.col("x")}, lambda c: np.outer([1.0, -1.0, 0.0], np.full(300, c["x"].sum())))
    near = partials.Least({"x": F.col("x")}, lambda c: np.abs(c["x"] - 20.0)[None, :], 3)
    for _ in range(2):
        total, least = partials.run_partials(rows, [wide, near])
        assert total.shape == (3, 300) and (total[0] == 780.0).all() and (total[1] == -780.0).all() and not total[2].any()
        assert least == {0: [(0.0, (20.0,)), (1.0, (19.0,)), (1.0, (21.0,))]}
