import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import clusters, steps
from holdfast.operators.partials import Least, Passes, Sums, run_partials
from holdfast.operators.stats import fit_one, fit_together, keep_all, keep_where


def points(frame, rows):
    return frame([tuple(map(float, r)) for r in rows], "latitude double, longitude double, population double")


def columns():
    return {c: F.col(c) for c in ("latitude", "longitude", "population")}


def fitted(df, **options):
    return np.array(fit_one(df, steps.Geo(**options).fit(columns(), keep_all))["centers"])


def inertia(rows, centers):
    rows = np.array(rows, float)
    return float((clusters.squared_gaps(rows[:, :2], np.array(centers)).min(1) * rows[:, 2]).sum())


def best_of_row_starts(rows, k, n_init, seed=0):
    """Ten k-means++ starts on all rows, each with Lloyd to its end."""
    rows = np.array(rows, float)
    x, w = rows[:, :2], rows[:, 2]
    found = []
    for s in range(n_init):
        rng = np.random.default_rng([seed, s])
        c = x[[rng.choice(len(x), p=w / w.sum())]]
        while len(c) < k:
            mass = clusters.squared_gaps(x, c).min(1) * w
            c = np.vstack([c, x[[rng.choice(len(x), p=mass / mass.sum())]]])
        for _ in range(300):
            home = clusters.squared_gaps(x, c).argmin(1)
            moved = np.array([np.average(x[home == i], axis=0, weights=w[home == i]) if (home == i).any() else c[i] for i in range(k)])
            if np.allclose(moved, c, atol=1e-12):
                break
            c = moved
        found.append(inertia(rows, c))
    return min(found)


def blobs(n=1500, k=10, seed=1):
    rng = np.random.default_rng(seed)
    at = rng.uniform(-10, 10, (k, 2))
    x = at[rng.integers(0, k, n)] + rng.normal(0, 0.3, (n, 2))
    return np.column_stack([x, rng.uniform(1, 50, n)])


def test_sums_and_least_rows_in_one_pass(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), F.when(F.col("id") % 3 > 0, F.col("id") * 2.0).alias("y")).repartition(7)
    inputs = {"x": F.col("x"), "y": F.col("y")}
    total = Sums(inputs, lambda c: np.array([[c["x"].sum(), np.nansum(c["y"])], [len(c["x"]), np.isnan(c["y"]).sum()]]))
    least = Least({"x": F.col("x")}, lambda c: np.array([np.abs(c["x"] - 500.0), np.where(c["x"] > 997, -1.0, np.inf)]), 3)
    a, b = run_partials(df, [total, least])
    assert a.tolist() == [[499500.0, 2 * sum(i for i in range(1000) if i % 3)], [1000.0, 334.0]]
    assert b == {0: [(0.0, (500.0,)), (1.0, (499.0,)), (1.0, (501.0,))], 1: [(-1.0, (998.0,)), (-1.0, (999.0,))]}
    passes = Passes(df)
    assert passes.run([least]) == passes.run([least]) == [b] and passes.tasks == 7
    none = run_partials(df.where("x < 0"), [total, least])
    assert none == [None, {}]


def test_as_good_as_the_best_of_ten_starts_on_all_rows(frame):
    for seed in (1, 2, 3):
        rows = blobs(seed=seed)
        assert inertia(rows, fitted(points(frame, rows), tol=0.0)) <= 1.0001 * best_of_row_starts(rows, 10, 10)


def test_every_start_moves_over_the_rows_until_it_rests(frame, monkeypatch):
    moved = []
    monkeypatch.setattr(clusters, "_inertia", lambda inputs, d, k, starts, judge=clusters._inertia: moved.append([*starts]) or judge(inputs, d, k, starts))
    rows = blobs(400, 6, seed=4)
    found = fitted(points(frame, rows), tol=0.0)
    (ends,) = moved
    assert len(ends) == 10
    for c in ends:
        assert np.allclose(clusters._settled(rows[:, :2], rows[:, 2], c), c, atol=1e-9)
    assert inertia(rows, found) == min(inertia(rows, c) for c in ends)


def test_one_far_outlier_leaves_ten_different_centres(frame):
    rows = [*blobs(800), (1e7, -1e7, 1.0)]
    found = fitted(points(frame, rows))
    assert len(np.unique(found, axis=0)) == 10
    assert np.abs(found - [1e7, -1e7]).sum(1).min() < 1e-3


def test_draws_follow_weight_and_distance():
    n = 20_000
    x = np.column_stack([np.arange(n) % 200, np.arange(n) // 200]).astype(float)
    w = np.where(np.arange(n) % 2, 3.0, 1.0)
    keys = clusters._race({"x0": x[:, 0], "x1": x[:, 1], "w": w}, 2, [5], None)[0]
    drawn = np.argsort(keys)[:2000]
    assert 0.70 < (w[drawn] == 3.0).mean() < 0.80
    centers = [np.array([[0.0, 0.0]])]
    keys = clusters._race({"x0": x[:, 0], "x1": x[:, 1], "w": w}, 2, [5], centers)[0]
    assert np.isinf(keys[0]) and np.argsort(keys)[:500].mean() > np.arange(n).mean()


def test_an_empty_cluster_moves_to_the_farthest_row(frame):
    rows = [(0, 0, 1), (0, 1, 1), (10, 0, 1), (10, 1, 1), (50, 50, 1)]
    found = fitted(points(frame, rows), n_clusters=3, start=[[0.0, 0.5], [10.0, 0.5], [-900.0, -900.0]], tol=0.0)
    assert found.tolist() == [[0.0, 0.5], [10.0, 0.5], [50.0, 50.0]]


def test_fewer_points_than_centres(frame):
    found = fitted(points(frame, [(1, 2, 3), (1, 2, 4), (5, 6, 7)]), n_clusters=4)
    assert found.shape == (4, 2) and np.unique(found, axis=0).tolist() == [[1.0, 2.0], [5.0, 6.0]]


def test_folds_advance_together_and_equal_separate_fits(frame, monkeypatch):
    rows = blobs(900, 4)
    df = points(frame, rows).withColumn("fold", F.pmod(F.xxhash64("latitude"), F.lit(3)).cast("int")).cache()
    step = steps.Geo(n_clusters=4, n_init=3)
    jobs = []
    monkeypatch.setattr(Passes, "run", lambda self, r, raw=(), run=Passes.run: jobs.append(len(r)) or run(self, r, raw))
    together = fit_together(df, [step.fit(columns(), keep_where(F.col("fold") != i)) for i in range(3)])
    assert jobs[0] == 6 and len(jobs) < 40
    for i, state in enumerate(together):
        alone = fit_one(df.where(F.col("fold") != i), step.fit(columns(), keep_all))
        assert np.allclose(state["centers"], alone["centers"], atol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1.0, 2.0, 3.0)]])
def test_hardly_any_rows(frame, rows):
    df = points(frame, rows)
    if not rows:
        with pytest.raises(ValueError, match="at least one"):
            fitted(df)
    else:
        assert fitted(df, n_clusters=2).tolist() == [[1.0, 2.0]] * 2
