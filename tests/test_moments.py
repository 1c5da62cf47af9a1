import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from holdfast.operators import moments, profile
from holdfast.operators.branches import FeatureBranches
from holdfast.operators.split import with_fold
from holdfast.plans import cv, leak, search
from holdfast.plans.ridge import RidgeModel, RidgeRegressor, ridge_folds

Y = "median_house_value"


def test_pairwise_complete_correlations_of_many_columns(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (500, 60)) @ rng.normal(0, 1, (60, 60)) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    names = [f"c{i}" for i in range(60)]
    rows = [[None if np.isnan(v) else float(v) for v in row] for row in x]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    found = {(r["column"], r["other"]): r["corr"] for r in profile.corr_matrix(df, names).collect()}
    for i in range(0, 60, 7):
        for j in range(60):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert abs(found[names[i], names[j]] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9
    scores = {r["column"]: r["f"] for r in leak.f_scores(df, names[1:], "c0").collect()}
    both = ~np.isnan(x[:, 0]) & ~np.isnan(x[:, 3])
    r = np.corrcoef(x[both, 0], x[both, 3])[0, 1]
    assert abs(scores["c3"] - r * r / (1 - r * r) * (both.sum() - 2)) < 1e-6


def test_constant_empty_and_missing_columns(frame):
    df = frame([(0.1, None, 1.0), (0.1, None, 2.0), (0.1, None, 4.0)], "a double, b double, c double")
    found = {(r["column"], r["other"]): r["corr"] for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert {k for k, v in found.items() if v is not None} == {("c", "c")} and abs(found["c", "c"] - 1.0) < 1e-12
    assert {r["corr"] for r in profile.corr_matrix(df.where("c < 0"), ["a", "c"]).collect()} == {None}
    assert [r["f"] for r in leak.f_scores(df, ["a", "b"], "c").collect()] == [None, None]


def solved(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - w @ x.mean(0)


def test_all_folds_and_penalties_equal_separate_fits(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(5, 2, (300, 4)) * [1, 10, 100, 0.1]
    y = x @ [3, 0.2, -0.01, 5] + rng.normal(0, 1, 300)
    rows = [(i, i % 5, Vectors.dense(x[i]), None if i == 7 else float(y[i])) for i in range(300)]
    df = spark.createDataFrame(rows, ["id", "fold", "features", "label"]).repartition(4)
    passes = []
    from holdfast.plans import ridge

    for module in (moments, ridge):
        monkeypatch.setattr(module, "run_partials", lambda *a, run=module.run_partials, **k: passes.append(1) or run(*a, **k))
    alphas = [0.0, 1.0, 1e4]
    found = ridge_folds(RidgeRegressor(), alphas, df, cv.feature_arrays(RidgeRegressor(), None), 5, label="label")
    assert len(passes) == 2
    known = np.arange(300) != 7
    for a, alpha in enumerate(alphas):
        for i, record in enumerate(found[a]):
            train, test = known & (np.arange(300) % 5 != i), known & (np.arange(300) % 5 == i)
            w, b = solved(x[train], y[train], alpha)
            error = y[test] - x[test] @ w - b
            assert np.allclose(record["model"].coefficients.toArray(), w, rtol=1e-6) and record["test_n"] == test.sum()
            assert np.isclose(record["test_rmse"], np.sqrt((error**2).mean())) and np.isclose(record["test_mae"], np.abs(error).mean())
            assert np.isclose(record["test_r2"], 1 - (error**2).sum() / ((y[test] - y[test].mean()) ** 2).sum())
            assert np.isclose(record["train_rmse"], np.sqrt(((y[train] - x[train] @ w - b) ** 2).mean()))
    generic = cv.fold_scores(df, "fold", 2, found[1][2]["model"], "label")
    assert all(np.isclose(found[1][2][k], v) for k, v in generic.items())


def test_ridge_model_scores_and_is_saved(spark, tmp_path):
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]), 3.0), (Vectors.dense([2.0, 4.0]), 5.0), (Vectors.dense([3.0, 6.0]), 7.0)], ["features", "label"])
    model = RidgeRegressor(alpha=0.0).fit(df)
    model.write().overwrite().save(str(tmp_path / "r"))
    assert np.allclose([r.prediction for r in RidgeModel.load(str(tmp_path / "r")).transform(df).collect()], [3.0, 5.0, 7.0])
    with pytest.raises(ValueError, match="label"):
        RidgeRegressor().fit(df.where("label < 0"))
    with pytest.raises(Exception, match="null or NaN"):
        RidgeRegressor().fit(spark.createDataFrame([(Vectors.dense([1.0]), 1.0), (Vectors.dense([float("nan")]), 1.0)], ["features", "label"]))


def test_settings_fitted_together_equal_their_own_fits(house):
    folded = with_fold(house.where("id % 3 = 0"), ["id"], 3).persist()
    many = [FeatureBranches(nClusters=3, gamma=0.1), FeatureBranches(nClusters=3, gamma=2.0, deskew="none"), FeatureBranches(nClusters=4, nBins=3)]
    together = FeatureBranches.fit_folds_together(many, folded, "fold", 3)
    for one, models in zip(many[1:], together[1:]):
        alone = one.fit_folds(folded, "fold", 3)
        assert np.allclose(
            np.array(models[1].feature_frame(folded, ["id"]).orderBy("id").collect(), float), np.array(alone[1].feature_frame(folded, ["id"]).orderBy("id").collect(), float))


def test_search_over_penalties_needs_no_further_passes(house):
    space = {"model__alpha": [0.01, 0.1, 1.0, 10.0, 100.0], "preprocess__geo__gamma": [0.1, 1.0]}
    found = search.random_search("ridge", house.where("id % 3 = 0"), ["id"], n_iter=10, n_splits=3, space=space, nClusters=3)
    one = next(r for r in found.results if r["params"] == {"model__alpha": 10.0, "preprocess__geo__gamma": 1.0})
    alone = cv.cross_validate(RidgeRegressor(labelCol=Y, alpha=10.0), house.where("id % 3 = 0"), ["id"], n_splits=3, preprocess={"nClusters": 3, "gamma": 1.0})
    assert len(found.results) == 10 and np.isclose(one["rmse"], alone["rmse"]) and np.isclose(one["mae_std"], alone["mae_std"])


def test_folds_that_learned_different_numbers_of_features(frame):
    rng = np.random.default_rng(5)
    rows = [(i % 3, *map(float, rng.normal(0, 1, 3)), float(rng.normal(0, 1))) for i in range(60)]
    df = frame(rows, "fold int, a double, b double, c double, y double").repartition(3)
    wide, narrow = F.array("a", "b", "c"), F.array("a", "c")
    masks = [F.col("fold") != i for i in range(3)]
    together = moments.target_moments(df, [wide, narrow, wide], F.col("y"), masks)
    for array, mask, found in zip([wide, narrow, wide], masks, together):
        alone = moments.target_moments(df, [array], F.col("y"), [mask])[0]
        assert found.n == alone.n and np.allclose(found.xx, alone.xx) and np.allclose(found.xy, alone.xy) and np.allclose(found.x_mean, alone.x_mean)
    scores = ridge_folds(RidgeRegressor(labelCol="y"), [1.0], df, [wide, narrow, wide], 3, label="y")[0]
    assert [len(s["model"].getOrDefault(s["model"].weights)) for s in scores] == [3, 2, 3]
