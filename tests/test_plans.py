"""Metrics, models, validation, search, stacking, interpretation, leaks, the final record."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from holdfast import config
from holdfast.errors import RecordExistsError
from holdfast.operators.metrics import compare, regression_metrics, segment_table
from holdfast.operators.split import with_fold
from holdfast.plans import cv, final, interpret, leak, models, search
from holdfast.plans.estimators import MedianRegressor, RidgeRegressor, StackModel, StackRegressor, as_vector, fit_ridge_cv
from holdfast.sources.record import read_record, save_model, write_once, write_record

Y = config.TARGET
TINY = {
    "rf": {"n_estimators": 3, "max_depth": 3}, "lgbm": {"n_estimators": 2, "num_leaves": 8},
    "xgb": {"n_estimators": 2, "max_depth": 3}, "hgb": {"max_iter": 2, "max_leaf_nodes": 8},
}


def numbers(df, *columns):
    return np.array([tuple(r) for r in df.select(*columns).collect()], dtype=float)


# --- metrics --------------------------------------------------------------------------


def test_metrics_by_hand(frame):
    got = regression_metrics(frame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "y double, prediction double"), "y").first()
    assert got["n"] == 3 and abs(got["mae"] - 1) < 1e-12
    assert abs(got["rmse"] - (5 / 3) ** 0.5) < 1e-12 and abs(got["r2"] - (1 - 5 / 8)) < 1e-12


def test_undefined_metrics_are_null(frame):
    empty = regression_metrics(frame([], "y double, prediction double"), "y").first()
    assert tuple(empty) == (None, None, None, 0)
    one = regression_metrics(frame([(1.0, 1.0)], "y double, prediction double"), "y").first()
    assert (one["rmse"], one["r2"], one["n"]) == (0.0, None, 1)


def test_r2_survives_a_large_offset(frame):
    rows = [(1e9 + i, 1e9 + i + (0.1 if i % 2 else -0.1)) for i in range(10)]
    got = regression_metrics(frame(rows, "y double, prediction double"), "y").first()["r2"]
    assert abs(got - (1 - 0.1 / 82.5)) < 1e-6


def test_segments_overlap_keep_their_order_and_stay_when_empty(house):
    shifted = house.withColumn("prediction", F.col(Y) + F.when(F.col("ocean_proximity") == "INLAND", 50000.0).otherwise(0.0))
    got = segment_table(shifted).collect()
    assert [r["segment"] for r in got] == ["all", "uncensored", "censored", "inland", "coastal"]
    rows = {r["segment"]: r for r in got}
    assert rows["coastal"]["rmse"] == 0 and abs(rows["inland"]["rmse"] - 50000) < 1e-6
    assert rows["inland"]["n"] + rows["coastal"]["n"] == rows["censored"]["n"] + rows["uncensored"]["n"] == rows["all"]["n"]
    none = segment_table(shifted.where(f"{Y} < 400000 and {Y} > 20000")).where("segment = 'censored'").first()
    assert (none["n"], none["rmse"]) == (0, None)


def test_compare_puts_the_best_first(house):
    arms = {n: regression_metrics(house.withColumn("prediction", F.lit(v)), Y) for n, v in (("far", 9e6), ("near", 2e5))}
    assert [r["arm"] for r in compare(arms).collect()] == ["near", "far"]


# --- models ------------------------------------------------------------------------------


def test_median_model(sides):
    got = MedianRegressor(labelCol=Y).fit(sides[0]).transform(sides[1]).select("prediction").distinct().collect()
    assert [r[0] for r in got] == [np.median(numbers(sides[0], Y))]


@pytest.mark.parametrize("alpha", [0.01, 10.0, 1000.0])
def test_ridge_equals_the_closed_form(house, alpha):
    names = ["median_income", "latitude", "households"]
    df = house.withColumn("features", as_vector(*names))
    x, y = numbers(house, *names), numbers(house, Y)[:, 0]
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    model = RidgeRegressor(labelCol=Y, alpha=alpha).fit(df)
    assert np.allclose(model.coefficients.toArray(), want, rtol=1e-6)
    assert abs(model.intercept - (y.mean() - x.mean(0) @ want)) < 1e-3


def test_ridge_beats_the_floor_and_learns_the_signal(sides):
    scores = {}
    for name in ("dummy", "linear", "ridge"):
        model = models.model_chain(models.build(name)).fit(sides[0])
        scores[name] = regression_metrics(model.transform(sides[1]), Y).first()["rmse"]
    assert scores["ridge"] < 0.7 * scores["dummy"] and scores["linear"] < 0.7 * scores["dummy"]


def test_registry_refuses_unknown_names():
    with pytest.raises(KeyError, match="ridge"):
        models.arm("svm")
    with pytest.raises(KeyError, match="depth"):
        models.build("ridge", depth=3)


@pytest.mark.parametrize("name", ["ridge", "rf", "hgb", "xgb", "lgbm"])
def test_tuned_settings_reach_their_params(name):
    estimator = models.chosen(name)
    for key, value in models.CHOSEN[name].items():
        param, convert = models.arm(name).settings[key]
        assert estimator.getOrDefault(param) == convert(value)


@pytest.mark.parametrize("name", ["ridge", "rf", "hgb", "xgb", "lgbm"])
def test_every_search_value_resolves_and_is_accepted(name):
    space = search.search_space(name)
    search.resolve(name, space)
    for key, values in space.items():
        for value in values:
            branches, _ = search.build_draw(name, {key: value}, ["id"])
            branches.branches()


def test_unresolved_search_key_is_refused():
    with pytest.raises(KeyError, match="model__depth"):
        search.resolve("ridge", {"model__depth": [1]})


def test_draws_are_seeded_distinct_and_exhaustive():
    space = {"a": [1, 2, 3], "b": ["x", "y"]}
    assert search.random_draws(space, 4, 1) == search.random_draws(space, 4, 1) != search.random_draws(space, 4, 2)
    every = search.random_draws(space, 99, 0)
    assert len(every) == 6 and len({json.dumps(d) for d in every}) == 6


# --- validation, search, stack -------------------------------------------------------------


def test_cross_validation_by_hand(house):
    found = cv.summarise(cv.score_folds(MedianRegressor(labelCol=Y), with_fold(house, ["id"]), None, 5))
    rows = numbers(with_fold(house, ["id"]), Y, "fold")
    rmse = [np.sqrt(np.mean((rows[rows[:, 1] == i, 0] - np.median(rows[rows[:, 1] != i, 0])) ** 2)) for i in range(5)]
    assert abs(found["rmse"] - np.mean(rmse)) < 1e-6 and abs(found["rmse_std"] - np.std(rmse)) < 1e-6


def test_cross_validation_refits_everything(house):
    found = cv.cross_validate("ridge", house, ["id"], n_splits=2, preprocess={"nClusters": 3}, return_models=True)
    (a, _), (b, _) = found["models"]
    assert a.getOrDefault(a.branches) != b.getOrDefault(b.branches)
    again = cv.cross_validate("ridge", house.repartition(7), ["id"], n_splits=2, preprocess={"nClusters": 3})
    assert abs(found["rmse"] - again["rmse"]) < 1e-4
    assert found["rmse_train"] < 1.5 * found["rmse"]


def test_search_picks_the_best_draw_and_refits(house):
    space = {"model__alpha": [0.1, 1e7], "preprocess__geo__n_clusters": [3]}
    found = search.random_search("ridge", house, ["id"], n_iter=2, n_splits=2, space=space)
    assert found.best_params["model__alpha"] == 0.1 and found.best_score == min(r["rmse"] for r in found.results)
    board = search.leaderboard(found.table(house), 1).collect()
    assert len(board) == 1 and abs(board[0]["cv_rmse"] - found.best_score) < 1e-9
    assert found.best_model.transform(house).select("prediction").na.drop().count() == house.count()


def test_a_failing_draw_stops_the_search(house):
    with pytest.raises(Exception, match="log1p"):
        bad = house.withColumn("population", F.lit(-5.0))
        search.random_search("ridge", bad, ["id"], n_iter=1, n_splits=2, space={"preprocess__heavy__deskew": ["log"]})


def test_ridge_cv_equals_leaving_out_every_row(frame):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 2))
    y = x @ [2.0, -1.0] + rng.normal(size=40)
    df = frame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    alphas = [0.1, 10.0, 1000.0]

    def left_out(alpha):
        total = 0.0
        for i in range(40):
            keep = np.arange(40) != i
            mx, my = x[keep].mean(0), y[keep].mean()
            w = np.linalg.solve((x[keep] - mx).T @ (x[keep] - mx) + alpha * np.eye(2), (x[keep] - mx).T @ (y[keep] - my))
            total += (y[i] - my - (x[i] - mx) @ w) ** 2
        return total

    _, _, alpha = fit_ridge_cv(df, [F.col("a"), F.col("b")], F.col("y"), alphas)
    assert alpha == min(alphas, key=left_out)


def test_stack_trusts_the_useful_member(sides, tmp_path):
    train, test = (s.withColumn("features", as_vector("median_income", "latitude")) for s in sides)
    stack = StackRegressor({"good": RidgeRegressor(alpha=1.0), "flat": RidgeRegressor(alpha=1e12)}, keyCols=["id"], labelCol=Y, folds=3)
    model = stack.fit(train)
    weights = model.getOrDefault(model.weights)
    assert abs(weights[0] - 1) < 0.2
    good = RidgeRegressor(alpha=1.0, labelCol=Y).fit(train)
    scores = [regression_metrics(m.transform(test), Y).first()["rmse"] for m in (model, good)]
    assert scores[0] < 1.02 * scores[1]
    save_model(model, str(tmp_path / "stack"))
    loaded = StackModel.load(str(tmp_path / "stack"))
    assert numbers(loaded.transform(test).orderBy("id"), "prediction").tolist() == numbers(model.transform(test).orderBy("id"), "prediction").tolist()


def test_out_of_fold_rows_never_saw_themselves(house):
    df = house.withColumn("features", as_vector("median_income"))
    stack = StackRegressor({"m": MedianRegressor()}, keyCols=["id"], labelCol=Y, folds=3)
    rows = numbers(stack.out_of_fold(df), "fold", Y, "oof_m")
    for i in range(3):
        assert set(rows[rows[:, 0] == i, 2]) == {np.median(rows[rows[:, 0] != i, 1])}
    assert len(rows) == house.count()


# --- interpretation and leaks -----------------------------------------------------------------


SCORER = interpret.LinearScorer({"median_income": 28000.0, "population": -2.0}, 50000.0, {"INLAND": -9000.0})


def test_a_shuffle_keeps_the_values_and_only_that_column(house):
    got = interpret.permuted(house, ["population", "ocean_proximity"], ["id"], n_repeats=2).persist()
    assert got.count() == 4 * house.count()
    one = got.where("column = 'population' and repeat = 1")
    assert sorted(numbers(one, "population")[:, 0]) == sorted(numbers(house, "population")[:, 0])
    both = one.join(house.select("id", F.col("population").alias("p"), F.col("ocean_proximity").alias("o")), "id")
    assert both.where("ocean_proximity <> o").count() == 0 and both.where("population <> p").count() > 1400


def test_signal_outranks_noise(house):
    table = interpret.importance_table(SCORER, house, ["id"], n_repeats=2)
    rows = table.collect()
    assert rows[0]["column"] == "median_income" and len(rows) == 9
    flags = {r["column"]: r["unsupported"] for r in interpret.importance_flag(table).collect()}
    assert not flags["median_income"]


def test_partial_dependence_of_a_line_is_a_line(house):
    got = interpret.partial_dependence(SCORER, house, ["median_income", "ocean_proximity"], points=11)
    line = sorted((float(r["grid"]), r["average"]) for r in got.where("feature = 'median_income'").collect())
    steps = np.diff([a for _, a in line]) / np.diff([g for g, _ in line])
    assert len(line) == 11 and np.allclose(steps, 28000.0)
    levels = {r["grid"]: r["average"] for r in got.where("feature = 'ocean_proximity'").collect()}
    assert abs(levels["INLAND"] - levels["ISLAND"] + 9000.0) < 1e-6


def test_selection_prefers_the_signal(house):
    noisy = leak.noise_columns(house.na.drop(), ["id"], 5)
    names = ["median_income", "households", *[f"noise_{i}" for i in range(5)]]
    best = [r["column"] for r in leak.select_k_best(noisy, names, 2).collect()]
    assert best[0] == "median_income"
    ready = noisy.withColumn("features", as_vector(*names))
    assert leak.selector(1).fit(ready).selectedFeatures == [0]


def test_noise_is_standard_normal_and_repeatable(house):
    noise = leak.noise_columns(house.select("id"), ["id"], 3)
    x = numbers(noise.orderBy("id"), "noise_0", "noise_1")
    assert np.abs(x.mean(0)).max() < 0.1 and np.abs(x.std(0) - 1).max() < 0.1
    assert (x == numbers(leak.noise_columns(house.select("id").repartition(9), ["id"], 3).orderBy("id"), "noise_0", "noise_1")).all()


def test_the_whitelist_stops_the_leaky_column(house):
    found = leak.leak_column(house, ["id"], n_splits=2, nClusters=3)
    assert found["clean"] == pytest.approx(found["whitelisted"], rel=1e-9)
    assert found["forced"] < 0.2 * found["clean"]


def test_preprocessing_leak_is_small(house):
    found = leak.leak_fold(house, ["id"], n_splits=2, nClusters=3)
    assert abs(found["leak_share"]) < 0.05 and found["n"] == house.count()


# --- the final record -----------------------------------------------------------------------------


def test_final_evaluation_records_once(spark, house, tmp_path):
    out = str(tmp_path / "final")
    got = final.final_evaluation(house, ["id"], overrides=TINY, out=out)
    record = read_record(spark, f"{out}/record")
    assert record["arms"] == ["dummy", "ridge", "rf", "lgbm", "stack"]
    assert len(record["segments"]) == 25 and record["n_train"] + record["n_test"] == house.count()
    assert len(record["importance"]) == 9 and set(record["timings_seconds"]) == set(final.ARMS)
    assert {r["feature"] for r in got["dependence"].collect()} == {"median_income", "housing_median_age"}
    top = spark.read.csv(f"{out}/headline", header=True, inferSchema=True).collect()
    assert [r["rmse"] for r in top] == sorted(r["rmse"] for r in top) and top[-1]["arm"] == "dummy"


def test_a_record_is_replaced_only_on_request(spark, house, tmp_path):
    out = str(tmp_path / "once")
    table = compare({"a": regression_metrics(house.withColumn("prediction", F.lit(1.0)), Y)})
    write_once(spark, {"run": 1}, table, out)
    with pytest.raises(RecordExistsError):
        write_once(spark, {"run": 2}, table, out)
    assert read_record(spark, f"{out}/record") == {"run": 1}
    write_record(spark, {"run": 3}, f"{out}/record", rerun=True)
    assert read_record(spark, f"{out}/record") == {"run": 3}


def test_chains_are_one_estimator():
    assert isinstance(models.chosen_chain("ridge"), Pipeline)
