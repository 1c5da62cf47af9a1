"""The queries fit what their operators are set to: no fewer rounds, members, columns, sizes or folds."""

import pytest
from pyspark.ml import Pipeline

from checks import queries
from holdfast.operators import split
from holdfast.operators.branches import FeatureBranches
from holdfast.plans import final, leak, models
from holdfast.plans.estimators import as_vector


class Fitted(Exception):
    """Raised in place of a fit, with the estimator."""


def settings(stage):
    return {p.name: v for p, v in stage.extractParamMap().items()}


@pytest.fixture
def chain_of(spark, monkeypatch):
    """The stages that a query is about to fit."""

    def stop(self, dataset, params=None):
        raise Fitted(self)

    monkeypatch.setattr(queries, "held_housing", lambda *_: None)
    monkeypatch.setattr(split, "split_train_test", lambda df, keys, **_: (df, df))
    monkeypatch.setattr(Pipeline, "fit", stop)

    def run(name):
        with pytest.raises(Fitted) as found:
            queries.QUERIES[name](spark, "")
        return found.value.args[0].getStages()

    return run


@pytest.mark.parametrize("name", ["hgb", "lgbm", "xgb"])
def test_boosting_is_fitted_as_chosen(chain_of, name):
    branches, learner = chain_of(f"model_{name}")
    assert settings(learner) == settings(models.build(name, **models.CHOSEN[name]))
    assert settings(branches) == settings(FeatureBranches(**models.CHOSEN_FEATURES[name]))


def test_the_stack_has_its_members_as_chosen_and_all_folds(chain_of):
    branches, stack = chain_of("stack")
    whole = models.stack(["id"])
    assert list(stack.members) == list(models.MEMBERS) and settings(stack) == settings(whole)
    for name, member in stack.members.items():
        assert settings(member) == settings(whole.members[name])
    assert settings(branches) == settings(FeatureBranches(**models.CHOSEN_FEATURES["stack"]))


def test_the_final_evaluation_changes_no_arm_and_explains_the_best(spark, frame, monkeypatch):
    table = frame([(1, 2.0)], "id int, x double")
    arms, explained = [], []

    def evaluate(train, test, keys, *, overrides=None):
        arms.append(overrides or {})
        return {"ridge": "the model"}, frame([("ridge", "all", 1.0, 1.0, 1.0, 1)], "arm string, segment string, rmse double, mae double, r2 double, n bigint"), {}

    def explain(model, rows, keys, *, seed):
        explained.append((model, rows.count()))
        return table, table

    monkeypatch.setattr(queries, "held_housing", lambda *_: table)
    monkeypatch.setattr(final, "split_train_test", lambda df, keys, **_: (df, df))
    monkeypatch.setattr(final, "evaluate_arms", evaluate)
    monkeypatch.setattr(final, "explain", explain)
    assert queries.QUERIES["final_eval"](spark, "").count() == 1
    assert arms == [{}] and explained == [("the model", 1)]


def test_selection_is_from_200_noise_columns_in_five_folds(spark, frame, monkeypatch):
    seen = []

    def stop(wide, k, n_splits):
        seen.append((len(wide.first()["features"]), k, n_splits, sorted(r["fold"] for r in wide.select("fold").distinct().collect())))
        return 2.0, 1.0

    class Branches:
        def __init__(self, **_):
            pass

        def fit(self, df):
            return self

        def transform(self, df):
            return df.withColumn("branches", as_vector("x"))

    table = frame([(i, float(i), 1.0) for i in range(50)], f"id int, x double, {leak.LABEL} double")
    monkeypatch.setattr(queries, "held_housing", lambda *_: table)
    monkeypatch.setattr(leak, "FeatureBranches", Branches)
    monkeypatch.setattr(leak, "_selected_rmse", stop)
    assert queries.QUERIES["leak_selection"](spark, "").first()["leak"] == 1.0
    assert seen == [(201, 10, 5, [0, 1, 2, 3, 4])]


def test_the_leak_is_measured_at_all_sizes_in_five_folds(spark, monkeypatch):
    seen = []

    def fold(df, keys, *, n_splits=5, **_):
        seen.append((df, n_splits))
        return {"n": 1, "honest_rmse": 2.0, "leaked_rmse": 1.0, "leak": 1.0}

    monkeypatch.setattr(queries, "held_housing", lambda *_: "all")
    monkeypatch.setattr(leak, "sample_n", lambda df, n, keys, **_: n)
    monkeypatch.setattr(leak, "leak_fold", fold)
    assert queries.QUERIES["leak_by_size"](spark, "").count() == 4
    assert seen == [(300, 5), (1000, 5), (5000, 5), ("all", 5)]
