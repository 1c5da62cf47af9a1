"""The assembled branches: names, whitelist, leakage as a property, persistence, streams."""

import json

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from holdfast import config
from holdfast.operators.branches import BranchesModel, FeatureBranches, feature_names
from holdfast.operators.split import with_fold
from holdfast.plans.models import chosen_chain, model_chain


@pytest.fixture(scope="module")
def fitted(sides):
    return FeatureBranches().fit(sides[0])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_thirty_six_columns_with_branch_prefixes(fitted):
    names = fitted.feature_names()
    assert len(names) == 36
    assert [sum(n.startswith(b + "__") for n in names) for b in ("geo", "ratios", "heavy", "plain", "categorical", "binned")] == [
        10, 3, 4, 4, 5, 10]
    assert "categorical__ocean_proximity_lt1H OCEAN" in names


def test_vector_carries_the_names(fitted, house):
    schema = fitted.transform(house).schema["features"].metadata["ml_attr"]["attrs"]
    assert [a["name"] for kind in schema.values() for a in kind] == fitted.feature_names()


def test_only_declared_columns_reach_the_vector(sides, fitted):
    poisoned = sides[0].withColumn("cheat", F.col(config.TARGET)).withColumn("appraisal", F.col(config.TARGET) * 0.98)
    again = FeatureBranches().fit(poisoned)
    assert again.getOrDefault(again.branches) == fitted.getOrDefault(fitted.branches)


def test_a_row_transforms_the_same_alone_or_in_company(fitted, sides):
    whole = fitted.feature_frame(sides[1], ["id"]).where("id = 4")
    alone = fitted.feature_frame(sides[1].where("id = 4"), ["id"])
    assert rows(whole) == rows(alone) and whole.count() == 1


def test_transform_is_a_narrow_projection(fitted, house, plan):
    tree = plan(fitted.feature_frame(house)).split("InMemoryTableScan")[0]
    assert "Exchange" not in tree and "Aggregate" not in tree and "Window" not in tree


def test_statistics_move_with_training_rows_only(sides, fitted):
    train, test = sides
    state = json.dumps(fitted.getOrDefault(fitted.branches))
    wild = test.withColumn("population", F.lit(9e9)).withColumn("median_income", F.lit(19.0))
    fitted.transform(wild).count()
    assert json.dumps(fitted.getOrDefault(fitted.branches)) == state
    moved = FeatureBranches().fit(train.unionByName(test.withColumn("population", F.lit(9e4))))
    assert json.dumps(moved.getOrDefault(moved.branches)) != state  # the check can fail


def test_fused_folds_equal_separate_fits(house):
    folded = with_fold(house, ["id"], 3).persist()
    fused = FeatureBranches(deskew="yeo-johnson", nClusters=4).fit_folds(folded, "fold", 3)
    for i, model in enumerate(fused):
        alone = FeatureBranches(deskew="yeo-johnson", nClusters=4).fit(folded.where(F.col("fold") != i))
        a, b = model.feature_frame(house, ["id"]).orderBy("id"), alone.feature_frame(house, ["id"]).orderBy("id")
        assert a.columns == b.columns
        gap = max(abs(x - y) for r, s in zip(a.collect(), b.collect()) for x, y in zip(r, s))
        assert gap < 1e-6


def test_nulls_and_unseen_levels_never_reach_the_model(fitted, house):
    odd = house.withColumn("total_bedrooms", F.lit(None).cast("double")).withColumn("ocean_proximity", F.lit("NEAR LAKE"))
    frame = fitted.feature_frame(odd)
    assert frame.where(" or ".join(f"`{c}` is null or isnan(`{c}`)" for c in frame.columns)).count() == 0


def test_an_institution_does_not_blow_up_the_ratios(sides, fitted):
    odd = sides[1].withColumn("households", F.lit(6.0)).withColumn("population", F.lit(7460.0)).withColumn("total_rooms", F.lit(19.0))
    highest = fitted.feature_frame(odd).agg(F.max("ratios__population_per_household")).first()[0]
    assert highest < 10


@pytest.mark.parametrize("options", [
    {"imputer": "mean", "scaler": "robust"}, {"scaler": "minmax", "deskew": "none"}, {"scaler": "none", "encoder": "ordinal"},
    {"heavyImputer": "knn", "keyCols": ["id"]}, {"imputer": "iterative", "nBins": 3}, {"exact": False},
])
def test_every_choice_fits_and_transforms(sides, options):
    model = FeatureBranches(nClusters=3, **options).fit(sides[0])
    assert model.transform(sides[1]).select("features").count() == sides[1].count()


def test_missing_column_is_named(house):
    with pytest.raises(ValueError, match="households"):
        FeatureBranches().fit(house.drop("households"))


@pytest.mark.parametrize("options", [{}, {"heavyImputer": "knn", "keyCols": ["id"]}])
def test_save_and_load(spark, sides, tmp_path, options):
    model = FeatureBranches(nClusters=3, **options).fit(sides[0])
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = BranchesModel.load(str(tmp_path / "m"))
    assert rows(loaded.feature_frame(sides[1], ["id"])) == rows(model.feature_frame(sides[1], ["id"]))


def test_chain_saves_and_loads(sides, tmp_path):
    chain = chosen_chain("ridge").fit(sides[0])
    chain.write().overwrite().save(str(tmp_path / "chain"))
    loaded = PipelineModel.load(str(tmp_path / "chain"))
    assert rows(loaded.transform(sides[1]).select("id", "prediction")) == rows(chain.transform(sides[1]).select("id", "prediction"))
    assert feature_names(loaded) == feature_names(chain)


def test_a_stream_is_scored_without_state(spark, sides, fitted, tmp_path):
    folder = str(tmp_path / "in")
    sides[1].write.parquet(folder)
    stream = spark.readStream.schema(sides[1].schema).parquet(folder)
    query = fitted.feature_frame(stream, ["id"]).writeStream.format("memory").queryName("scored").outputMode("append").start()
    try:
        query.processAllAvailable()
        assert rows(spark.table("scored")) == rows(fitted.feature_frame(sides[1], ["id"]))
    finally:
        query.stop()


def test_pipeline_of_branches_and_model(sides):
    from holdfast.plans.estimators import MedianRegressor

    chain = model_chain(MedianRegressor(labelCol=config.TARGET), nClusters=3)
    assert isinstance(chain, Pipeline)
    assert chain.fit(sides[0]).transform(sides[1]).select("prediction").distinct().count() == 1
