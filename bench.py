"""Seconds per headline job at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``: one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.housing import housing  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from holdfast import config  # noqa: E402
from holdfast.operators.branches import FeatureBranches  # noqa: E402
from holdfast.operators.knn import KnnImputer  # noqa: E402
from holdfast.operators.metrics import segment_table  # noqa: E402
from holdfast.operators.split import split_train_test  # noqa: E402
from holdfast.plans import cv, interpret, models  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SIMPLE = ("safe_divide", "impute_median", "numeric_block", "onehot_infrequent", "bin_quantile", "histogram", "corr_matrix",
          "missing_by_level", "split_stratified", "coverage_by_seed", "kfold", "sample_n", "segment_table", "perm_importance")


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, job):
        started = time.time()
        out = job()
        seconds[name] = round(time.time() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
        return out

    QUERIES["segment_error_of_median"](spark, SF_DIR).collect()  # warm-up: JVM, code cache
    for name in SIMPLE:
        timed(name, lambda name=name: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())

    house = housing(spark, SF_DIR).persist()
    house.count()
    train, test = split_train_test(house, ["id"])
    train, test = train.persist(), test.persist()
    train.count(), test.count()

    def fit_score(name, **overrides):
        branches = FeatureBranches(**models.chosen_features(name)).fit(train)
        estimator = models.chosen(name, **overrides)
        ready = branches.transform(train).select(config.TARGET, "features")
        if models.is_iterative(estimator):
            ready = ready.persist()
        model = estimator.fit(ready)
        rows = segment_table(model.transform(branches.transform(test))).collect()
        ready.unpersist()
        return branches, model, rows

    timed("features_default", lambda: FeatureBranches().fit(train))
    timed("features_yeo_johnson", lambda: FeatureBranches(deskew="yeo-johnson").fit(train))
    timed("features_five_folds", lambda: FeatureBranches().fit_folds(
        train.withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(5)).cast("int")), "fold", 5))
    timed("impute_knn", lambda: KnnImputer(inputCols=config.HEAVY_TAILED_COLUMNS, keyCols=["id"]).fit(train)
          .transform(train).write.format("noop").mode("overwrite").save())
    timed("fit_score_dummy", lambda: fit_score("dummy"))
    branches, ridge, _ = timed("fit_score_ridge", lambda: fit_score("ridge"))
    timed("fit_score_rf_20_trees", lambda: fit_score("rf", n_estimators=20, max_depth=10))
    timed("fit_score_lgbm_20_rounds", lambda: fit_score("lgbm", n_estimators=20, num_leaves=32))
    timed("cv_ridge", lambda: cv.cross_validate("ridge", train, ["id"]))
    from pyspark.ml import PipelineModel

    chain = PipelineModel([branches, ridge])
    timed("partial_dependence_ridge", lambda: interpret.partial_dependence(
        chain, train.sample(0.02, seed=1), ["median_income", "housing_median_age"]).collect())
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
