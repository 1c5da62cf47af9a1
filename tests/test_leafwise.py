import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from holdfast.plans import leafwise, models
from holdfast.plans.leafwise import LeafwiseModel, LeafwiseRegressor


def table(spark, x, y):
    return spark.createDataFrame([(i, Vectors.dense(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], ["id", "features", "label"]).repartition(3, "id")


def greedy(x, y, leaves, least=1, penalty=0.0):
    """Best-first growth by trying every value of every feature; the rows of each leaf."""
    parts = [np.arange(len(y))]

    def best(rows):
        found = (0.0, None)
        for j in range(x.shape[1]):
            for t in np.unique(x[rows, j])[:-1]:
                left = x[rows, j] <= t
                n, s = left.sum(), y[rows][left].sum()
                m, r = len(rows) - n, y[rows].sum() - s
                if min(n, m) >= least:
                    gain = s * s / (n + penalty) + r * r / (m + penalty) - (s + r) ** 2 / (n + m + penalty)
                    if gain > found[0] + 1e-9:
                        found = (gain, (j, t))
        return found

    splits = [best(p) for p in parts]
    while len(parts) < leaves and any(s[1] for s in splits):
        i = max(range(len(parts)), key=lambda i: splits[i][0])
        j, t = splits[i][1]
        rows = parts.pop(i)
        splits.pop(i)
        parts += [rows[x[rows, j] <= t], rows[x[rows, j] > t]]
        splits += [best(p) for p in parts[-2:]]
    out = np.zeros(len(y))
    for rows in parts:
        out[rows] = y[rows].sum() / (len(rows) + penalty)
    return out


def data(n=400, p=3, seed=0, values=40):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, values, (n, p)).astype(float)
    return x, np.sin(x[:, 0] / 4) * 10 + x[:, 1] ** 1.5 + rng.normal(0, 1, n)


def predictions(model, df):
    return np.array([r.prediction for r in model.transform(df).orderBy("id").collect()])


@pytest.mark.parametrize("leaves,least,penalty,ahead", [(2, 1, 0.0, 32), (9, 5, 0.0, 32), (40, 1, 3.0, 4), (40, 2, 0.0, 1)])
def test_one_round_equals_greedy_growth(spark, monkeypatch, leaves, least, penalty, ahead):
    monkeypatch.setattr(leafwise, "AHEAD", ahead)
    x, y = data()
    df = table(spark, x, y)
    model = LeafwiseRegressor(maxIter=1, stepSize=1.0, numLeaves=leaves, minInstancesPerNode=least, lambdaL2=penalty).fit(df)
    want = y.mean() + greedy(x, y - y.mean(), leaves, least, penalty)
    assert np.allclose(predictions(model, df), want)


def test_many_uneven_leaves(spark):
    rng = np.random.default_rng(1)
    x = np.sort(rng.uniform(0, 1, 3000))[:, None]
    y = np.where(x[:, 0] > 0.5, np.floor(x[:, 0] * 500), 0.0)
    model = LeafwiseRegressor(maxIter=1, stepSize=1.0, numLeaves=127, minInstancesPerNode=1, maxBins=256).fit(table(spark, x, y))
    ((feature, threshold, left, _),) = model.fitted_trees()
    assert feature.count(-1) == 127 and feature.count(0) == 126 and min(t for f, t in zip(feature, threshold) if f == 0) > 0.45


def test_rounds_add_up_through_refreshes_and_samples(spark, tmp_path, monkeypatch):
    x, y = data()
    df = table(spark, x, y)
    options = {"maxIter": 7, "stepSize": 0.5, "numLeaves": 8, "minInstancesPerNode": 3}
    model = LeafwiseRegressor(**options).fit(df)
    f = np.full(len(y), y.mean())
    for _ in range(7):
        f = f + 0.5 * greedy(x, y - f, 8, 3)
    assert np.allclose(predictions(model, df), f)
    monkeypatch.setattr(leafwise, "REFRESH", 2)
    assert np.allclose(predictions(LeafwiseRegressor(**options).fit(df), df), f)
    model.write().overwrite().save(str(tmp_path / "m"))
    assert np.allclose(predictions(LeafwiseModel.load(str(tmp_path / "m")), df), f)
    drawn = LeafwiseRegressor(subsamplingRate=0.6, featureShare=0.5, **options)
    a, b = predictions(drawn.fit(df), df), predictions(drawn.fit(df.repartition(7)), df)
    assert np.allclose(a, b) and not np.allclose(a, f) and ((y - a) ** 2).mean() < y.var() / 2


def test_constant_labels_few_rows_and_no_rows(spark):
    df = table(spark, [[1.0], [2.0], [3.0]], [5.0, 5.0, 5.0])
    assert predictions(LeafwiseRegressor(maxIter=3, minInstancesPerNode=1).fit(df), df).tolist() == [5.0] * 3
    assert predictions(LeafwiseRegressor(maxIter=3).fit(table(spark, [[1.0]], [2.0])), df).tolist() == [2.0] * 3
    with pytest.raises(ValueError, match="label"):
        LeafwiseRegressor().fit(df.where("id > 9"))
    with pytest.raises(ValueError, match="maxBins"):
        LeafwiseRegressor(maxBins=300).fit(df)


def test_arms_take_leaves_and_penalty():
    made = models.build("lgbm", num_leaves=127, reg_lambda=1.5, colsample_bytree=0.8)
    assert (made.getOrDefault("numLeaves"), made.getOrDefault("lambdaL2"), made.getOrDefault("featureShare")) == (127, 1.5, 0.8)
    assert models.chosen("hgb").getOrDefault("numLeaves") == 127
