"""Feature steps: values by hand, refusals, unseen levels, null rules."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast import config
from holdfast.errors import DomainError, UnsafeEncoderError
from holdfast.functions import expressions as fx
from holdfast.operators import steps
from holdfast.operators.branches import ColumnSteps
from holdfast.operators.knn import KnnImputer
from holdfast.operators.stats import fit_one, keep_all
from tests.conftest import close


def run(df, columns, made, keep=()):
    return ColumnSteps(inputCols=columns, steps=made).fit(df).feature_frame(df, keep)


def test_safe_divide_has_no_null_and_no_infinity(frame):
    df = frame([(1.0, 2.0), (1.0, 0.0), (None, 2.0), (1.0, None), (float("nan"), 1.0), (1e308, 1e-308)], "a double, b double")
    assert [r[0] for r in df.select(fx.safe_divide(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 0.0, 0.0, 0.0, 0.0]


def test_ratios_of_zero_denominators(frame):
    df = frame([(100.0, 20.0, 300.0, 50.0), (0.0, 5.0, 100.0, 25.0), (50.0, 10.0, 150.0, 0.0)],
               "total_rooms double, total_bedrooms double, population double, households double")
    got = [tuple(r) for r in run(df, config.HEAVY_TAILED_COLUMNS, [steps.Ratios(keep_original=False)]).collect()]
    assert got == [(2.0, 0.2, 6.0), (0.0, 0.0, 4.0), (0.0, 0.2, 0.0)]


def test_ratios_name_what_they_lack(house):
    with pytest.raises(ValueError, match="households"):
        run(house, ["total_rooms", "total_bedrooms", "population"], [steps.Ratios()])


def test_clip_keeps_nulls(frame):
    df = frame([(None,), (-5.0,), (0.5,), (9.0,)], "x double")
    assert [r[0] for r in df.select(fx.clip(F.col("x"), 0.0, 1.0)).collect()] == [None, 0.0, 0.5, 1.0]


def test_clip_at_zero_and_one_is_off(house):
    got = run(house, ["population"], [steps.Clip(lower=0.0, upper=1.0)])
    assert got.exceptAll(house.select("population")).count() == 0


@pytest.mark.parametrize("low, high", [(0.5, 0.5), (-0.1, 0.9), (0.1, 1.1), (0.9, 0.1)])
def test_clip_bounds_are_checked(low, high):
    with pytest.raises(ValueError, match="lower < upper"):
        steps.Clip(lower=low, upper=high)


@pytest.mark.parametrize("make", [
    lambda: steps.Impute(kind="zero"), lambda: steps.Deskew(kind="sqrt"), lambda: steps.Scale(kind="max"),
    lambda: steps.Bins(strategy="equal"), lambda: steps.Bins(encoder="hash"),
])
def test_unknown_options_are_refused_with_the_valid_list(make):
    with pytest.raises(ValueError, match="expected one of"):
        make()


def test_log_refuses_its_domain_by_name_and_spares_nulls(house, frame):
    with pytest.raises(DomainError, match="longitude"):
        run(house, ["longitude", "population"], [steps.Deskew(kind="log")])
    assert run(house, ["total_bedrooms"], [steps.Deskew(kind="log")]).count() == house.count()
    model = ColumnSteps(inputCols=["x"], steps=[steps.Deskew(kind="log")]).fit(frame([(1.0,)], "x double"))
    with pytest.raises(Exception, match="column x holds"):
        model.feature_frame(frame([(-2.0,)], "x double")).collect()


def test_standard_scaler_uses_the_population_deviation(frame):
    got = [r[0] for r in run(frame([(1.0,), (3.0,)], "x double"), ["x"], [steps.Scale()]).collect()]
    assert got == [-1.0, 1.0]


@pytest.mark.parametrize("kind, want", [("standard", 0.0), ("robust", 0.0), ("minmax", 0.0), ("none", 4.0)])
def test_a_constant_column_scales_to_zero(frame, kind, want):
    assert {r[0] for r in run(frame([(4.0,), (4.0,)], "x double"), ["x"], [steps.Scale(kind=kind)]).collect()} == {want}


def test_minmax_is_not_clipped_on_new_rows(frame):
    model = ColumnSteps(inputCols=["x"], steps=[steps.Scale(kind="minmax")]).fit(frame([(0.0,), (2.0,)], "x double"))
    assert [r[0] for r in model.feature_frame(frame([(3.0,)], "x double")).collect()] == [1.5]


def test_yeo_johnson_lambda_is_the_likelihood_maximum(house):
    x = np.array([r[0] for r in house.select("population").collect()])
    found = fit_one(house, steps.Deskew(kind="yeo-johnson").fit({"p": F.col("population")}, keep_all))["lambda"]["p"]

    def score(lam):
        y = np.log1p(x) if lam == 0 else ((x + 1) ** lam - 1) / lam
        return steps.log_likelihood(len(x), y.var(), np.log1p(x).sum(), lam)

    assert score(found) >= max(score(found + d) for d in (-1e-3, 1e-3, -0.05, 0.05, 0.5))


def test_yeo_johnson_finds_a_lambda_outside_the_first_bracket(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(20, 1, 500) ** (1 / 4)], "x double")
    found = fit_one(df, steps.Deskew(kind="yeo-johnson").fit({"x": F.col("x")}, keep_all))["lambda"]["x"]
    assert found > 2


def test_mode_ties_take_the_smallest(frame):
    df = frame([("b",), ("a",), (None,)], "v string")
    assert sorted(r[0] for r in run(df, ["v"], [steps.ImputeMode()]).collect()) == ["a", "a", "b"]


LEVELS = [("a",)] * 12 + [("b",)] * 11 + [("c",)] * 3


def test_rare_and_unknown_levels_share_the_last_column(frame):
    model = ColumnSteps(inputCols=["v"], steps=[steps.OneHot(min_frequency=10)]).fit(frame(LEVELS, "v string"))
    got = model.feature_frame(frame([("a",), ("c",), ("new",)], "v string"))
    assert got.columns == ["v_a", "v_b", "v_infrequent_sklearn"]
    assert [tuple(r) for r in got.collect()] == [(1.0, 0.0, 0.0), (0.0, 0.0, 1.0), (0.0, 0.0, 1.0)]


def test_without_a_rare_level_an_unknown_is_all_zeros(frame):
    model = ColumnSteps(inputCols=["v"], steps=[steps.OneHot(min_frequency=3)]).fit(frame(LEVELS, "v string"))
    got = model.feature_frame(frame([("new",)], "v string"))
    assert got.columns == ["v_a", "v_b", "v_c"] and tuple(got.first()) == (0.0, 0.0, 0.0)


def test_min_frequency_may_be_a_share(frame):
    model = ColumnSteps(inputCols=["v"], steps=[steps.OneHot(min_frequency=0.2)]).fit(frame(LEVELS, "v string"))
    assert model.feature_names() == ["v_a", "v_b", "v_infrequent_sklearn"]


def test_drop_needs_error_mode(frame):
    with pytest.raises(UnsafeEncoderError):
        steps.OneHot(drop="first")
    made = [steps.OneHot(drop="first", handle_unknown="error", min_frequency=1)]
    model = ColumnSteps(inputCols=["v"], steps=made).fit(frame(LEVELS, "v string"))
    assert model.feature_names() == ["v_b", "v_c"]
    assert model.feature_frame(frame(LEVELS, "v string")).count() == 26
    with pytest.raises(Exception, match="unknown category in v"):
        model.feature_frame(frame([("new",)], "v string")).collect()


def test_declared_order_survives_a_missing_level(house):
    no_island = house.where("ocean_proximity <> 'ISLAND'")
    model = ColumnSteps(inputCols=["ocean_proximity"], steps=[steps.Ordinal()]).fit(no_island)
    codes = {r[0]: r[1] for r in model.feature_frame(
        house.select(F.col("ocean_proximity").alias("raw"), "ocean_proximity"), ["raw"]).distinct().collect()}
    assert codes == {"ISLAND": 0.0, "NEAR BAY": 1.0, "NEAR OCEAN": 2.0, "<1H OCEAN": 3.0, "INLAND": 4.0}
    learned = ColumnSteps(inputCols=["ocean_proximity"], steps=[steps.Ordinal(declared=False)]).fit(no_island)
    assert learned.feature_frame(house.where("ocean_proximity = 'ISLAND'")).first()[0] == -1.0


def test_bins_are_left_closed_and_clamp(frame):
    code = steps.Bins(n_bins=3, encoder="ordinal").apply({"edges": {"x": [0.0, 1.0, 2.0, 3.0]}}, {"x": F.col("x")})
    df = frame([(-9.0,), (0.0,), (1.0,), (1.5,), (2.0,), (3.0,), (99.0,)], "x double")
    assert [r[0] for r in df.select(code["x"]).collect()] == [0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 2.0]


def test_equal_edges_are_merged(frame):
    df = frame([(1.0,)] * 8 + [(2.0,)] * 2, "x double")
    state = fit_one(df, steps.Bins(n_bins=5).fit({"x": F.col("x")}, keep_all))
    assert state["edges"]["x"] == [1.0, 1.5, 2.0]


@pytest.mark.parametrize("strategy", ["quantile", "uniform", "kmeans"])
def test_onehot_bins_sum_to_one(house, strategy):
    got = run(house, ["median_income"], [steps.Bins(strategy=strategy)])
    total = sum(F.col(f"`{c}`") for c in got.columns)
    assert [r[0] for r in got.select(total.alias("t")).distinct().collect()] == [1.0]


def test_line_kmeans_edges_are_midpoints_of_means(frame):
    df = frame([(v,) for v in (0.0, 1.0, 10.0, 11.0)], "x double")
    state = fit_one(df, steps.Bins(n_bins=2, strategy="kmeans").fit({"x": F.col("x")}, keep_all))
    assert state["edges"]["x"] == [0.0, 5.5, 11.0]


def lloyd(values, k, rounds=300):
    """The rounds over all rows."""
    edges = np.linspace(min(values), max(values), k + 1)
    x, now = np.sort(np.array(values)), (edges[:-1] + edges[1:]) / 2
    for _ in range(rounds):
        at = np.searchsorted((now[:-1] + now[1:]) / 2, x, "right")
        moved = np.sort([x[at == i].mean() if (at == i).any() else now[i] for i in range(k)])
        if np.abs(moved - now).max() < 1e-12 * np.abs(x).max():
            break
        now = moved
    return [edges[0], *((now[:-1] + now[1:]) / 2), edges[-1]]


@pytest.mark.parametrize("shape", ["even", "hot", "outlier", "heavy"])
def test_line_kmeans_on_few_cells_is_that_of_the_rows(frame, monkeypatch, shape):
    from holdfast.operators import line

    rng = np.random.default_rng(5)
    values = {
        "even": rng.normal(0, 1, 3000), "hot": np.where(rng.random(3000) < 0.4, 0.25, rng.random(3000)),
        "outlier": np.append(rng.random(2000), 1e9), "heavy": np.exp(rng.normal(0, 3, 3000)),
    }[shape].tolist()
    monkeypatch.setattr(line, "ROOT_CELLS", 16)
    monkeypatch.setattr(line, "FINE_CELLS", 8)
    asked = []
    counted = line._counted
    monkeypatch.setattr(line, "_counted", lambda *given: asked.append(1) or counted(*given))
    df = frame([(v,) for v in [*values, None]], "x double")
    state = fit_one(df, steps.Bins(n_bins=5, strategy="kmeans").fit({"x": F.col("x")}, keep_all))
    want = steps._distinct_edges(lloyd(values, 5))
    assert np.allclose(state["edges"]["x"], want, rtol=1e-9) and len(asked) < 40


# --- clusters -------------------------------------------------------------------------


def centers(df, **options):
    return fit_one(df, steps.Geo(**options).fit({c: F.col(c) for c in config.GEO_COLUMNS}, keep_all))["centers"]


def test_similarity_is_one_at_its_centre_and_between_zero_and_one(house, frame):
    found = centers(house, n_clusters=4)
    step = steps.Geo(n_clusters=4)
    at = frame([tuple(c) for c in found], "latitude double, longitude double")
    got = at.select(*step.apply({"centers": found}, {c: F.col(c) for c in at.columns}).values()).collect()
    assert all(close(got[i][i], 1.0) for i in range(4))
    wide = steps.Geo(n_clusters=4, gamma=0.1).apply({"centers": found}, {c: F.col(c) for c in at.columns})
    flatter = at.select(*wide.values()).collect()
    assert all(0 <= got[i][j] <= flatter[i][j] <= 1 for i in range(4) for j in range(4))


def test_centres_do_not_depend_on_partitioning(house):
    a, b = centers(house.repartition(1)), centers(house.repartition(16))
    assert np.allclose(a, b, atol=1e-9)


def test_lloyd_ends_where_it_would_stay(house):
    found = centers(house, n_clusters=5, tol=0.0)
    x = np.array([tuple(r) for r in house.select("latitude", "longitude", "population").collect()])
    near = ((x[:, None, :2] - np.array(found)[None]) ** 2).sum(-1).argmin(1)
    again = [np.average(x[near == i, :2], axis=0, weights=x[near == i, 2]) for i in range(5)]
    assert np.allclose(found, again, atol=1e-6)


def test_weight_is_optional_and_null_coordinates_are_refused(house):
    assert len(fit_one(house, steps.Geo(n_clusters=3).fit({c: F.col(c) for c in ("latitude", "longitude")}, keep_all))["centers"]) == 3
    with pytest.raises(ValueError, match="null"):
        centers(house.withColumn("latitude", F.when(F.col("id") != 3, F.col("latitude"))))


# --- neighbours and chained regressions -------------------------------------------------


def brute_knn(rows, names, k=5):
    """Nearest-neighbour imputation by comparing everything with everything."""
    x = np.array([[np.nan if v is None else v for v in r[1:]] for r in rows], dtype=float)
    out = x.copy()
    for i, j in zip(*np.where(np.isnan(x))):
        both = ~np.isnan(x[i]) & ~np.isnan(x)
        gap = np.where(both, x - x[i], 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            d = np.sqrt((gap**2).sum(1) * x.shape[1] / both.sum(1))
        usable = [(d[m], str(rows[m][0]), x[m, j]) for m in range(len(x)) if not np.isnan(x[m, j]) and both[m].any()]
        best = sorted(usable)[:k]
        if not best:
            out[i, j] = np.nanmean(x[:, j])
        elif best[0][0] == 0:
            out[i, j] = np.mean([v for dist, _, v in best if dist == 0])
        else:
            out[i, j] = sum(v / dist for dist, _, v in best) / sum(1 / dist for dist, _, v in best)
    return out


@pytest.mark.parametrize("leaf_rows", [1024, 8])
def test_knn_equals_brute_force(spark, leaf_rows, monkeypatch):
    """Several null patterns, exact copies (a third of the rows at one point), many small leaves."""
    from holdfast.operators import knn

    monkeypatch.setattr(knn, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(knn, "SAMPLE_PER_LEAF", 4)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(240):
        point = [5.0, 5.0, 5.0] if i % 3 == 0 else [float(v) for v in rng.lognormal(2, 1, 3).round(2)]
        for j in range(2):
            if rng.random() < 0.12:
                point[j] = None
        rows.append((i, *point))
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    got = KnnImputer(inputCols=["a", "b", "c"], keyCols=["id"]).fit(df).transform(df).orderBy("id").select("a", "b", "c")
    assert np.allclose(got.toPandas().to_numpy(), brute_knn(rows, "abc"), rtol=1e-9)


def test_knn_depends_on_scale(house):
    def filled(df):
        model = KnnImputer(inputCols=config.HEAVY_TAILED_COLUMNS, keyCols=["id"]).fit(df)
        rows = model.transform(df).where("id % 97 = 3").orderBy("id").select("total_bedrooms").collect()
        return [r[0] for r in rows]

    assert filled(house) != filled(house.withColumn("population", F.col("population") * 1e6))


def evidence_ridge(x, y):
    """Bayesian ridge on the rows themselves, by singular values: the textbook recipe."""
    mx, my, n = x.mean(0), y.mean(), len(y)
    x, y = x - mx, y - my
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    alpha, lam, before = 1 / y.var(), 1.0, None
    for _ in range(300):
        coef = vt.T @ (s / (s**2 + lam / alpha) * (u.T @ y))
        effective = (alpha * s**2 / (lam + alpha * s**2)).sum()
        lam = (effective + 2e-6) / (coef @ coef + 2e-6)
        alpha = (n - effective + 2e-6) / (((y - x @ coef) ** 2).sum() + 2e-6)
        if before is not None and np.abs(before - coef).sum() < 1e-3:
            break
        before = coef
    coef = vt.T @ (s / (s**2 + lam / alpha) * (u.T @ y))
    return coef, my - mx @ coef


def test_iterative_equals_regression_on_the_rows(house):
    """One incomplete column: the chain reaches its fixed point in the first round."""
    rows = np.array([[np.nan if v is None else v for v in r] for r in house.select(*config.HEAVY_TAILED_COLUMNS).collect()])
    known = ~np.isnan(rows[:, 1])
    coef, intercept = evidence_ridge(rows[known][:, [0, 2, 3]], rows[known, 1])
    want = rows[~known][:, [0, 2, 3]] @ coef + intercept
    got = run(house, config.HEAVY_TAILED_COLUMNS, [steps.Impute(kind="iterative")], ["id"])
    filled = np.array([r[0] for r in got.where("id % 97 = 3").select("total_bedrooms").collect()])
    assert np.allclose(np.sort(filled), np.sort(want), rtol=1e-6)


def test_all_null_training_column_is_refused(frame):
    df = frame([(None, 1.0), (None, 2.0)], "a double, b double")
    for kind in ("median", "mean", "iterative"):
        with pytest.raises(ValueError, match="'a'"):
            run(df, ["a", "b"], [steps.Impute(kind=kind)])


def test_names_are_cleaned_and_collisions_refused(frame):
    df = frame([(1, 2)], "`a  <b` int, `x.y[0]` int")
    assert fx.sanitise_names(df).columns == ["a ltb", "x_y(0)"]
    with pytest.raises(ValueError, match="a_b"):
        fx.safe_names(["a.b", "a_b"])


def test_bands_are_right_closed(frame):
    df = frame([(0.0,), (1.5,), (1.51,), (6.0,), (6.1,), (None,)], "x double")
    assert [r[0] for r in df.select(fx.income_band(F.col("x"))).collect()] == [None, 1, 2, 4, 5, None]


def test_log_and_its_inverse(frame):
    step = steps.Deskew(kind="log")
    x = step.invert(step.apply({}, {"x": F.col("x")}))["x"]
    assert math.isclose(frame([(41.5,)], "x double").select(x).first()[0], 41.5)


@pytest.mark.parametrize("strategy", ["quantile", "uniform", "kmeans"])
def test_a_constant_column_is_one_bin(frame, strategy):
    df = frame([(3.0,), (3.0,), (3.0,)], "x double")
    state = fit_one(df, steps.Bins(n_bins=5, strategy=strategy).fit({"x": F.col("x")}, keep_all))
    made = steps.Bins(n_bins=5, strategy=strategy).apply(state, {"x": F.col("x")})
    assert list(made) == ["x_0.0"] and [r[0] for r in df.select(*made.values()).collect()] == [1.0] * 3


def test_any_number_of_rare_levels_is_one_column(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 100, "often").otherwise(F.col("id").cast("string")).alias("x"))
    one = steps.OneHot(min_frequency=10)
    state = fit_one(df, one.fit({"x": F.col("x")}, keep_all))
    made = one.apply(state, {"x": F.col("x")})
    assert list(made) == ["x_often", "x_infrequent_sklearn"]
    assert df.agg(*[F.sum(c) for c in made.values()]).first()[:] == (100.0, 29_900.0)


def test_branches_over_other_columns(frame):
    from holdfast.operators.branches import FeatureBranches

    df = frame([(1, 2.0, "a"), (2, None, "b"), (3, 8.0, "a")], "id int, v double, s string")
    model = FeatureBranches(geoCols=[], ratioSpecs=[], heavyCols=["v"], plainCols=[], categoryCols=["s"], binnedCols=[], deskew="none", encoder="ordinal").fit(df)
    assert model.feature_names() == ["heavy__v", "categorical__s"]
    assert [r["categorical__s"] for r in model.feature_frame(df, ["id"]).orderBy("id").collect()] == [0.0, 1.0, 0.0]
