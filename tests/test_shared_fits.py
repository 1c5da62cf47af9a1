"""Fits that share passes: arms of a comparison, sides of a table, centres near a row."""

import numpy as np
import pytest

from holdfast.operators import clusters, stats
from holdfast.operators.branches import FeatureBranches
from holdfast.operators.split import with_fold
from holdfast.plans import cv

SMALL = {"nClusters": 3, "geoRounds": 3}


@pytest.fixture
def fits(monkeypatch):
    """Counts the fits that go through the engine, one entry a call."""
    made = []
    monkeypatch.setattr("holdfast.operators.branches.fit_together", lambda df, some: made.append(len(some)) or stats.fit_together(df, some))
    return made


def test_nearest_centre_is_that_of_all_gaps_to_the_bit():
    rng = np.random.default_rng(3)
    for d, k in ((1, 4), (2, 1), (2, 60), (3, 7)):
        x = np.round(rng.uniform(-9, 9, (500, d)), 1)
        centers = np.round(rng.uniform(-9, 9, (k, d)), 1)
        gaps = clusters.squared_gaps(x, centers)
        least, home = clusters.nearest(x, centers)
        assert (least == gaps.min(1)).all() and (home == gaps.argmin(1)).all()
        assert (clusters.nearest(x, centers, which=False)[0] == least).all()
    assert len(clusters.nearest(np.empty((0, 2)), centers[:, :2])[0]) == 0


def test_arms_of_a_comparison_share_their_preprocessing(house, fits):
    found = cv.cross_validate_together({m: m for m in ("dummy", "ridge")}, house, ["id"], n_splits=2, preprocess=SMALL)
    assert len(fits) == 1
    alone = cv.cross_validate("ridge", house, ["id"], n_splits=2, preprocess=SMALL)
    assert alone["rmse"] == pytest.approx(found["ridge"]["rmse"], rel=1e-9) and found["dummy"]["rmse"] > alone["rmse"]


def test_sides_fitted_together_equal_single_fits(house, fits):
    folded = with_fold(house, ["id"], 2).persist()
    branches = FeatureBranches(**SMALL)
    outside, whole = FeatureBranches.fit_sides_together([(branches, [1, None])], folded, "fold")[0]
    assert len(fits) == 1
    for made, alone in ((outside, branches.fit(folded.where("fold != 1"))), (whole, branches.fit(folded))):
        for a, b in zip(*[m.feature_frame(folded, ["id"]).orderBy("id").limit(50).collect() for m in (made, alone)]):
            assert list(a) == pytest.approx(list(b), rel=1e-9, abs=1e-12)
    folded.unpersist()
