"""Fits of long curves, by stretches in many tasks, against the fits of whole curves."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_features import NAMES, QUICK, noise, sinusoid, table

from skyfold.features import fits, kernels, long_curves, period, statistics, walk
from skyfold.features.registry import compute_features
from skyfold.functions.curves import with_curve


def test_stretches_joined_in_any_way_give_the_whole():
    t, m, e = noise(90, 4, span=60)
    t[40] = t[39]
    a, c = np.array([[0.3, 0.05, 2.0]]), np.array([[0.2, 3.0, 1e-6]])
    gaps, y, variance = np.diff(t, prepend=t[0]), m - m.mean(), e**2
    whole = walk.stretches(*(x[None] for x in (gaps, y, variance, np.ones(90))), a, c, alone=True)[-1]
    for cuts in ([45], [1, 2, 40, 89], [39, 40, 41]):
        parts = [walk.stretches(*(x[None, i:j] for x in (gaps, y, variance, np.ones(90))), a, c) for i, j in zip([0, *cuts], [*cuts, 90], strict=True)]
        stacked = [np.stack([p[k] for p in parts], axis=1) for k in range(6)]
        np.testing.assert_allclose(walk.joined(stacked, a), whole, rtol=1e-10)


@pytest.fixture()
def short_stretches(monkeypatch):
    monkeypatch.setattr(long_curves, "LONG", 16)


def both(spark, step, names, *rows):
    curves = table(spark, *rows)
    whole = step(with_curve(curves)).select("objectid", *names).orderBy("objectid").toPandas()
    cut = step(long_curves.keyed(curves)).select("objectid", *names).orderBy("objectid").toPandas()
    pd.testing.assert_frame_equal(whole, cut, check_dtype=False, rtol=2e-5, atol=1e-9)


def test_fits_do_not_depend_on_stretches(spark, short_stretches):
    # Among them a curve twice, one of a single epoch, one that never changes and one without usable errors.
    flat = noise(30, 8)
    rows = [noise(70, 5), sinusoid(45, 0.9), noise(70, 5), noise(17, 6), noise(1, 7), (flat[0], flat[1] * 0 + 17, flat[2]), (*noise(20, 9)[:2], np.zeros(20))]
    both(spark, lambda df: fits.with_random_walk(df, rounds=3), ["_walk_score", *fits.RANDOM_WALK], *rows)
    both(spark, lambda df: statistics.with_autoregression(df, rounds=2), ["_iar_score", "IAR_phi"], *rows)
    both(spark, lambda df: period.with_period(df, QUICK), ["_best_freq", "_best_power", "Multiband_period", "PPE"], *rows)


def test_the_feature_table_holds_short_and_long_curves(spark, short_stretches):
    rows = table(spark, noise(12, 1), sinusoid(40, 0.9), noise(16, 2))
    found = compute_features(rows).orderBy("objectid").toPandas()
    assert list(found["objectid"]) == [0, 1, 2] and list(found.columns[-67:]) == NAMES
    long_curves.LONG = 4096
    whole = compute_features(rows).orderBy("objectid").toPandas()
    pd.testing.assert_frame_equal(found, whole, check_dtype=False, rtol=1e-4, atol=1e-8)


def test_one_long_curve_is_work_for_several_tasks(spark):
    t, m, e = noise(20_000, 3, span=2500.0)
    keyed = long_curves.keyed(table(spark, (t, m, e)))
    stretches = long_curves.stretched(keyed, _y="_m")
    assert stretches.count() == 5 and stretches.select(F.max(F.size("_y"))).first()[0] <= long_curves.LONG
    # Dealt out over several files, which are tasks of their own when they are read.
    assert len(stretches.inputFiles()) > 1
    found = period.with_period(keyed, period.FrequencyGrid(0.5, 2.0, 1e-3))
    assert found.select("_best_power").first()[0] == pytest.approx(kernels.best_period(t, m, e, 0.5, 1e-3, 1500, 100, 10, 1e-4)[1], rel=1e-6)
