import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyfold.features import fits, harmonics, kernels, period, statistics, two_scale, walk
from skyfold.features.registry import FeatureFamily, compute_features, default_families, feature_names
from skyfold.functions import curves, special
from skyfold.operators.preprocess import Preprocessor

# The 67 features in table order.
NAMES = (
    "gal_b gal_l MHPS_ratio MHPS_low MHPS_high MHPS_non_zero MHPS_PN_flag SPM_A SPM_t0 SPM_gamma SPM_beta "
    "SPM_tau_rise SPM_tau_fall SPM_chi SPM_C Amplitude AndersonDarling Autocor_length Beyond1Std Con Eta_e Gskew "
    "MaxSlope Mean Meanvariance MedianAbsDev MedianBRP PairSlopeTrend PercentAmplitude Q31 Rcs Skew SmallKurtosis "
    "Std StetsonK Pvar ExcessVar SF_ML_amplitude SF_ML_gamma IAR_phi LinearTrend GP_DRW_sigma GP_DRW_tau "
    "Multiband_period PPE Power_rate_1/4 Power_rate_1/3 Power_rate_1/2 Power_rate_2 Power_rate_3 Power_rate_4 "
    "Psi_CS Psi_eta Harmonics_mag_1 Harmonics_mag_2 Harmonics_mag_3 Harmonics_mag_4 Harmonics_mag_5 "
    "Harmonics_mag_6 Harmonics_mag_7 Harmonics_phase_2 Harmonics_phase_3 Harmonics_phase_4 Harmonics_phase_5 "
    "Harmonics_phase_6 Harmonics_phase_7 Harmonics_mse"
).split()

QUICK = period.FrequencyGrid(0.01, 3.0, 0.01)


def table(spark, *rows):
    """Curves from (t, m, e) triples."""
    data = [
        (i, 1, 10.0, 20.0, len(t), [float(x) for x in t], [float(x) for x in m], [float(x) for x in e])
        for i, (t, m, e) in enumerate(rows)
    ]
    schema = (
        "objectid long, filterid int, objra double, objdec double, nepochs long, hmjd array<double>, "
        "mag array<double>, magerr array<double>"
    )
    return spark.createDataFrame(data, schema)


def noise(n, seed=0, span=900.0):
    rng = np.random.default_rng(seed)
    t = 58000 + np.sort(rng.uniform(0, span, n))
    return t, 17 + rng.normal(0, 0.3, n), rng.uniform(0.02, 0.08, n)


def sinusoid(n, true_period, seed=0, size=0.4):
    t, _, e = noise(n, seed)
    rng = np.random.default_rng(seed + 1)
    return t, 17 + size * np.sin(2 * np.pi * t / true_period + 1.0) + rng.normal(0, 0.01, n), e * 0 + 0.01


# ------------------------------------------------------------------- the table


def test_names_and_order():
    assert feature_names() == NAMES and len(NAMES) == 67


@pytest.fixture(scope="module")
def features(spark):
    rows = [noise(30), sinusoid(60, 0.7), noise(4), noise(1), (np.array([1.0, 1.0]), np.array([2.0, 2.0]), np.ones(2))]
    return compute_features(table(spark, *rows)).orderBy("objectid").toPandas()


def test_one_row_per_curve_with_all_columns(features):
    assert list(features.columns) == ["objectid", "filterid", "objra", "objdec", "nepochs", *NAMES]
    assert len(features) == 5


def test_long_curves_have_every_feature(features):
    assert features.loc[:1, NAMES].notna().all().all()


def test_missing_values_are_null_not_nan(spark):
    found = compute_features(table(spark, noise(1))).first().asDict()
    assert not any(isinstance(v, float) and math.isnan(v) for v in found.values())
    assert found["Std"] is None and found["Multiband_period"] is None and found["Psi_CS"] is None
    assert found["Mean"] is not None and found["gal_b"] is not None


def test_curves_with_missing_or_no_values(spark):
    t, m, e = noise(30)
    holed = m.copy()
    holed[5] = np.nan
    rows = table(spark, (t, holed, e), ([], [], []), (t, m * 0 + 17.0, e))
    no_error = rows.filter("objectid = 2").withColumns(
        {"magerr": F.transform("magerr", lambda x, i: F.when(i > 0, x)), "objectid": F.lit(3)}
    )
    found = {r.objectid: r.asDict() for r in compute_features(rows.unionByName(no_error)).collect()}
    for row in found.values():
        assert not any(isinstance(v, float) and math.isnan(v) for v in row.values())
        assert row["Multiband_period"] is None and row["PPE"] is None and row["Power_rate_2"] is None
        assert row["Psi_CS"] is None and row["Harmonics_mse"] is None and row["gal_b"] is not None
    assert found[0]["Mean"] is None and found[0]["Std"] is None and found[1]["Mean"] is None
    assert found[2]["Std"] == 0.0 and found[2]["Amplitude"] == 0.0 and found[2]["Skew"] is None


def test_the_job_has_no_shuffle(spark):
    plan = compute_features(Preprocessor().run(_with_flags(table(spark, noise(30)))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    # Independent fits share one pass through Python, those that need the period a second one.
    assert text.count("ArrowEvalPython [") == 2


def _with_flags(df):
    return df.withColumns(
        {
            "clrcoeff": F.transform("mag", lambda _: F.lit(0.0)),
            "catflags": F.transform("mag", lambda _: F.lit(0)),
        }
    )


def test_features_do_not_depend_on_epoch_order_or_partitions(spark):
    t, m, e = sinusoid(40, 0.9)
    order = np.random.default_rng(3).permutation(40)
    rows = table(spark, (t, m, e), (t[order], m[order], e[order]))
    first = None
    for parts in (1, 4, 16):
        found = compute_features(rows.repartition(parts)).orderBy("objectid").toPandas()[NAMES]
        pd.testing.assert_series_equal(found.loc[0], found.loc[1], check_names=False, rtol=1e-9)
        first = found if first is None else first
        pd.testing.assert_frame_equal(found, first)


def test_period_features_need_the_period_first(spark):
    for family in (period.folded_family(), period.harmonics_family(), period.power_rate_family()):
        with pytest.raises(ValueError, match="run period first"):
            compute_features(table(spark, noise(10)), [family])


def test_required_columns_are_checked(spark):
    with pytest.raises(ValueError, match="magerr"):
        compute_features(table(spark, noise(10)).drop("magerr"))


def test_a_family_of_ones_own(spark):
    @F.pandas_udf("double")
    def largest(mags: pd.Series) -> pd.Series:
        return mags.map(np.max)

    own = FeatureFamily("largest", ("mag",), ("Largest",), lambda df: df.withColumn("Largest", largest("mag")))
    found = compute_features(table(spark, noise(10)), [default_families()[0], own])
    assert found.columns == ["objectid", "filterid", "objra", "objdec", "nepochs", "gal_b", "gal_l", "Largest"]
    assert found.first().Largest == pytest.approx(noise(10)[1].max())


# ------------------------------------------------------------------- statistics


def by_hand(t, m, e):
    """Straightforward numpy versions of the statistics."""
    n, mean, std = len(m), m.mean(), m.std(ddof=1)
    d, z = m - mean, np.sort((m - mean) / std)
    ordered, med = np.sort(m), np.median(m)
    k = math.ceil(0.05 * n)
    w = 1 / e**2
    wm = (w * m).sum() / w.sum()
    delta = math.sqrt(n / (n - 1)) * (m - wm) / e
    dm, dt = np.diff(m), np.diff(t)
    ok = dt != 0
    side = np.where(d > 2 * std, 1, np.where(d < -2 * std, -1, 0))
    runs = [(side[i] != 0) and side[i] == side[i + 1] == side[i + 2] for i in range(n - 2)]
    s = np.cumsum(d) / (n * std)
    acf = np.array([(d[: n - q] * d[q:]).sum() for q in range(n)]) / (d * d).sum()
    cdf = np.array([0.5 * math.erfc(-x / math.sqrt(2)) for x in z])
    sf = np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z])
    i = np.arange(1, n + 1)
    a2 = -n - ((2 * i - 1) / n * (np.log(cdf) + np.log(sf[::-1]))).sum()
    last = np.diff(m[-30:])
    lo, hi = np.percentile(m, [3, 97])
    return {
        "Amplitude": (np.median(ordered[-k:]) - np.median(ordered[:k])) / 2,
        "AndersonDarling": 1 / (1 + math.exp(-10 * (a2 - 0.3))),
        "Autocor_length": float(np.flatnonzero(acf < math.exp(-1))[0]),
        "Beyond1Std": (np.abs(m - wm) > math.sqrt(((m - wm) ** 2).sum() / (n - 1))).mean(),
        "Con": sum(runs) / (n - 2),
        "Eta_e": ((dm[ok] / dt[ok]) ** 2).mean() * (t[-1] - t[0]) ** 2 / (d @ d * n),
        "Gskew": np.median(m[m <= lo]) + np.median(m[m >= hi]) - 2 * med,
        "MaxSlope": np.abs(dm[ok] / dt[ok]).max(),
        "Mean": mean,
        "Meanvariance": std / mean,
        "MedianAbsDev": np.median(np.abs(m - med)),
        "MedianBRP": (np.abs(m - med) < np.ptp(m) / 10).mean(),
        "PairSlopeTrend": ((last > 0).sum() - (last <= 0).sum()) / 30,
        "PercentAmplitude": np.abs(m - med).max() / med,
        "Q31": np.percentile(m, 75) - np.percentile(m, 25),
        "Rcs": s.max() - s.min(),
        "Skew": (d**3).mean() / (d**2).mean() ** 1.5,
        "SmallKurtosis": n * (n + 1) / ((n - 1) * (n - 2) * (n - 3)) * ((d / std) ** 4).sum()
        - 3 * (n - 1) ** 2 / ((n - 2) * (n - 3)),
        "Std": std,
        "StetsonK": np.abs(delta).sum() / math.sqrt(n * (delta**2).sum()),
        "ExcessVar": ((d**2).mean() - (e**2).mean()) / mean**2,
        "LinearTrend": np.polyfit(t - t.mean(), m, 1)[0],
    }


@pytest.mark.parametrize("n,seed", [(5, 1), (31, 2), (200, 3)])
def test_statistics_equal_plain_numpy(spark, n, seed):
    t, m, e = noise(n, seed)
    t[n // 2] = t[n // 2 - 1]
    m = np.round(m, 2)
    order = np.argsort(t, kind="stable")
    t, m, e = t[order], m[order], e[order]
    found = statistics.with_statistics(table(spark, (t, m, e))).first().asDict()
    for name, value in by_hand(t, m, e).items():
        assert found[name] == pytest.approx(value, rel=1e-9, abs=1e-12), name
    assert set(statistics.STATISTICS) <= set(found)


def test_con_counts_runs_of_three_on_one_side(spark):
    m = np.array([15.0] * 40 + [20.0] * 3 + [15.0] * 40)
    t = np.arange(83.0)
    assert statistics.with_ordered(table(spark, (t, m, t * 0 + 1))).first().Con == pytest.approx(1 / 81)


def test_zero_errors_give_null_weights(spark):
    found = statistics.with_weighted(table(spark, ([1.0, 2.0, 3.0], [1.0, 2.0, 4.0], [0.1, 0.0, 0.1]))).first()
    assert found.Beyond1Std is None and found.StetsonK is None


def test_chi_square_cdf(spark):
    # The distribution at known points.
    cases = [(1.0, 1.0, 0.6826894921370859), (2.0, 2.0, 0.6321205588285577), (10.0, 4.0, 0.9595723180054871)]
    # For even degrees the tail is a Poisson sum.
    for x, k in [(5.0, 10), (50.0, 40), (40.0, 50), (2000.0, 2000), (2100.0, 2000), (0.5, 2000)]:
        logs = [i * math.log(x / 2) - x / 2 - math.lgamma(i + 1) for i in range(k // 2)]
        cases.append((x, float(k), 1 - math.fsum(math.exp(v) for v in logs)))
    rows = spark.createDataFrame([(x, k, p) for x, k, p in cases], "x double, dof double, p double")
    for r in rows.withColumn("q", F.expr(special.chi_square_cdf("x", "dof"))).collect():
        assert r.q == pytest.approx(r.p, abs=1e-11), (r.x, r.dof)


def test_normal_tail(spark):
    points = [(float(x),) for x in np.concatenate([np.linspace(-9, 9, 181), [7.07, 7.08, 12.0, -12.0, 30.0]])]
    rows = spark.createDataFrame(points, "x double")
    for r in rows.withColumn("v", F.expr(special.log_normal_cdf("x"))).collect():
        expected = math.log(0.5 * math.erfc(-r.x / math.sqrt(2))) if r.x < 5 else math.log1p(-0.5 * math.erfc(r.x / math.sqrt(2)))
        assert r.v == pytest.approx(expected, rel=1e-7, abs=1e-300), r.x


def test_array_helpers_equal_numpy(spark):
    values = [3.0, -1.0, 2.5, 8.0, 2.5]
    row = (
        spark.createDataFrame([(values,)], "v array<double>")
        .select(
            *[F.expr(curves.percentile("sort_array(v)", q)).alias(f"p{int(q * 100)}") for q in (0.0, 0.05, 0.37, 1.0)],
            F.expr(curves.running_range("v")).alias("range"),
            curves.center("v", "p5").alias("p5shift"),
            curves.center("v", "min").alias("minshift"),
        )
        .first()
    )
    for q in (0, 5, 37, 100):
        assert row[f"p{q}"] == pytest.approx(np.percentile(values, q))
    total = np.cumsum(values)
    assert row.range == pytest.approx(total.max() - total.min())
    assert row.p5shift == pytest.approx(np.array(values) - np.percentile(values, 5))
    assert row.minshift == pytest.approx(np.array(values) + 1.0)
    with pytest.raises(ValueError):
        curves.center("v", "mode")


# -------------------------------------------------------- folded curves, period


def test_folded_curve_of_the_documented_light_curve(documented):
    found = period.with_folded(documented.withColumn("p", F.lit(1.7)), "p").first()
    assert found.Psi_CS == pytest.approx(0.16368484308138698, rel=1e-9)
    assert found.Psi_eta == pytest.approx(2.598309024419633, rel=1e-9)


def test_moments_of_the_documented_light_curve(documented):
    found = statistics.with_moments(documented).first()
    assert found.Mean == pytest.approx(16.663581008911134, rel=1e-6)
    assert found.Std == pytest.approx(0.022841125339553223, rel=1e-5)


def test_folding_ignores_whole_cycles_and_constants(spark):
    t, m, e = noise(50)
    rng = np.random.default_rng(1)
    cycles = 2 * 0.75 * rng.integers(0, 9, 50)
    rows = table(spark, (t, m, e), (t + cycles, m, e), (t, m + 3.0, e)).withColumn("p", F.lit(0.75))
    found = period.with_folded(rows, "p").orderBy("objectid").collect()
    for other in found[1:]:
        assert other.Psi_CS == pytest.approx(found[0].Psi_CS, rel=1e-6)
        assert other.Psi_eta == pytest.approx(found[0].Psi_eta, rel=1e-6)


def test_folding_needs_no_errors(spark):
    rows = table(spark, noise(20)).withColumn("p", F.lit(0.75))
    with_errors, without = period.with_folded(rows, "p").first(), period.with_folded(rows.drop("magerr"), "p").first()
    assert without.Psi_CS == with_errors.Psi_CS


@pytest.mark.parametrize("true_period", [0.31, 0.7, 12.5])
def test_a_planted_period_is_found(spark, true_period):
    found = period.with_power_rates(period.with_period(table(spark, sinusoid(120, true_period)))).first()
    assert found.Multiband_period == pytest.approx(true_period, rel=2e-3)
    assert 0.0 < found.PPE < 1.0 and found["Power_rate_1/2"] < 0.5 and found.Power_rate_3 < 0.5


@pytest.mark.parametrize("epochs,count", [(30, 700), (30, 1), (30, 19_999), (9000, 700)])
def test_grid_and_listed_frequencies_agree(epochs, count):
    curve = kernels.prepared(*noise(epochs, 5))
    grid = kernels.grid_power(*curve, 0.001, 0.001, count)
    listed = kernels.direct_sums(*curve, 0.001 + 0.001 * np.arange(count))
    np.testing.assert_allclose(grid, kernels.aov(listed, curve[1], curve[2]), rtol=1e-6, atol=1e-8)


def test_power_is_the_share_of_variance_a_sinusoid_explains():
    t, m, e = noise(40, 6)
    f, w = 0.37, 1 / e**2
    design = np.stack([np.ones(40), np.cos(2 * np.pi * f * t), np.sin(2 * np.pi * f * t)], axis=1) * np.sqrt(w)[:, None]
    target = m * np.sqrt(w)
    residual = target - design @ np.linalg.lstsq(design, target, rcond=None)[0]
    whole = (w * (m - (w @ m) / w.sum()) ** 2).sum()
    share = 1 - residual @ residual / whole
    assert kernels.power_at(t, m, e, np.array([f]))[0] == pytest.approx(37 / 2 * share / (1 - share), rel=1e-6)


def test_long_and_wide_periodograms_agree(spark):
    rows = table(spark, sinusoid(40, 0.9))
    wide = period.with_periodogram(rows, QUICK).first()
    long = period.periodogram(rows, QUICK).orderBy("freq").collect()
    assert len(wide._freq) == QUICK.count == len(long) == 299
    assert [r.power for r in long] == list(wide["_per"])
    top = period.with_periodogram(rows, QUICK).select(period.top_powers("_per", 5).alias("top")).first().top
    assert top == sorted(wide["_per"], reverse=True)[:5]


def test_periodograms_pass_in_small_lots(spark):
    rows = table(spark, *[sinusoid(30, 0.9, seed) for seed in range(130)], noise(2)).coalesce(1)
    grid = period.FrequencyGrid(0.001, 60.0, 0.001)
    found = period.with_periodogram(rows, grid).selectExpr("objectid", "size(_per) as n", "get(_per, 7) as p").collect()
    assert [r.n for r in found] == [grid.count] * 130 + [None]
    curves_ = {r.objectid: r for r in rows.collect()}
    for r in found[:130:43]:
        c = curves_[r.objectid]
        alone = kernels.power_at(*(np.array(v) for v in (c.hmjd, c.mag, c.magerr)), np.array([0.008]))
        assert r.p == pytest.approx(alone[0], rel=1e-6)


def test_entropy_of_equal_powers_is_zero(spark):
    row = spark.range(1).select(F.expr(period.peak_entropy("array_repeat(3D, 100)")).alias("ppe")).first()
    assert row.ppe == pytest.approx(0.0, abs=1e-12)


def test_harmonics_recover_a_planted_series(spark):
    t, _, e = noise(200, 4)
    sizes, angles = [0.5, 0.2, 0.1], [0.4, 1.0, 2.0]
    m = 17 + sum(a * np.cos(2 * np.pi * (k + 1) * t / 1.3 - b) for k, (a, b) in enumerate(zip(sizes, angles)))
    found = period.with_harmonics(table(spark, (t, m, e)).withColumn("p", F.lit(1.3)), "p").first()
    for k in range(3):
        assert found[f"Harmonics_mag_{k + 1}"] == pytest.approx(sizes[k], abs=1e-8)
    for k in (2, 3):
        expected = (angles[k - 1] - k * angles[0]) % (2 * np.pi)
        assert found[f"Harmonics_phase_{k}"] == pytest.approx(expected, abs=1e-6)
    assert found.Harmonics_mag_4 == pytest.approx(0.0, abs=1e-8) and found.Harmonics_mse < 1e-15


def test_harmonics_of_a_short_curve_have_the_smallest_norm():
    t, m, e = noise(9, 8)
    found = harmonics.series([(t, m, e)], [0.83], 7, 0.01)[0]
    turns = 2 * np.pi * np.outer(t / 0.83, np.arange(1, 8))
    design = np.hstack([np.ones((9, 1)), np.cos(turns), np.sin(turns)]) / (e + 0.01)[:, None]
    solution = np.linalg.pinv(design) @ (m / (e + 0.01))
    assert found[:7] == pytest.approx(np.hypot(solution[1:8], solution[8:]), rel=1e-6)
    assert found[-1] < 1e-12


def test_harmonics_equal_least_squares_on_the_epochs():
    # Short, exactly determined, ill-conditioned and long curves together.
    curves_ = [noise(n, n) for n in (3, 9, 15, 16, 17, 20, 40, 300)]
    periods = [0.83, 1.7, 0.31, 0.9, 2.2, 0.61, 0.97, 365.0]
    found = harmonics.series(curves_, periods, 7, 0.01)
    for (t, m, e), p, row in zip(curves_, periods, found):
        turns = 2 * np.pi * np.outer(t / p, np.arange(1, 8))
        design = np.hstack([np.ones((t.size, 1)), np.cos(turns), np.sin(turns)])
        solution = np.linalg.lstsq(design / (e + 0.01)[:, None], m / (e + 0.01), rcond=1e-12)[0]
        np.testing.assert_allclose(row[:7], np.hypot(solution[1:8], solution[8:]), rtol=1e-5, atol=1e-9)
        np.testing.assert_allclose(row[-1], np.mean((design @ solution - m) ** 2), rtol=1e-6, atol=1e-15)
    nothing = harmonics.series([noise(5), (np.empty(0),) * 3, noise(5)], [None, 1.0, 0.0], 7, 0.01)
    assert np.isnan(nothing).all()


# ------------------------------------------------------------------- other fits


def likelihoods(t, m, e, amplitude, rate):
    # A longer second curve, so that the first one is padded.
    return walk.likelihood(walk.padded([(t, m, e), noise(len(t) + 9, 20)]), np.tile(amplitude, (2, 1)), np.tile(rate, (2, 1)))[0]


def test_walk_likelihood_equals_a_dense_gaussian():
    t, m, e = noise(18, 9, span=30)
    t[7] = t[6]
    y = m - m.mean()
    a, c = np.array([0.3, 0.05]), np.array([0.2, 3.0])
    found = likelihoods(t, m, e, a, c)
    for i in range(2):
        cov = a[i] * np.exp(-c[i] * np.abs(t[:, None] - t[None, :])) + np.diag(e**2)
        dense = -0.5 * (y @ np.linalg.solve(cov, y) + np.linalg.slogdet(cov)[1] + 18 * math.log(2 * math.pi))
        assert found[i] == pytest.approx(dense, abs=1e-9)


def test_curves_fitted_together_are_fitted_alone():
    together = [noise(n, n) for n in (2, 90, 1, 17, 17, 40)]
    for fit, args in (
        (walk.walk_fits, (fits.LOG_AMPLITUDE, fits.LOG_RATE, 1)),
        (walk.autoregression_fits, ((0.01, 0.99, 50), 1)),
    ):
        rows = fit(together, *args)
        assert np.isnan(rows[2]).all()
        for i, curve in enumerate(together):
            np.testing.assert_allclose(rows[i], fit([curve], *args)[0], rtol=1e-9)


def test_random_walk_beats_its_neighbours():
    t, m, e = noise(40, 10)
    sigma, tau, score = walk.walk_fits([(t, m, e)], fits.LOG_AMPLITUDE, fits.LOG_RATE, None)[0]
    around = [(sigma * f, tau * g) for f in (0.9, 1.0, 1.1) for g in (0.8, 1.0, 1.25)]
    scores = likelihoods(t, m, e, np.array([a for a, _ in around]), np.array([1 / b for _, b in around]))
    assert score >= scores.max() - 1e-3


def test_autoregression_finds_a_planted_correlation():
    rng = np.random.default_rng(11)
    t = np.cumsum(rng.uniform(0.2, 1.0, 3000))
    x = np.zeros(3000)
    for i in range(1, 3000):
        phi = 0.8 ** (t[i] - t[i - 1])
        x[i] = phi * x[i - 1] + rng.normal(0, math.sqrt(1 - phi * phi))
    found, _ = walk.autoregression_fits([(t, x, np.full(3000, 0.01))], (0.01, 0.99, 50), 2)[0]
    assert found == pytest.approx(0.8, abs=0.05)


def test_structure_function_equals_its_pairs():
    t, m, e = noise(70, 12)
    found = kernels.structure_function(t, m, e, statistics.LAG_BINS, 6)
    edges = 10.0 ** (np.arange(-80, 60) / 10)
    i, j = np.triu_indices(70, 1)
    lag, square = t[j] - t[i], (m[i] - m[j]) ** 2 - e[i] ** 2 - e[j] ** 2
    x, z = [], []
    for lo, hi in zip(edges, edges[1:]):
        inside = (lag >= lo) & (lag < hi)
        if inside.sum() >= 6 and square[inside].mean() > 0:
            x.append(0.5 * math.log10(lo * hi) - math.log10(365.25))
            z.append(0.5 * math.log10(square[inside].mean()))
    slope, level = np.polyfit(x, z, 1)
    assert found == pytest.approx((10**level, slope), rel=1e-8)


def test_structure_function_of_a_random_walk_has_slope_one_half():
    rng = np.random.default_rng(13)
    t = np.arange(4000.0)
    m = np.cumsum(rng.normal(0, 0.05, 4000))
    _, slope = kernels.structure_function(t, m, np.full(4000, 1e-4), statistics.LAG_BINS, 6)
    assert slope == pytest.approx(0.5, abs=0.15)


@pytest.mark.parametrize("n,span", [(600, 900.0), (3000, 900.0), (3000, 5.0), (1600, 40000.0)])
def test_two_scale_power_equals_the_full_sums(n, span):
    t, m, e = noise(n, 14, span)
    y = m - m.mean()
    for scale in (10.0, 100.0):
        sigma = scale / math.sqrt(2 * math.pi**2)
        gap = (t[:, None] - t[None, :]) ** 2
        inner, outer = np.exp(-gap / (2 * sigma**2 / 1.01)), np.exp(-gap / (2 * sigma**2 * 1.01))
        hat = inner / inner.sum(axis=1)[:, None] - outer / outer.sum(axis=1)[:, None]
        # Beside another curve, which it must not see.
        both = [np.concatenate([x, x]) for x in (t - t[0], y, e)]
        filtered, spread = (x[n:] for x in two_scale.band_pass(both[0], np.repeat([0, 1], n), *both[1:], scale))
        np.testing.assert_allclose(filtered, hat @ y, atol=1e-12)
        np.testing.assert_allclose(spread, (hat**2) @ e**2, atol=1e-14)


@pytest.mark.parametrize(
    "step", [statistics.with_statistics, lambda df: period.with_folded(df.withColumn("p", F.lit(0.7) + F.lit(0.1)), "p")]
)
def test_time_is_linear_in_epochs(spark, step):
    # Were a mean worked out again for each element, this would take minutes.
    import time

    rows = table(spark, noise(30_000, 21))
    step(table(spark, noise(30, 22))).collect()
    start = time.perf_counter()
    step(rows).collect()
    assert time.perf_counter() - start < 20


def test_two_scale_power_takes_twice_the_time_for_twice_the_epochs():
    import time

    def seconds(n):
        start = time.process_time()
        two_scale.two_scale_power([noise(n, 3, 1500.0)], 100.0, 10.0)
        return time.process_time() - start

    seconds(100)
    assert min(seconds(80_000) for _ in range(3)) < 3 * min(seconds(40_000) for _ in range(3))


def test_slow_variation_has_more_slow_power():
    t = np.sort(np.random.default_rng(15).uniform(0, 1000, 400))
    slow, fast = two_scale.two_scale_power([(t, np.sin(2 * np.pi * t / p), np.full(400, 1e-3)) for p in (150, 12)], 100.0, 10.0)
    assert slow[0] > 1 > fast[0] and fast[3] == 400 and fast[4] == 0


def test_template_recovers_a_planted_shape():
    t = np.linspace(0, 200, 150)
    args = [np.array([v]) for v in (40.0, 20.0, 0.4, 5.0, 20.0)]
    flux = 50.0 * kernels.template_shape(t, *args).ravel() + 3.0
    m = 16.4 - 2.5 * np.log10(flux)
    found = kernels.template_fit(t, m, np.full(150, 0.02), 16.4, fits.TEMPLATE_GRID, 4)
    assert found[0] == pytest.approx(50.0, rel=0.15) and found[1] == pytest.approx(40.0, abs=8.0)
    assert found[6] < 1.0


def test_template_chi_is_that_of_its_parameters():
    t, m, e = noise(30, 16, span=100)
    a, *shape, chi, c = kernels.template_fit(t, m, e, 16.4, fits.TEMPLATE_GRID, 2)
    flux = 10 ** (-0.4 * (m - 16.4))
    error = 10 ** (-0.4 * (m - e - 16.4)) - flux
    flux = flux - np.percentile(flux, 5)
    model = a * kernels.template_shape(t - t[0], *[np.array([v]) for v in shape]).ravel() + c
    assert chi == pytest.approx((((flux - model) / error) ** 2).mean(), rel=1e-6)


def test_refinement_never_loses():
    t, m, e = noise(30, 17, span=100)
    chis = [kernels.template_fit(t, m, e, 16.4, fits.TEMPLATE_GRID, r)[6] for r in (0, 1, 3)]
    assert chis == sorted(chis, reverse=True)
    scores = [walk.walk_fits([(t, m, e)], fits.LOG_AMPLITUDE, fits.LOG_RATE, r)[0, 2] for r in (0, 1, 3)]
    assert scores == sorted(scores)


def test_no_box_bounds_the_random_walk():
    t = np.sort(np.random.default_rng(18).uniform(0, 3000, 300))
    trend = t / 3000 + np.random.default_rng(19).normal(0, 0.01, 300)
    _, tau, score = walk.walk_fits([(t, trend, np.full(300, 0.01))], fits.LOG_AMPLITUDE, fits.LOG_RATE, None)[0]
    assert tau > 2 * math.exp(-fits.LOG_RATE[0])
    loud = 8.0 * np.random.default_rng(20).normal(size=300)
    sigma, _, _ = walk.walk_fits([(t, loud, np.full(300, 0.01))], fits.LOG_AMPLITUDE, fits.LOG_RATE, None)[0]
    assert sigma == pytest.approx(loud.var(), rel=0.05)


def test_a_short_event_in_a_long_curve_is_found():
    t = np.linspace(0, 2000, 801)
    args = [np.array([v]) for v in (740.0, 20.0, 0.4, 5.0, 20.0)]
    flux = 400.0 * kernels.template_shape(t, *args).ravel() + 3.0
    found = kernels.template_fit(t, 16.4 - 2.5 * np.log10(flux), np.full(801, 0.02), 16.4, fits.TEMPLATE_GRID)
    assert found[0] == pytest.approx(400.0, rel=0.1) and found[1] == pytest.approx(740.0, abs=3.0) and found[6] < 1.0


def test_lags_of_one_night_count():
    t = np.sort(np.random.default_rng(23).uniform(0, 0.3, 400))
    m = np.cumsum(np.random.default_rng(24).normal(0, 0.05, 400))
    amplitude, slope = kernels.structure_function(t, m, np.full(400, 1e-4), statistics.LAG_BINS, 6)
    assert amplitude > 0 and 0.2 < slope < 0.8


@pytest.mark.parametrize(
    "shape",
    [(100.0, 60.0, 0.3, 5.0, 400.0), (100.0, 300.0, 0.3, 5.0, 60.0), (100.0, 60.0, 0.3, 0.2, 60.0)],
)
def test_template_leaves_its_first_grid(shape):
    """Shapes whose durations lie beyond every first trial value."""
    t = np.arange(0.0, 900.0, 3.0) + 0.37 * np.sin(np.arange(300))
    flux = 400.0 * kernels.template_shape(t - t[0], *[np.array([v]) for v in shape]).ravel() + 3.0
    found = kernels.template_fit(t, 16.4 - 2.5 * np.log10(flux), np.full(300, 0.02), 16.4, fits.TEMPLATE_GRID)
    assert found[6] < 1.0


def test_templates_of_many_curves_are_searched_together(monkeypatch):
    """Each curve ends where it ends alone, and the shapes of curves of as many epochs are worked out at once."""
    curves = [noise(n, seed, span=40.0) for seed, n in enumerate([25, 31, 25, 25, 1, 31, *[25] * 20])]
    curves.append((curves[0][0], curves[0][1], -curves[0][2]))
    calls, shape = [0], kernels._joined

    def counted(*args):
        calls[0] += 1
        return shape(*args)

    monkeypatch.setattr(kernels, "_joined", counted)
    alone = [kernels.template_fit(*curve, 16.4, fits.TEMPLATE_GRID) for curve in curves]
    one_by_one, calls[0] = calls[0], 0
    assert kernels.template_fits(curves, 16.4, fits.TEMPLATE_GRID) == alone
    assert 3 * calls[0] < one_by_one
    assert alone[4] == alone[-1] == (None,) * 8


def test_all_start_times_get_all_shapes():
    """The quick sums against the scores of the whole grid."""
    rng = np.random.default_rng(5)
    t = np.sort(rng.uniform(0, 200, 40))
    flux, weight = rng.normal(0, 1, 40) + 5.0 * (t > 120), rng.uniform(1, 2, 40)
    shapes = [np.asarray(axis, dtype=float) for axis in fits.TEMPLATE_GRID[1:]]
    even = np.linspace(-50.0, t[-1], 12)
    chosen = kernels._likely_starts(t, flux, weight, shapes, even, t[-1])
    ahead = np.concatenate([np.zeros(1), shapes[2], shapes[0]])
    near = np.unique(np.round(np.subtract.outer(t, ahead).ravel()))
    every = np.union1d(near[(near >= -50.0) & (near <= t[-1])], even)
    with np.errstate(all="ignore"):
        chi = kernels.template_scores(t, flux, weight, [every, *shapes])[2].reshape(every.size, -1).min(axis=1)
    assert np.abs(chosen - every[int(np.argmin(chi))]).min() < 1e-9


def test_periodogram_rows_are_made_as_columns(spark, documented):
    """The rows hold the array's values, and neither whole arrays nor their pairs are made in the plan."""
    from pyspark.sql import functions as F

    from skyfold.features import period

    grid = period.FrequencyGrid(0.01, 2.0, 0.01)
    usable = documented.unionByName(documented.withColumn("objectid", F.lit(5).cast("long")).withColumn("magerr", F.transform("magerr", lambda x: x - x)))
    rows = period.periodogram(usable, grid)
    assert "Generate" not in rows._jdf.queryExecution().executedPlan().toString()
    whole = period.with_periodogram(documented, grid).select("objectid", "_freq", "_per").first()
    assert sorted(rows.collect()) == [(whole.objectid, f, p) for f, p in zip(whole._freq, whole._per, strict=True)]
    plan = period.with_top_powers(documented, grid, 7)
    assert "_per" not in plan.columns
    assert plan.first()._top == sorted(whole._per, reverse=True)[:7]
    assert period.with_top_powers(usable, grid).where("objectid = 5").first()._top is None


def test_periodogram_rows_are_small_when_stored(spark, tmp_path, monkeypatch):
    """Frequencies and low powers keep their dictionaries in a file, and every row is there, held back or not."""
    # Noise has low powers only, a sinusoid high ones; the last curve has no spectrum, one has no id.
    curves = [sinusoid(40, 0.9)] + [noise(30, seed) for seed in range(14)] + [noise(2)]
    table_ = table(spark, *curves).withColumn("objectid", F.when(F.col("objectid") != 5, F.col("objectid"))).coalesce(1)
    grid = period.STANDARD_GRID
    whole = period.with_periodogram(table_, grid).where("_per is not null").selectExpr("objectid", "explode(arrays_zip(_freq, _per)) as x")
    whole = sorted(whole.select(F.coalesce("objectid", F.lit(-1)), *[F.rint(F.col(f"x.{c}") * 1e4) / 1e4 + F.lit(0.0) for c in ("_freq", "_per")]).collect())
    assert len(whole) == 15 * grid.count
    monkeypatch.setattr(period, "LOT", 4 * grid.count)
    for most in (1000, period.HELD):
        monkeypatch.setattr(period, "HELD", most)
        path = str(tmp_path / f"rows{most}")
        period.periodogram(table_, grid, decimals=4).write.parquet(path)
        stored = spark.read.parquet(path)
        assert sorted(stored.select(F.coalesce("objectid", F.lit(-1)), "freq", "power").collect()) == whole
    size = sum(f.stat().st_size for f in (tmp_path / f"rows{period.HELD}").glob("part-*"))
    assert size / len(whole) < 6
