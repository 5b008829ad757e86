"""Features from fits over a grid of trial parameters, one score per trial."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.features import kernels, long_curves, two_scale, walk
from skyfold.features.registry import FeatureFamily
from skyfold.functions.curves import known, with_curve, with_expressions

CURVE_INPUTS = ("hmjd", "mag", "magerr")

TWO_SCALE = ("MHPS_ratio", "MHPS_low", "MHPS_high", "MHPS_non_zero", "MHPS_PN_flag")
TEMPLATE = ("SPM_A", "SPM_t0", "SPM_gamma", "SPM_beta", "SPM_tau_rise", "SPM_tau_fall", "SPM_chi", "SPM_C")
RANDOM_WALK = ("GP_DRW_sigma", "GP_DRW_tau")

# Trial values for the template: number of start times, then plateau length,
# plateau decline, rise time and fall time in days.
TEMPLATE_GRID = (12, (5.0, 20.0, 60.0, 120.0), (0.0, 0.4, 0.8), (1.0, 5.0, 20.0), (5.0, 20.0, 60.0, 150.0))

# First trial values for the random walk; the search goes on from there and beyond: low, high and count of ln(variance) and ln(rate).
LOG_AMPLITUDE = (-14.0, 2.0, 17)
LOG_RATE = (-8.0, 5.0, 14)


def _unpack(df: DataFrame, packed: str, names: tuple[str, ...]) -> DataFrame:
    return with_expressions(df, **{name: known(f"{packed}.{name}") for name in names}).drop(packed)


def _struct(names: tuple[str, ...]) -> str:
    return ", ".join(f"`{name}` double" for name in names)


def with_two_scale_power(df: DataFrame, slow: float = 100.0, fast: float = 10.0) -> DataFrame:
    """Mexican-hat power at two time scales in days (Arevalo et al. 2012)."""

    @F.pandas_udf(_struct(TWO_SCALE))
    def power(times: pd.Series, mags: pd.Series, errors: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(two_scale.two_scale_power(list(zip(times, mags, errors)), slow, fast), columns=list(TWO_SCALE))

    return _unpack(with_curve(df).withColumn("_power", power("_t", "_m", "_e")), "_power", TWO_SCALE)


def with_template_fit(
    df: DataFrame, zero_point: float = 16.4, grid: tuple = TEMPLATE_GRID, rounds: int | None = None
) -> DataFrame:
    """Supernova-like template: amplitude and offset in closed form, the rest on a grid.

    ``SPM_chi`` is chi^2 per epoch and ``SPM_C`` the flux offset; each value is
    named by what it is.
    """

    @F.pandas_udf(_struct(TEMPLATE))
    def fit(times: pd.Series, mags: pd.Series, errors: pd.Series) -> pd.DataFrame:
        rows = kernels.template_fits(list(zip(times, mags, errors)), zero_point, grid, rounds)
        return pd.DataFrame(rows, columns=list(TEMPLATE), dtype=float)

    return _unpack(with_curve(df).withColumn("_template", fit("_t", "_m", "_e")), "_template", TEMPLATE)


def with_random_walk(
    df: DataFrame,
    log_amplitude: tuple[float, float, int] = LOG_AMPLITUDE,
    log_rate: tuple[float, float, int] = LOG_RATE,
    rounds: int | None = None,
) -> DataFrame:
    """Damped random walk: ``GP_DRW_sigma`` (process variance) and ``GP_DRW_tau`` (days).

    The log-likelihood at the answer is in the work column ``_walk_score``.  Keyed
    curves (``long_curves.keyed``) are searched by rounds over their stretches.
    """
    names = (*RANDOM_WALK, "_walk_score")
    if "_key" in df.columns:
        return long_curves.with_random_walk(df, log_amplitude, log_rate, rounds)

    @F.pandas_udf(_struct(names))
    def fit(times: pd.Series, mags: pd.Series, errors: pd.Series) -> pd.DataFrame:
        rows = walk.walk_fits(list(zip(times, mags, errors)), log_amplitude, log_rate, rounds)
        return pd.DataFrame(rows, columns=list(names))

    return _unpack(with_curve(df).withColumn("_walk", fit("_t", "_m", "_e")), "_walk", names)


def two_scale_family() -> FeatureFamily:
    return FeatureFamily("two_scale_power", CURVE_INPUTS, TWO_SCALE, with_two_scale_power)


def template_family() -> FeatureFamily:
    return FeatureFamily("template", CURVE_INPUTS, TEMPLATE, with_template_fit)


def random_walk_family() -> FeatureFamily:
    return FeatureFamily("random_walk", CURVE_INPUTS, RANDOM_WALK, with_random_walk)
