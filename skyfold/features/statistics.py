"""Twenty-six statistics of one curve.

Definitions follow Nun et al. 2015 (arXiv:1506.00010) and arXiv:2008.03311.  m is the magnitude, e its error, t the time, n the number of
epochs, s the sample standard deviation.  All but three are SQL expressions;
a ratio with a zero denominator is null.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.features import kernels, long_curves, walk
from skyfold.features.registry import FeatureFamily
from skyfold.functions import special
from skyfold.functions.curves import (
    after,
    before,
    bound,
    differences,
    first,
    head,
    known,
    last,
    mean,
    median,
    percentile,
    ratio,
    running_range,
    tail,
    total,
    with_curve,
    with_expressions,
)

CURVE_INPUTS = ("hmjd", "mag", "magerr")


# Each group below is SQL text by column name; a text may name columns before it.

# Work columns that several groups share: mean, deviations, variance.
SPREAD = dict(
    _mean=mean("_m"),
    _dev=bound("o", "_mean", "transform(_m, x -> x - o)"),
    _ss=total("_dev", "x*x"),
    _var=ratio("_ss", "_n - 1"),
    _std="sqrt(_var)",
)

MOMENTS = dict(
    _tmean=mean("_t"),
    _tdev=bound("o", "_tmean", "transform(_t, x -> x - o)"),
    _cube=total("_dev", "x*x*x"),
    _fourth=total("_dev", "x*x*x*x"),
    _noise=total("_e", "x*x"),
    _lifted=ratio("_n*(_n + 1)", "(_n - 1)*(_n - 2)*(_n - 3)"),
    _lowered=ratio("3*(_n - 1)*(_n - 1)", "(_n - 2)*(_n - 3)"),
    Mean="_mean",
    Std="_std",
    Meanvariance=ratio("_std", "_mean"),
    Skew=ratio("_cube*sqrt(_n)", "pow(_ss, 1.5D)"),
    SmallKurtosis=f"if(_n >= 4, _lifted*{ratio('_fourth', '_var*_var')} - _lowered, null)",
    ExcessVar=ratio("_ss - _noise", "_n*_mean*_mean"),
    LinearTrend=ratio(total("zip_with(_tdev, _dev, (t, d) -> t*d)"), total("_tdev", "x*x")),
)

QUANTILES = dict(
    _sorted="sort_array(_m)",
    _median=median("_sorted"),
    _p3=percentile("_sorted", 0.03),
    _p97=percentile("_sorted", 0.97),
    _edge="ceil(_n*0.05D)",
    _tenth=f"({last('_sorted')} - {first('_sorted')})/10",
    _away=f"sort_array({bound('o', '_median', 'transform(_sorted, x -> abs(x - o))')})",
    _lowest=bound("p", "_p3", "filter(_sorted, x -> x <= p)"),
    _highest=bound("p", "_p97", "filter(_sorted, x -> x >= p)"),
    _bottom=head("_sorted", "_edge"),
    _top=tail("_sorted", "_edge"),
    _near=bound("w", "_tenth", "filter(_away, x -> x < w)"),
    Amplitude=f"({median('_top')} - {median('_bottom')})/2",
    Q31=f"{percentile('_sorted', 0.75)} - {percentile('_sorted', 0.25)}",
    MedianAbsDev=median("_away"),
    MedianBRP=ratio("size(_near)", "_n"),
    PercentAmplitude=ratio(last("_away"), "_median"),
    Gskew=f"{median('_lowest')} + {median('_highest')} - 2*_median",
)

# About the mean weighted by 1/e^2.
WEIGHTED = dict(
    _weight=f"transform(_e, x -> {ratio('1D', 'x*x')})",
    _wmean=ratio(total("zip_with(_weight, _m, (w, m) -> w*m)"), total("_weight")),
    _wdev=bound("o", "_wmean", "transform(_m, x -> x - o)"),
    _wstd=f"sqrt({ratio(total('_wdev', 'x*x'), '_n - 1')})",
    _factor=f"sqrt({ratio('_n', '_n - 1')})",
    _scaled=bound("f", "_factor", f"zip_with(_wdev, _e, (d, e) -> {ratio('d', 'e')}*f)"),
    _beyond=bound("w", "_wstd", "filter(_wdev, x -> abs(x) > w)"),
    Beyond1Std=f"if(_wstd is null, null, {ratio('size(_beyond)', '_n')})",
    StetsonK=ratio(total("_scaled", "abs(x)"), f"sqrt(_n*{total('_scaled', 'x*x')})"),
)

_SAME = "(b, a) -> if(a = b, a, 0)"

# Statistics of the time order.
ORDERED = dict(
    _side=bound("w", "2*_std", "transform(_dev, x -> case when x > w then 1 when x < -w then -1 else 0 end)"),
    _pair=f"zip_with({after('_side')}, {before('_side')}, {_SAME})",
    _run=f"zip_with({after('_pair')}, {head('_side', '_n - 2')}, {_SAME})",
    _step=differences("_m"),
    _gap=differences("_t"),
    # Epochs at the same time have no slope: null, left out of what follows.
    _slope=f"filter(zip_with(_step, _gap, (m, t) -> {ratio('m', 't')}), x -> x is not null)",
    # mean(w) * sum(w*dm^2) / sum(w) with w = 1/dt^2 is the mean of dm^2/dt^2 over the pairs.
    _square=ratio(total("_slope", "x*x"), "size(_slope)"),
    _span=f"{last('_t')} - {first('_t')}",
    _recent=tail("_m", "30"),
    _last=differences("_recent"),
    Con=ratio("size(filter(_run, x -> x != 0))", "_n - 2"),
    Eta_e=ratio("_square*_span*_span", "_ss*_n"),
    MaxSlope="array_max(transform(_slope, x -> abs(x)))",
    PairSlopeTrend="(2*size(filter(_last, x -> x > 0)) - size(_last))/30",
    Rcs=ratio(running_range("_dev"), "_n*_std"),
)

# Probability that a constant source would vary less than this one.
PVAR = dict(
    _chi=total(f"zip_with(_dev, _e, (d, e) -> {ratio('d*d', 'e*e')})"),
    Pvar=f"if(_n > 1, {known(special.chi_square_cdf('_chi', '(_n - 1)'))}, null)",
)

_STANDARD = f"transform(_dev, x -> {ratio('x', 'w')})"

# Normality statistic A^2, squashed to 0..1 (Kim et al. 2009).
ANDERSON_DARLING = dict(
    _z=f"sort_array({bound('w', '_std', _STANDARD)})",
    _below=f"transform(_z, x -> {special.log_normal_cdf('x')})",
    _above=f"transform(reverse(_z), x -> {special.log_normal_cdf('(-x)')})",
    _both="zip_with(_below, _above, (a, b) -> a + b)",
    _a2=f"-_n - {ratio(total('transform(_both, (x, i) -> x*(2*i + 1))'), '_n')}",
    AndersonDarling="if(_std > 0, 1/(1 + exp(-10*(_a2 - 0.3D))), null)",
)


def _with_group(df: DataFrame, group: dict[str, str], spread: bool = True) -> DataFrame:
    return with_expressions(with_curve(df), **(SPREAD if spread else {}), **group)


def with_moments(df: DataFrame) -> DataFrame:
    """Mean, Std, Meanvariance, Skew, SmallKurtosis, ExcessVar, LinearTrend."""
    return _with_group(df, MOMENTS)


def with_quantiles(df: DataFrame) -> DataFrame:
    """Amplitude, Q31, MedianAbsDev, MedianBRP, PercentAmplitude, Gskew."""
    return _with_group(df, QUANTILES, spread=False)


def with_weighted(df: DataFrame) -> DataFrame:
    """Beyond1Std and StetsonK."""
    return _with_group(df, WEIGHTED, spread=False)


def with_ordered(df: DataFrame) -> DataFrame:
    """Con, Eta_e, MaxSlope, PairSlopeTrend, Rcs."""
    return _with_group(df, ORDERED)


def with_pvar(df: DataFrame) -> DataFrame:
    """Pvar."""
    return _with_group(df, PVAR)


def with_anderson_darling(df: DataFrame) -> DataFrame:
    """AndersonDarling."""
    return _with_group(df, ANDERSON_DARLING)


def with_autocorrelation(df: DataFrame, level: float = math.exp(-1.0)) -> DataFrame:
    """Autocor_length: first lag, in epochs, with an autocorrelation below 1/e."""

    @F.pandas_udf("double")
    def length(mags: pd.Series) -> pd.Series:
        return pd.Series([kernels.correlation_length(m, level) for m in mags], dtype=float)

    df = with_curve(df).withColumn("_lag", length("_m"))
    return with_expressions(df, Autocor_length=known("_lag"))


# Lag bins: ten to a decade, over all lags of a curve.
LAG_BINS = 10


def with_structure_function(
    df: DataFrame, per_decade: int = LAG_BINS, fewest_pairs: int = 6
) -> DataFrame:
    """SF_ML_amplitude and SF_ML_gamma: variability at one year and its slope with lag."""

    @F.pandas_udf("a double, g double")
    def fit(times: pd.Series, mags: pd.Series, errors: pd.Series) -> pd.DataFrame:
        rows = [
            kernels.structure_function(t, m, e, per_decade, fewest_pairs) for t, m, e in zip(times, mags, errors)
        ]
        return pd.DataFrame(rows, columns=["a", "g"], dtype=float)

    df = with_curve(df).withColumn("_sf", fit("_t", "_m", "_e"))
    return with_expressions(df, SF_ML_amplitude=known("_sf.a"), SF_ML_gamma=known("_sf.g"))


def with_autoregression(
    df: DataFrame, grid: tuple[float, float, int] = (0.01, 0.99, 50), rounds: int | None = None
) -> DataFrame:
    """IAR_phi: correlation after one day (Eyheramendy et al. 2018), by a refined grid.

    The log-likelihood at the answer is in the work column ``_iar_score``.  Keyed
    curves (``long_curves.keyed``) are searched by rounds over their stretches.
    """
    if "_key" in df.columns:
        return long_curves.with_autoregression(df, grid, rounds)

    @F.pandas_udf("phi double, score double")
    def fit(times: pd.Series, mags: pd.Series, errors: pd.Series) -> pd.DataFrame:
        rows = walk.autoregression_fits(list(zip(times, mags, errors)), grid, rounds)
        return pd.DataFrame(rows, columns=["phi", "score"])

    df = with_curve(df).withColumn("_iar", fit("_t", "_m", "_e"))
    return with_expressions(df, IAR_phi=known("_iar.phi"), _iar_score=known("_iar.score"))


# Names and order of the statistics in the feature table.
STATISTICS = (
    "Amplitude",
    "AndersonDarling",
    "Autocor_length",
    "Beyond1Std",
    "Con",
    "Eta_e",
    "Gskew",
    "MaxSlope",
    "Mean",
    "Meanvariance",
    "MedianAbsDev",
    "MedianBRP",
    "PairSlopeTrend",
    "PercentAmplitude",
    "Q31",
    "Rcs",
    "Skew",
    "SmallKurtosis",
    "Std",
    "StetsonK",
    "Pvar",
    "ExcessVar",
    "SF_ML_amplitude",
    "SF_ML_gamma",
    "IAR_phi",
    "LinearTrend",
)

_GROUPS = {**SPREAD, **MOMENTS, **QUANTILES, **WEIGHTED, **ORDERED, **PVAR, **ANDERSON_DARLING}
_WORK = [name for name in (*_GROUPS, "_lag", "_sf", "_iar", "_iar_score") if name.startswith("_")]


def with_statistics(df: DataFrame) -> DataFrame:
    """All twenty-six statistics."""
    for step in (with_autocorrelation, with_structure_function, with_autoregression):
        df = step(df)
    return with_expressions(df, **_GROUPS).drop(*_WORK)


def statistics_family() -> FeatureFamily:
    return FeatureFamily("statistics", CURVE_INPUTS, STATISTICS, with_statistics)
