"""Periodogram, period, and the features that need the period."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.features import harmonics, kernels, long_curves
from skyfold.features.registry import FeatureFamily
from skyfold.functions.curves import (
    bound,
    differences,
    known,
    mean,
    phase,
    ratio,
    running_range,
    total,
    with_curve,
    with_expressions,
)

CURVE_INPUTS = ("hmjd", "mag", "magerr")


@dataclass(frozen=True)
class FrequencyGrid:
    """Even grid of trial frequencies per day; the stop is not part of it."""

    start: float = 1e-3
    stop: float = 20.0
    step: float = 1e-3

    @property
    def count(self) -> int:
        return max(int(math.ceil((self.stop - self.start) / self.step - 1e-9)), 1)

    def nearest(self, frequency: str) -> str:
        """SQL text for the grid frequency closest to a frequency; outside the grid, its end."""
        place = f"round(({frequency} - {self.start!r}D)/{self.step!r}D)"
        return f"({self.start!r}D + greatest(least({place}, {self.count - 1}), 0)*{self.step!r}D)"


# The grid of the feature table: 0.001 to 20 per day in steps of 0.001, ten peaks
# refined in steps of 0.0001, entropy over the 100 largest powers.
STANDARD_GRID = FrequencyGrid()
OPTIMA = 10
FINE_STEP = 1e-4
TOP = 100


def with_periodogram(df: DataFrame, grid: FrequencyGrid = STANDARD_GRID) -> DataFrame:
    """Add ``_freq`` and ``_per``: the whole periodogram of each curve, as two arrays."""
    start, step, count = grid.start, grid.step, grid.count

    # A batch of ten thousand periodograms would be gigabytes; hand them on in small lots.
    lot = max(1, 2_000_000 // count)

    @F.pandas_udf("array<double>")
    def power(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for times, mags, errors in batches:
            for first in range(0, len(times), lot):
                part = slice(first, first + lot)
                rows = zip(times[part], mags[part], errors[part])
                yield pd.Series([kernels.spectrum(t, m, e, start, step, count) for t, m, e in rows], dtype=object)

    places = F.sequence(F.lit(0), F.lit(count - 1))
    return with_curve(df).withColumns(
        {
            "_freq": F.transform(places, lambda k: F.lit(start) + k * F.lit(step)),
            "_per": power("_t", "_m", "_e"),
        }
    )


# Of the rows of a periodogram: powers that are ordered together, frequencies of a curve that stay together, rows handed on at once,
# powers a task holds back (16 bytes each, about twice that while they are sorted), and values well within the 2^17 doubles
# that a Parquet file's dictionary of a column has room for.
LOT = 1_000_000
STRETCH = 32
ROWS = 20_000
HELD = 6_000_000
DICTIONARY = 125_000


def periodogram(df: DataFrame, grid: FrequencyGrid = STANDARD_GRID, decimals: int | None = None) -> DataFrame:
    """The periodogram in long form: one row per curve and frequency, rounded to ``decimals`` if given.

    A task makes the rows as columns, some curves at a time: arrays of ``with_periodogram`` would be zipped and
    exploded element by element.

    There are thousands of rows a curve, so their order is one that is small when stored.  Curve by curve, the first page of a
    Parquet file has every frequency once and hardly a power twice; the writer gives up its dictionaries there, and a row
    takes 10 bytes.  The same frequencies of many curves together, lowest powers ahead, keep both.  Rounded powers have few
    values as long as they are low: those beyond the dictionary's room wait in the task and follow sorted.
    """
    start, step, count = grid.start, grid.step, grid.count
    lot, places = max(1, LOT // count), -(-count // STRETCH)
    room = math.inf if decimals is None else DICTIONARY / 10.0**decimals

    def cut(values: np.ndarray) -> np.ndarray:
        return values if decimals is None else np.rint(values * 10.0**decimals) / 10.0**decimals + 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freqs = cut(start + step * np.arange(count))
        ids: list[pa.Array] = []
        held: tuple[list[np.ndarray], list[np.ndarray]] = [], []

        def rows(ids: pa.Array, at: np.ndarray, powers: np.ndarray) -> Iterator[pa.RecordBatch]:
            for part in kernels.blocks(at.size, ROWS):
                curve, place = np.divmod(at[part], count)
                # A power that is not a number stays one, as in the array.
                columns = [ids.take(pa.array(curve)), pa.array(freqs[place]), pa.array(powers[part])]
                yield pa.RecordBatch.from_arrays(columns, ["objectid", "freq", "power"])

        def waiting() -> Iterator[pa.RecordBatch]:
            if ids:
                names, both = pa.concat_arrays(ids), []
                for some in held:
                    both.append(np.concatenate(some))
                    some.clear()
                at, powers = both
                order = np.argsort(powers)
                for part in kernels.blocks(order.size, ROWS):
                    yield from rows(names, at[order[part]], powers[order[part]])
            ids.clear()

        for names, powers in _spectra(batches, start, step, count, lot):
            powers = cut(powers)
            whole = np.full((len(powers), places * STRETCH), -np.inf)
            whole[:, :count] = powers
            whole = whole.reshape(len(powers), places, STRETCH)
            top = whole.max(axis=2)
            fits = top <= room
            lowest = fits & (top <= np.quantile(top[fits], 1 / 16)) if fits.any() else fits
            for chosen in (lowest, fits & ~lowest):
                first, curve = np.nonzero(chosen.T)
                place = first[:, None] * STRETCH + np.arange(STRETCH)
                there = place < count
                yield from rows(names, (curve[:, None] * count + place)[there], whole[curve, first][there])
            mixed, fit = np.repeat(~fits, STRETCH, axis=1)[:, :count], powers <= room
            for chosen, later in ((mixed & fit, False), (mixed & ~fit, True)):
                place, curve = np.nonzero(chosen.T)
                at, found = curve * count + place, powers[curve, place]
                if later:
                    held[0].append(at + sum(map(len, ids)) * count)
                    held[1].append(found)
                else:
                    yield from rows(names, at, found)
            ids.append(names)
            if sum(x.size for x in held[1]) > HELD:
                yield from waiting()
        yield from waiting()

    table = with_curve(df).where("_t is not null and _m is not null and _e is not null").select("objectid", "_t", "_m", "_e")
    schema = T.StructType([df.schema["objectid"], T.StructField("freq", T.DoubleType()), T.StructField("power", T.DoubleType())])
    return table.mapInArrow(run, schema)


def _spectra(
    batches: Iterator[pa.RecordBatch], start: float, step: float, count: int, lot: int
) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The ids and powers of ``lot`` curves at a time, without those that have no spectrum."""
    ids: list[pa.Scalar] = []
    powers: list[np.ndarray] = []
    for batch in batches:
        for k, curve in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)):
            power = kernels.spectrum(*(np.array(x, dtype=float) for x in curve), start, step, count)
            if power is not None:
                ids.append(batch.column(0)[k])
                powers.append(power)
            if len(powers) == lot:
                yield pa.array(ids, ids[0].type), np.array(powers)
                ids, powers = [], []
    if powers:
        yield pa.array(ids, ids[0].type), np.array(powers)


def with_top_powers(df: DataFrame, grid: FrequencyGrid = STANDARD_GRID, count: int = TOP) -> DataFrame:
    """Add ``_top``: the largest powers of each curve in falling order. The rest of the periodogram stays in the task."""
    start, step, size = grid.start, grid.step, grid.count

    @F.pandas_udf("array<double>")
    def largest(times: pd.Series, mags: pd.Series, errors: pd.Series) -> pd.Series:
        def top(t, m, e):
            power = kernels.spectrum(t, m, e, start, step, size)
            return None if power is None else kernels.largest(power, count)

        return pd.Series([top(*curve) for curve in zip(times, mags, errors)], dtype=object)

    return with_curve(df).withColumn("_top", largest("_t", "_m", "_e"))


def top_powers(powers: str, count: int = TOP) -> Column:
    """The largest values of the array column ``powers``, in falling order."""
    return F.expr(f"slice(sort_array({powers}, false), 1, {count})")


def peak_entropy(top: str, count: int = TOP) -> str:
    """PPE as SQL text: 1 minus the entropy of the largest powers over its maximum.

    With v = power + 0.01 and s their sum, the entropy is ln(s) - sum(v ln v)/s.
    """
    lifted = f"transform({top}, v -> v + 0.01D)"
    entropy = f"ln({total(lifted)}) - {ratio(total(lifted, 'x*ln(x)'), total(lifted))}"
    return f"1 - ({entropy})/{math.log(count)!r}D"


def with_period(
    df: DataFrame,
    grid: FrequencyGrid = STANDARD_GRID,
    optima: int = OPTIMA,
    fine_step: float = FINE_STEP,
    top: int = TOP,
) -> DataFrame:
    """Add ``Multiband_period``, ``PPE`` and the work columns ``_best_freq``, ``_best_power``.

    The whole grid is scored, but only the best frequency and the largest powers
    leave the task.  Keyed curves (``long_curves.keyed``) are scored a stretch of epochs at a time.
    """
    start, step, count = grid.start, grid.step, grid.count

    @F.pandas_udf("freq double, power double, top array<double>")
    def best(times: pd.Series, mags: pd.Series, errors: pd.Series) -> pd.DataFrame:
        rows = [
            kernels.best_period(t, m, e, start, step, count, top, optima, fine_step)
            for t, m, e in zip(times, mags, errors)
        ]
        return pd.DataFrame(rows, columns=["freq", "power", "top"])

    if "_key" in df.columns:
        found = long_curves.with_period(df, start, step, count, top, optima, fine_step)
    else:
        found = with_curve(df).withColumn("_best", best("_t", "_m", "_e"))
    return with_expressions(
        found,
        _best_freq=known("_best.freq"),
        _best_power=known("_best.power"),
        Multiband_period=ratio("1D", known("_best.freq")),
        PPE=peak_entropy("_best.top", top),
    ).drop("_best")


# The multiples of the period, by feature name.
POWER_RATES = {
    "Power_rate_1/4": 1.0 / 4.0,
    "Power_rate_1/3": 1.0 / 3.0,
    "Power_rate_1/2": 1.0 / 2.0,
    "Power_rate_2": 2.0,
    "Power_rate_3": 3.0,
    "Power_rate_4": 4.0,
}


def with_power_rates(df: DataFrame, grid: FrequencyGrid = STANDARD_GRID) -> DataFrame:
    """Power at a multiple of the best period over the best power, at the nearest grid frequency."""

    @F.pandas_udf("array<double>")
    def power(times: pd.Series, mags: pd.Series, errors: pd.Series, freqs: pd.Series) -> pd.Series:
        rows = [
            None if np.isnan(f).any() else kernels.power_at(t, m, e, f)
            for t, m, e, f in zip(times, mags, errors, freqs)
        ]
        return pd.Series(rows)

    asked = ", ".join(grid.nearest(f"_best_freq/{factor!r}D") for factor in POWER_RATES.values())
    table = with_expressions(with_curve(df), _asked=f"array({asked})")
    table = table.withColumn("_rates", power("_t", "_m", "_e", "_asked"))
    rates = {name: ratio(f"get(_rates, {i})", "_best_power") for i, name in enumerate(POWER_RATES)}
    return with_expressions(table, **rates).drop("_asked", "_rates")


def with_folded(df: DataFrame, period: str = "Multiband_period", time: str = "hmjd") -> DataFrame:
    """``Psi_CS`` and ``Psi_eta``: order the curve by phase over two periods.

    Equal phases are ordered by time, then by place in the curve.
    """
    df = with_curve(df, time=time)
    placed = f"struct({phase('__x._t', '__p')} as phase, __i as place, __x._m as mag)"
    by_place = f"transform(arrays_zip(_t, _m), (__x, __i) -> {placed})"
    usable = f"`{period}` is not null and _n > 1"
    return with_expressions(
        df,
        _folded=f"sort_array({bound('__p', f'cast(`{period}` as double)', by_place)})",
        _fm="_folded.mag",
        _fmean=mean("_fm"),
        _fdev=bound("o", "_fmean", "transform(_fm, x -> x - o)"),
        _fss=total("_fdev", "x*x"),
        _fsteps=total(differences("_fm"), "x*x"),
        Psi_CS=f"if({usable}, {ratio(running_range('_fdev'), 'sqrt(_n*_fss)')}, null)",
        Psi_eta=f"if({usable}, {ratio('_fsteps*_n', '(_n - 1)*_fss')}, null)",
    ).drop("_folded", "_fm", "_fmean", "_fdev", "_fss", "_fsteps")


def harmonic_names(count: int = 7) -> tuple[str, ...]:
    sizes = [f"Harmonics_mag_{k}" for k in range(1, count + 1)]
    phases = [f"Harmonics_phase_{k}" for k in range(2, count + 1)]
    return (*sizes, *phases, "Harmonics_mse")


def with_harmonics(
    df: DataFrame, period: str = "Multiband_period", count: int = 7, floor: float = 0.01
) -> DataFrame:
    """Weighted Fourier series at the period: amplitudes, relative phases, mean squared residual."""

    @F.pandas_udf("array<double>")
    def fit(times: pd.Series, mags: pd.Series, errors: pd.Series, periods: pd.Series) -> pd.Series:
        return pd.Series(list(harmonics.series(list(zip(times, mags, errors)), periods, count, floor)))

    table = with_curve(df).withColumn("_series", fit("_t", "_m", "_e", period))
    values = {name: known(f"get(_series, {i})") for i, name in enumerate(harmonic_names(count))}
    return with_expressions(table, **values).drop("_series")


def period_family(grid: FrequencyGrid = STANDARD_GRID) -> FeatureFamily:
    return FeatureFamily(
        "period", CURVE_INPUTS, ("Multiband_period", "PPE"), lambda df: with_period(df, grid)
    )


def power_rate_family(grid: FrequencyGrid = STANDARD_GRID) -> FeatureFamily:
    return FeatureFamily(
        "power_rate", CURVE_INPUTS, tuple(POWER_RATES), lambda df: with_power_rates(df, grid), after=("period",)
    )


def folded_family() -> FeatureFamily:
    return FeatureFamily("folded", CURVE_INPUTS, ("Psi_CS", "Psi_eta"), with_folded, after=("period",))


def harmonics_family(count: int = 7) -> FeatureFamily:
    return FeatureFamily(
        "harmonics", CURVE_INPUTS, harmonic_names(count), lambda df: with_harmonics(df, count=count), after=("period",)
    )
