"""Array expressions over one curve: order, sums, quantiles, differences.

All of them are row-local, so a plan that uses them has no exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LARGEST = 1.7976931348623157e308


def with_curve(df: DataFrame, time: str = "hmjd", mag: str = "mag", err: str = "magerr") -> DataFrame:
    """Add ``_t``, ``_m``, ``_e`` (double arrays in time order) and ``_n`` (epochs).

    Epochs at the same time stay in the order of the arrays.  A curve that already
    has these columns is returned as it is.
    """
    if all(c in df.columns for c in ("_t", "_m", "_e", "_n")):
        return df
    doubles = "array<double>"
    # Some features need no errors; a table without them gets nulls there.
    errors = F.col(err) if err in df.columns else F.transform(mag, lambda _: F.lit(None))
    zipped = F.arrays_zip(
        F.col(time).cast(doubles).alias("t"),
        F.transform(time, lambda _, i: i).alias("i"),
        F.col(mag).cast(doubles).alias("m"),
        errors.cast(doubles).alias("e"),
    )
    ordered = df.withColumn("_curve", F.sort_array(zipped))
    return ordered.withColumns(
        {
            "_t": F.col("_curve.t"),
            "_m": F.col("_curve.m"),
            "_e": F.col("_curve.e"),
            "_n": F.size("_curve").cast("double"),
        }
    ).drop("_curve")


def with_expressions(df: DataFrame, **columns: str) -> DataFrame:
    """Add columns from SQL text in one select; a text may name columns before it.

    Spark resolves such names as lateral aliases and stacks as few projections as
    they need.  Columns already there are replaced.
    """
    old = [name for name in columns if name in df.columns]
    return df.drop(*old).selectExpr("*", *[f"{text} as `{name}`" for name, text in columns.items()])


# The functions below build SQL text from SQL text.  An element is called x, so a
# term must not name a column x.


def bound(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is worked out once per row.

    A lambda that names a column is not enough: when that column is used once, the
    optimizer puts its expression into the lambda, and it runs for every element.
    """
    return f"transform(array({value}), {name} -> {body})[0]"


def total(array: str, term: str = "x") -> str:
    """Sum of a term over an array."""
    return f"aggregate({array}, 0D, (acc, x) -> acc + ({term}))"


def ratio(top: str, bottom: str) -> str:
    """A quotient that is null when the denominator is zero."""
    return f"try_divide({top}, {bottom})"


def mean(array: str) -> str:
    return ratio(total(array), f"size({array})")


def head(array: str, count: str) -> str:
    return f"slice({array}, 1, greatest(int({count}), 0))"


def tail(array: str, count: str) -> str:
    """The last ``count`` elements, or all of them when there are fewer."""
    wanted = f"least(greatest(int({count}), 0), size({array}))"
    return f"slice({array}, size({array}) - {wanted} + 1, {wanted})"


def before(array: str) -> str:
    """All elements but the last: the left end of each successive pair."""
    return head(array, f"size({array}) - 1")


def after(array: str) -> str:
    """All elements but the first: the right end of each successive pair."""
    return tail(array, f"size({array}) - 1")


def differences(array: str) -> str:
    """``x[i+1] - x[i]``."""
    return f"zip_with({after(array)}, {before(array)}, (b, a) -> b - a)"


def first(array: str) -> str:
    return f"get({array}, 0)"


def last(array: str) -> str:
    return f"get({array}, size({array}) - 1)"


def percentile(ordered: str, fraction: float) -> str:
    """Exact percentile with linear interpolation over an ascending array."""
    place = f"((size({ordered}) - 1)*{fraction!r}D)"
    low, high = f"get({ordered}, int(floor({place})))", f"get({ordered}, int(ceil({place})))"
    return f"({low} + ({high} - {low})*({place} - floor({place})))"


def median(ordered: str) -> str:
    low, high = f"get({ordered}, (size({ordered}) - 1) div 2)", f"get({ordered}, size({ordered}) div 2)"
    return f"(({low} + {high})/2D)"


def running_range(steps: str) -> str:
    """Largest minus smallest value of the running sum, in one fold."""
    start = f"struct(0D as at, {_LARGEST!r}D as low, {-_LARGEST!r}D as high)"
    move = "struct(s.at + x as at, least(s.low, s.at + x) as low, greatest(s.high, s.at + x) as high)"
    fold = f"aggregate({steps}, {start}, (s, x) -> {move}, s -> s.high - s.low)"
    return f"if(size({steps}) > 0, {fold}, null)"


def known(value: str) -> str:
    """Null in place of NaN: missing values are null everywhere in this package."""
    return f"nullif({value}, double('NaN'))"


# ---------------------------------------------------------------- public helpers


def center(values: str, by: str = "mean") -> Column:
    """Shift the array column ``values`` by its ``min``, ``mean`` or 5th percentile (``p5``)."""
    origins = {
        "min": "array_min(__v)",
        "mean": mean("__v"),
        "p5": bound("__s", "sort_array(__v)", percentile("__s", 0.05)),
    }
    if by not in origins:
        raise ValueError(f"cannot centre by {by!r}; use min, mean or p5")
    shifted = bound("__o", origins[by], "transform(__v, __x -> __x - __o)")
    return F.expr(bound("__v", f"cast({values} as array<double>)", shifted))


def phase(time: str, period: str, cycles: int = 2) -> str:
    """SQL text that folds one time: position within ``cycles`` periods, from 0 up to 1."""
    span = f"nullif({period}*{float(cycles)!r}D, 0D)"
    return f"pmod({time}, {span})/{span}"


def phase_fold(times: str, period: str, cycles: int = 2) -> Column:
    """Fold the array column ``times`` by the column ``period``."""
    folded = f"transform(cast({times} as array<double>), __x -> {phase('__x', '__p', cycles)})"
    return F.expr(bound("__p", f"cast({period} as double)", folded))


def mag_to_flux(mag: Column, zero_point: float = 16.4) -> Column:
    """Magnitude to flux; the default zero point gives millijansky for AB magnitudes."""
    return F.pow(F.lit(10.0), F.lit(-0.4) * (mag.cast("double") - F.lit(zero_point)))
