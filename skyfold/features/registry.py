"""Feature families, their order and the feature table.

A family adds columns to a table of curves.  Every built-in family is row-local for
ordinary curves, so their part of the job is one scan with no exchange; skew in any key cannot
slow it down, and a lost executor costs only the partitions it was working on.  Curves
with more than ``long_curves.LONG`` epochs are stored, and their fits are spread over tasks by stretches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions.curves import known, with_curve
from skyfold.schema import require_columns

BASE_COLUMNS = ("filterid", "objra", "objdec", "nepochs")


@dataclass(frozen=True)
class FeatureFamily:
    """A named step: the columns it needs, the features it adds and how.

    ``build`` gets the curves with all earlier columns plus ``_t``, ``_m``, ``_e``
    and ``_n`` (see ``with_curve``), and returns the same rows with more columns.
    Columns that start with ``_`` serve later families and are dropped at the end.
    ``after`` names families that must run first.  A user's own family may use a
    pandas UDF in ``build``.
    """

    name: str
    inputs: tuple[str, ...]
    outputs: tuple[str, ...]
    build: Callable[[DataFrame], DataFrame]
    after: tuple[str, ...] = ()


def default_families() -> list[FeatureFamily]:
    """The nine families of the standard table, in order."""
    from skyfold.features import fits, period, sky, statistics

    return [
        sky.galactic_family(),
        fits.two_scale_family(),
        fits.template_family(),
        statistics.statistics_family(),
        fits.random_walk_family(),
        period.period_family(),
        period.power_rate_family(),
        period.folded_family(),
        period.harmonics_family(),
    ]


def feature_names(families: Sequence[FeatureFamily] | None = None) -> list[str]:
    """Names of the features in table order; 67 for the default families."""
    chosen = default_families() if families is None else families
    return [name for family in chosen for name in family.outputs]


def _check(df: DataFrame, families: Sequence[FeatureFamily]) -> None:
    require_columns(df, ("objectid", *BASE_COLUMNS))
    done: set[str] = set()
    for family in families:
        require_columns(df, family.inputs)
        missing = [name for name in family.after if name not in done]
        if missing:
            raise ValueError(f"run {', '.join(missing)} first: {family.name} needs what it adds")
        done.add(family.name)


def compute_features(df: DataFrame, families: Sequence[FeatureFamily] | None = None) -> DataFrame:
    """One row per curve: ``objectid``, the base columns, then every feature.

    Whether there are long curves is looked up first, by ``nepochs`` alone, which the scan can skip files and
    row groups by.  A count that is off changes only where a curve is fitted.
    """
    from skyfold.features import long_curves

    chosen = default_families() if families is None else list(families)
    _check(df, chosen)
    needed = {c for family in chosen for c in family.inputs}
    kept = [c for c in df.columns if c in needed or c in ("objectid", *BASE_COLUMNS)]
    table = df.select(*kept)
    if not {"hmjd", "mag", "magerr"} <= set(kept):
        return _built(table, chosen)
    long = F.coalesce(F.col("nepochs") > long_curves.LONG, F.lit(False))
    if table.where(long).isEmpty():
        return _built(with_curve(table), chosen)
    return _built(with_curve(table.where(~long)), chosen).unionByName(_built(long_curves.keyed(table.where(long)), chosen))


def _built(table: DataFrame, chosen: Sequence[FeatureFamily]) -> DataFrame:
    for family in chosen:
        table = family.build(table)
    names = feature_names(chosen)
    require_columns(table, names)
    values = [F.expr(known(f"`{name}`")).alias(name) if _is_double(table, name) else F.col(f"`{name}`") for name in names]
    return table.select("objectid", *BASE_COLUMNS, *values)


def _is_double(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.simpleString() in ("float", "double")
