"""Galactic coordinates as features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.features.registry import FeatureFamily
from skyfold.functions.sphere import galactic_b, galactic_l


def with_galactic(df: DataFrame, ra: str = "objra", dec: str = "objdec") -> DataFrame:
    """Add ``gal_b`` and ``gal_l`` in degrees."""
    position = F.col(ra), F.col(dec)
    return df.withColumns({"gal_b": galactic_b(*position), "gal_l": galactic_l(*position)})


def galactic_family() -> FeatureFamily:
    return FeatureFamily("galactic", ("objra", "objdec"), ("gal_b", "gal_l"), with_galactic)
