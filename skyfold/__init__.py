"""Light-curve and catalogue analytics as Spark DataFrame jobs.

The data model is one row per curve (one object in one band) with its epochs in
parallel arrays.  Work on a curve is row-local: it needs no shuffle, however
large the table is.  Shuffles happen only where rows of different tables or
files have to meet: sky matches, key joins, incremental work and layouts.
"""

from skyfold.features.registry import FeatureFamily, compute_features, default_families, feature_names
from skyfold.operators.preprocess import Preprocessor
from skyfold.schema import LIGHTCURVE_SCHEMA, conform, require_columns

__all__ = [
    "FeatureFamily",
    "LIGHTCURVE_SCHEMA",
    "Preprocessor",
    "compute_features",
    "conform",
    "default_families",
    "feature_names",
    "require_columns",
]
