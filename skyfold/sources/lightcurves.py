"""Read light-curve files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.schema import EPOCH_COLUMNS, LIGHTCURVE_SCHEMA


def read_lightcurves(
    spark: SparkSession, *paths: str, conformed: bool = True, ignore_corrupt: bool = False
) -> DataFrame:
    """Curves from Parquet.

    ``conformed`` files have the exact schema, which is then given instead of
    inferred.  Raw files may hold other widths (``hmjd`` as float); read them with
    ``conformed=False`` and pass the result to ``conform``.  ``ignore_corrupt``
    skips files that cannot be read.
    """
    reader = spark.read.option("ignoreCorruptFiles", str(ignore_corrupt).lower())
    if conformed:
        reader = reader.schema(LIGHTCURVE_SCHEMA)
    return reader.parquet(*paths)


def objects(df: DataFrame) -> DataFrame:
    """The object table: curves without their epochs.  Only those columns are read."""
    return df.drop(*EPOCH_COLUMNS)


def explode_epochs(df: DataFrame) -> DataFrame:
    """Long form: one row per epoch, with its place in the arrays."""
    kept = [c for c in df.columns if c not in EPOCH_COLUMNS]
    place, epoch = "position", "_epoch"
    rows = df.select(*kept, F.posexplode(F.arrays_zip(*EPOCH_COLUMNS)).alias(place, epoch))
    return rows.select(*kept, place, f"{epoch}.*")
