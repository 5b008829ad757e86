"""Drop short curves and bad epochs."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.schema import EPOCH_COLUMNS, require_columns


class Preprocessor:
    """Keep curves with enough epochs, and in them the epochs that are good.

    An epoch is good when its error is at most ``mag_error_tolerance`` and its
    flags equal ``catflags_filter``.  ``limit_epochs`` is one limit for all bands,
    or a map from band to limit; bands outside the map are dropped.  The limit
    applies to the stored count first, a plain column comparison that Parquet can
    use to skip data, and to the count of good epochs afterwards.
    """

    def __init__(
        self,
        limit_epochs: int | dict[int, int] = 20,
        mag_error_tolerance: float = 1.0,
        catflags_filter: int = 0,
    ):
        if isinstance(limit_epochs, bool) or not isinstance(limit_epochs, (int, dict)):
            raise TypeError(f"limit_epochs must be an integer or a map of band to integer, not {limit_epochs!r}")
        self.limit_epochs = limit_epochs
        self.mag_error_tolerance = mag_error_tolerance
        self.catflags_filter = catflags_filter

    def _enough(self) -> Column:
        if isinstance(self.limit_epochs, int):
            return F.col("nepochs") >= self.limit_epochs
        bands = [
            (F.col("filterid") == band) & (F.col("nepochs") >= limit) for band, limit in self.limit_epochs.items()
        ]
        return reduce(or_, bands, F.lit(False)) if bands else F.lit(False)

    def discard_by_nepochs(self, df: DataFrame) -> DataFrame:
        """Apply the limit to the ``nepochs`` column as it stands."""
        require_columns(df, ("filterid", "nepochs"))
        return df.filter(self._enough())

    def filter_epochs(self, df: DataFrame) -> DataFrame:
        """Drop bad epochs from all five arrays and count again."""
        require_columns(df, EPOCH_COLUMNS)
        # The tolerance is compared in the width of the stored errors.
        width = df.schema["magerr"].dataType
        element = width.elementType if isinstance(width, T.ArrayType) else T.DoubleType()
        tolerance = F.lit(self.mag_error_tolerance).cast(element)

        def good(epoch: Column) -> Column:
            return (epoch["magerr"] <= tolerance) & (epoch["catflags"] == self.catflags_filter)

        kept = df.withColumn("_kept", F.filter(F.arrays_zip(*EPOCH_COLUMNS), good))
        columns = {c: F.col(f"_kept.{c}") for c in EPOCH_COLUMNS}
        columns["nepochs"] = F.size("_kept").cast("long")
        return kept.withColumns(columns).drop("_kept")

    def run(self, df: DataFrame) -> DataFrame:
        """Limit, filter, limit again.  Row-local, so it runs on a stream too."""
        return self.discard_by_nepochs(self.filter_epochs(self.discard_by_nepochs(df)))
