"""Work on what is new only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.functions import text
from skyfold.schema import require_columns


def pending_by_name(files: DataFrame, done: DataFrame, path: str = "path") -> DataFrame:
    """Files whose name, without folders, is not among those done."""
    require_columns(files, (path,))
    require_columns(done, (path,))
    # Names repeat across folders; each is needed once.
    names = done.select(text.basename(F.col(path)).alias("_name")).distinct()
    return files.withColumn("_name", text.basename(F.col(path))).join(names, "_name", "left_anti").drop("_name")


def pending_by_path(files: DataFrame, done: DataFrame, path: str = "path") -> DataFrame:
    """Files whose whole path is not among those done."""
    require_columns(files, (path,))
    require_columns(done, (path,))
    return files.join(done.select(path), path, "left_anti")


def new_rows(
    batch: DataFrame, existing: DataFrame, key: str = "_id", order: tuple[str, ...] = ()
) -> DataFrame:
    """Rows whose key is not stored yet, one per key.

    Of several rows with one key the first by ``order`` stays; without an order
    any of them may.
    """
    require_columns(batch, (key, *order))
    require_columns(existing, (key,))
    fresh = batch.join(existing.select(key), key, "left_anti")
    if not order:
        return fresh.dropDuplicates([key])
    ranked = Window.partitionBy(key).orderBy(*order)
    return fresh.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
