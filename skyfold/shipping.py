"""The package on the workers of a session whose executors don't have it installed."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


@functools.cache
def _archive() -> str:
    package = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="skyfold-")) / "skyfold.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    return str(path)


@functools.cache
def _ship(application: str, spark: SparkSession) -> None:
    spark.sparkContext.addPyFile(_archive())


def ship(spark: SparkSession) -> None:
    """Send the package to all executors, once per application: the driver serves the archive to them."""
    _ship(spark.sparkContext.applicationId, spark)
