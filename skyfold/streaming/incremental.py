"""Process files as they arrive: each file once, also across restarts.

The file source keeps its own record of files in the checkpoint folder, so no
listing is compared by hand.  ``availableNow`` takes what is there and stops.
Schema conformance and the epoch filter are row-local and run unchanged here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyfold.operators.preprocess import Preprocessor
from skyfold.schema import LIGHTCURVE_SCHEMA, conform


def process_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    step: Callable[[DataFrame], DataFrame],
    schema: T.StructType = LIGHTCURVE_SCHEMA,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Run ``step`` on the files of ``source`` not seen before and append to ``target``."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        step(reader.parquet(source))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def conform_new_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, raw_schema: T.StructType, strict: bool = True
) -> StreamingQuery:
    """Rewrite new files with the exact light-curve schema."""
    return process_new_files(spark, source, target, checkpoint, lambda df: conform(df, strict), raw_schema)


def preprocess_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    preprocessor: Preprocessor,
    schema: T.StructType = LIGHTCURVE_SCHEMA,
) -> StreamingQuery:
    """Apply the epoch filter to new files."""
    return process_new_files(spark, source, target, checkpoint, preprocessor.run, schema)
