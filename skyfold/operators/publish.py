"""Turn curves and features into documents and hand them to a store."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.operators.incremental import new_rows
from skyfold.operators.preprocess import Preprocessor
from skyfold.workspace import read_if_there

# Least number of epochs per band for a published curve.
PUBLISH_LIMITS = {1: 5, 2: 5, 3: 1}

SERIES = ("hmjd", "mag", "magerr")


def geo_point(ra: Column, dec: Column) -> Column:
    """A GeoJSON point; longitudes run from -180 to 180, so right ascension is shifted."""
    return F.struct(
        F.lit("Point").alias("type"),
        F.array(ra.cast("double") - 180.0, dec.cast("double")).alias("coordinates"),
    )


def to_binary(values: str | Column, width: str = "<f4") -> Column:
    """Raw little-endian bytes of an array of numbers."""

    @F.pandas_udf("binary")
    def pack(arrays: pd.Series) -> pd.Series:
        return arrays.map(lambda a: None if a is None else a.astype(width).tobytes())

    return pack(values)


def from_binary(values: str | Column, width: str = "<f4") -> Column:
    """The array of numbers in raw little-endian bytes."""

    @F.pandas_udf("array<double>")
    def unpack(blobs: pd.Series) -> pd.Series:
        import numpy as np

        return blobs.map(lambda b: None if b is None else np.frombuffer(b, dtype=width).astype(float))

    return unpack(values)


def lightcurve_documents(df: DataFrame, limits: dict[int, int] | int | None = None, binary: bool = False) -> DataFrame:
    """Good curves as documents: ``_id``, metadata, ``loc`` and the three series."""
    kept = Preprocessor(limit_epochs=PUBLISH_LIMITS if limits is None else limits).run(df)
    documents = (
        kept.drop("catflags", "clrcoeff")
        .withColumn("loc", geo_point(F.col("objra"), F.col("objdec")))
        .withColumnRenamed("objectid", "_id")
    )
    if not binary:
        return documents
    widths = {c: _width(df.schema[c].dataType) for c in SERIES}
    return documents.withColumns({c: to_binary(c, widths[c]) for c in SERIES})


def _width(data_type: T.DataType) -> str:
    """Bytes keep the width that the arrays are stored in."""
    wide = isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.DoubleType)
    return "<f8" if wide else "<f4"


def feature_documents(features: DataFrame) -> DataFrame:
    """Feature rows as documents; the object is the key."""
    return features.withColumnRenamed("objectid", "_id")


def append_new(documents: DataFrame, path: str, drop: bool = False, order: tuple[str, ...] = ()) -> int:
    """Append documents that the Parquet store at ``path`` does not hold; returns how many.

    Of several documents with one ``_id`` the first stays: by ``order``, else by all its
    columns, so that a run again stores the same.  ``drop`` replaces the store.  The
    count is taken while the rows are written.
    """
    spark, schema = documents.sparkSession, documents.select("_id").schema
    order = order or tuple(f.name for f in documents.schema if not isinstance(f.dataType, T.MapType))
    known = spark.createDataFrame([], schema) if drop else read_if_there(spark, path, schema)
    written = Observation("written")
    fresh = new_rows(documents, known, order=order).observe(written, F.count(F.lit(1)).alias("rows"))
    fresh.write.mode("overwrite" if drop else "append").parquet(path)
    return int(written.get["rows"])


def insert_batches(
    documents: DataFrame, connect: Callable[[], Callable[[list[dict]], None]], batch_size: int = 10_000
) -> int:
    """Send documents to any store in batches; returns how many were sent.

    ``connect`` runs once per task and returns a function that takes a list of
    documents.  A lost task is run again, so that function should replace a
    document with the same ``_id`` rather than add it twice.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        insert, pending, sent = connect(), [], 0
        for batch in batches:
            pending.extend(batch.to_dict("records"))
            while len(pending) >= batch_size:
                insert(pending[:batch_size])
                del pending[:batch_size]
                sent += batch_size
        if pending:
            insert(pending)
            sent += len(pending)
        yield pd.DataFrame({"sent": [sent]})

    total = documents.mapInPandas(send, "sent long").agg(F.sum("sent").alias("sent")).first()
    return int(total["sent"] or 0)
