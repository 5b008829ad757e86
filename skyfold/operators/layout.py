"""Ways to lay a table out in files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.functions import sphere
from skyfold.schema import require_columns
from skyfold.workspace import local_folder


def split_by(df: DataFrame, path: str, column: str, records: int = 50_000, mode: str = "errorifexists") -> None:
    """One folder per value of ``column``, at most ``records`` rows per file."""
    require_columns(df, (column,))
    df.write.mode(mode).option("maxRecordsPerFile", records).partitionBy(column).parquet(path)


def split_by_band(df: DataFrame, path: str, records: int = 50_000, mode: str = "errorifexists") -> None:
    """One folder ``fid=...`` per band.  Rows stay where they are: there is no shuffle."""
    split_by(df.withColumn("fid", F.col("filterid")), path, "fid", records, mode)


def split_by_epochs(
    df: DataFrame,
    path: str,
    records: int = 10_000,
    parts: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """Like ``split_by_band``, with curves of about equal length side by side.

    Readers of such files get even work.  The length is the sort key of a range
    partitioning with the object as second key, so that one length shared by a
    third of all curves is spread over many tasks instead of filling one.  Finding
    the ranges takes a first pass, so give it a stored table.
    """
    require_columns(df, ("objectid", "filterid", "nepochs"))
    keys = ("nepochs", "objectid")
    placed = df.repartitionByRange(*((parts,) if parts else ()), *keys)
    split_by(placed.withColumn("fid", F.col("filterid")), path, "fid", records, mode)


def write_files(df: DataFrame, path: str, files: int = 50) -> None:
    """Replace ``path`` by at most ``files`` files.

    Rows are dealt out anew, so that the work that makes them runs in as many tasks as it needs.
    """
    df.repartition(files).write.mode("overwrite").parquet(path)


def write_texts(df: DataFrame, path: str, key: str, text: str, parts: int) -> None:
    """A text file for each value of ``key``, its name with ``key=value`` in it, a line for each row; ``parts`` tasks write.

    Spark's writer makes a folder for each value too; on a machine's own file system it starts a program for the rights of
    each file, and the driver moves the folders one by one.  There, a task writes its files itself, into one
    folder: aside first, so that a file is whole or not there, and a repeated task replaces it.
    """
    require_columns(df, (key, text))
    dealt = df.select(key, text).repartition(parts, key)
    root = local_folder(df.sparkSession, path)
    if root is None:
        # The line break at the end of each line is part of the file.
        dealt.write.partitionBy(key).option("lineSep", "\n").text(path)
        return
    os.makedirs(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = f"{TaskContext.get().partitionId():05d}"
        os.makedirs(f"{root}/{part}", exist_ok=True)
        aside, file, last, files = f"{root}/{part}/.{uuid.uuid4().hex}", None, None, 0

        def close() -> None:
            file.close()
            value = "__HIVE_DEFAULT_PARTITION__" if last is None else quote(str(last), safe="")
            os.replace(aside, f"{root}/{part}/part-{part}-{key}={value}.txt")

        for batch in batches:
            for value, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if file is None or value != last:
                    if file is not None:
                        close()
                    file, last, files = open(aside, "wb"), value, files + 1
                if line.is_valid:
                    file.write(line.as_buffer())
                file.write(b"\n")
        if file is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([files])], ["files"])

    ordered = dealt.select(key, F.col(text).cast("binary")).sortWithinPartitions(key)
    ordered.mapInArrow(run, "files long").agg(F.sum("files")).collect()


def write_for_lookup(
    df: DataFrame,
    path: str,
    level: int = 6,
    ra: str = "objra",
    dec: str = "objdec",
    parts: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """Files sorted by sky pixel, field and band, for lookups by any of them.

    Each file covers a short range of nested HEALPix pixels, so the Parquet
    minimum and maximum let a reader skip nearly all files.  The object is the
    last range key: a crowded pixel is split.  Finding the ranges takes a first
    pass, so give it a stored table.
    """
    require_columns(df, ("objectid", "fieldid", "filterid", ra, dec))
    pixelled = df.withColumn("ipix", sphere.healpix(F.col(ra), F.col(dec), level))
    keys = ("ipix", "fieldid", "filterid", "objectid")
    placed = pixelled.repartitionByRange(*((parts,) if parts else ()), *keys)
    placed.sortWithinPartitions(*keys).write.mode(mode).parquet(path)
