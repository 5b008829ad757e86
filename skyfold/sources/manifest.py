"""Checksum manifests, and the files they promise."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.functions import text
from skyfold.schema import require_columns
from skyfold.workspace import local_folder


def parse_manifest(lines: DataFrame, base_url: str, value: str = "value") -> DataFrame:
    """``checksum``, ``file`` and ``field`` from lines of a checksum and a relative path."""
    require_columns(lines, (value,))
    parts = F.split(F.trim(F.col(value)), r"\s+", 2)
    path = F.get(parts, F.lit(1))
    return (
        lines.filter(F.trim(F.col(value)) != "")
        .select(F.get(parts, F.lit(0)).alias("checksum"), path.alias("_path"))
        .select(
            "checksum",
            text.join_url(base_url, F.col("_path")).alias("file"),
            text.field_token(F.col("_path")).alias("field"),
        )
    )


def read_manifest(spark: SparkSession, path: str, base_url: str) -> DataFrame:
    return parse_manifest(spark.read.text(path), base_url)


def manifest_by_field(manifest: DataFrame) -> DataFrame:
    """Per field: number of files, and the first and last of their names.

    Files without a field fall out.  Sums are taken before the shuffle, and the
    files of a field are never gathered; ``layout.split_by`` writes them apart.
    """
    require_columns(manifest, ("checksum", "file", "field"))
    return (
        manifest.filter(F.col("field").isNotNull())
        .groupBy("field")
        .agg(
            F.count("*").alias("files"),
            F.min("file").alias("first_file"),
            F.max("file").alias("last_file"),
        )
    )


def list_files(spark: SparkSession, path: str, skip: str = "tmp") -> DataFrame:
    """``path`` and ``length`` of the files under a folder, without those with ``skip`` below it.

    Only names and sizes are asked for, so no content is read.  Files of no bytes
    are left out by Spark; no data file is empty.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    folder = re.sub(r"^[A-Za-z0-9+.-]+:/*", "", path).strip("/")
    return without(files.select("path", "length"), skip, F.substring_index(F.col("path"), folder, -1))


def without(files: DataFrame, skip: str, text: Column | None = None) -> DataFrame:
    """Files whose path, or the given part of it, does not contain ``skip``."""
    return files.filter(~(F.col("path") if text is None else text).contains(skip))


def with_checksum(files: DataFrame, content: str = "content") -> DataFrame:
    """Replace the content of each file by its MD5 checksum."""
    return files.withColumn("found", F.md5(F.col(content))).drop(content)


def read_checksums(spark: SparkSession, path: str, largest: int = 1 << 28, chunk: int = 1 << 24) -> DataFrame:
    """MD5 checksum of each file under a folder, files of any size; those over ``largest`` bytes are read in chunks.

    Spark's reader lists all files on the driver, gives a task three or four of them, and holds a file as one value.  So a
    folder of a machine's own file system, which all executors share, is listed and read by tasks.  In other
    stores, Spark reads files up to ``largest`` bytes, and the file system that their address names the others.
    """
    folder = local_folder(spark, path)
    if folder is not None and os.path.isdir(folder):
        return _local_checksums(spark, folder, largest, chunk)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    small = with_checksum(files.filter(F.col("length") <= largest).select("path", "content"))

    @F.pandas_udf("string")
    def in_chunks(paths: pd.Series) -> pd.Series:
        from pyarrow import fs

        def checksum(address: str) -> str:
            system, place = fs.FileSystem.from_uri(address)
            found = hashlib.md5()
            with system.open_input_stream(place) as stream:
                while part := stream.read(chunk):
                    found.update(part)
            return found.hexdigest()

        return paths.map(checksum)

    large = files.filter(F.col("length") > largest).select("path").repartition("path")
    return small.unionByName(large.withColumn("found", in_chunks("path")))


def _local_checksums(spark: SparkSession, folder: str, largest: int, chunk: int) -> DataFrame:
    """One task lists the folder itself, many those in it, and many read, each a share of the files by name."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def entries(place: str, deep: bool) -> Iterator[tuple[str, int | None]]:
        """Files with their lengths and, unless they are gone into, folders with none; like Spark, without hidden and empty ones."""
        with os.scandir(place) as found:
            for x in found:
                hidden = x.name.startswith(".") or x.name.startswith("_") and "=" not in x.name or x.name.endswith("._COPYING_")
                if x.is_dir():
                    if not hidden or x.name.startswith(("_metadata", "_common_metadata")):
                        yield from entries(x.path, deep) if deep else [(x.path, None)]
                elif not hidden and x.is_file() and (length := x.stat().st_size):
                    yield x.path, length

    def listed(deep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = (x for batch in batches for x in zip(*(c.to_pylist() for c in batch.columns), strict=True))
            below = (y for place, length in known for y in (entries(place, deep) if length is None else [(place, length)]))
            while some := [*islice(below, 10_000)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), (pa.string(), pa.int64()))], ["path", "length"])

        return run

    def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, found = batch.column(0).to_pylist(), []
            for place, length in zip(places, batch.column(1).to_pylist(), strict=True):
                digest = hashlib.md5()
                with open(place, "rb", buffering=0) as file:
                    while part := file.read(-1 if length <= largest else chunk):
                        digest.update(part)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array([f"file:{x}" for x in places], pa.string()), pa.array(found, pa.string())], ["path", "found"])

    root = spark.range(1).coalesce(1).select(F.lit(folder.rstrip("/") or "/").alias("path"), F.lit(None).cast("long").alias("length"))
    files = root
    for deep in (False, True):
        files = files.mapInArrow(listed(deep), "path string, length long").repartition(parts, "path")
    return files.mapInArrow(checksums, "path string, found string")


def verify(manifest: DataFrame, found: DataFrame, path: str = "path") -> DataFrame:
    """``ok``, ``mismatch`` or ``missing`` for each file of the manifest, matched by name.

    A file found in several places is ``ok`` when one of the copies is.  Copies are
    reduced before the joins, so a name with many of them costs no more than one.
    """
    require_columns(manifest, ("checksum", "file"))
    require_columns(found, (path, "found"))
    copies = found.select(text.basename(F.col(path)).alias("_name"), F.col("found").alias("checksum")).distinct()
    right = copies.withColumn("_right", F.lit(True))
    there = copies.select("_name").distinct().withColumn("_there", F.lit(True))
    status = F.when(F.col("_right"), "ok").when(F.col("_there"), "mismatch").otherwise("missing")
    return (
        manifest.withColumn("_name", text.basename(F.col("file")))
        .join(right, ["_name", "checksum"], "left")
        .join(there, "_name", "left")
        .withColumn("status", status)
        .select(*manifest.columns, "status")
    )
