"""A folder of documents that batches are inserted into once, as a Spark data source.

Each task attempt stages a Parquet file of its own, ``batch_size`` rows at a time; when all
tasks have ended, the driver names the files of the attempts that counted in one small
list, and only files in a list are read.  A lost or repeated attempt, or a whole
job that fails, therefore leaves nothing that a reader sees.

    documents.register(spark)
    table.write.format("documents").mode("append").save("s3a://bucket/store")
    documents.read(spark, "s3a://bucket/store")
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

LISTS, DATA = "_lists", "data"


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    # Hadoop names this scheme s3a, Arrow s3.
    return pyarrow.fs.FileSystem.from_uri("s3" + path[3:] if path.startswith("s3a:") else path)


@dataclass
class Staged(WriterCommitMessage):
    """What one task attempt has written."""

    file: str | None
    rows: int


class DocumentWriter(DataSourceArrowWriter):
    """Stages a file a task and lists those that count."""

    def __init__(self, path: str, overwrite: bool, batch_size: int):
        self.path, self.overwrite, self.batch_size = path, overwrite, batch_size
        self.job = f"{time.time_ns():020d}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, root = _place(self.path)
        # Every attempt has a name of its own, so that two of one task never meet.
        name, rows, pending, writer = f"{DATA}/{self.job}/{uuid.uuid4().hex}.parquet", 0, [], None
        try:
            for batch in iterator:
                if writer is None and batch.num_rows:
                    store.create_dir(f"{root}/{DATA}/{self.job}", recursive=True)
                    writer = pyarrow.parquet.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=store)
                rows += batch.num_rows
                pending.append(batch)
                while sum(b.num_rows for b in pending) >= self.batch_size:
                    whole = pa.Table.from_batches(pending)
                    writer.write_table(whole.slice(0, self.batch_size), row_group_size=self.batch_size)
                    pending = whole.slice(self.batch_size).to_batches()
            if writer is not None and any(b.num_rows for b in pending):
                writer.write_table(pa.Table.from_batches(pending), row_group_size=self.batch_size)
        finally:
            if writer is not None:
                writer.close()
        return Staged(name if rows else None, rows)

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = _place(self.path)
        listed = {"files": sorted(m.file for m in messages if m and m.file), "rows": sum(m.rows for m in messages if m), "replaces": self.overwrite}
        store.create_dir(f"{root}/{LISTS}", recursive=True)
        # Written aside and moved, so that a list is there whole or not at all.
        aside = f"{root}/{LISTS}/_{self.job}"
        with store.open_output_stream(aside) as out:
            out.write(json.dumps(listed).encode())
        store.move(aside, f"{root}/{LISTS}/{self.job}.json")

    def abort(self, messages: list[Staged | None]) -> None:
        # Attempts that still run may stage more: what no list names is never read.
        store, root = _place(self.path)
        for message in messages:
            if message and message.file:
                store.delete_file(f"{root}/{message.file}")


class Documents(DataSource):
    """Options: ``path`` (that of ``save``), and ``batch_size``, rows written at once."""

    @classmethod
    def name(cls) -> str:
        return "documents"

    def writer(self, schema: T.StructType, overwrite: bool) -> DocumentWriter:
        size = int(self.options.get("batch_size", "10000"))
        if size < 1 or not self.options.get("path"):
            raise ValueError("a store needs a path and batches of one row at least")
        return DocumentWriter(self.options["path"], overwrite, size)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Documents)


def lists(path: str) -> list[dict]:
    """The lists that count, oldest first: from the last one that replaces all before it."""
    store, root = _place(path)
    found = store.get_file_info(pyarrow.fs.FileSelector(f"{root}/{LISTS}", allow_not_found=True))
    kept: list[dict] = []
    for info in sorted((f for f in found if f.base_name.endswith(".json")), key=lambda f: f.base_name):
        with store.open_input_stream(info.path) as file:
            one = json.loads(file.read())
        kept = [one] if one["replaces"] else [*kept, one]
    return kept


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All documents that have been inserted; a store without any needs the ``schema``."""
    files = [f"{path.rstrip('/')}/{f}" for one in lists(path) for f in one["files"]]
    if not files:
        if schema is None:
            raise ValueError("the store is empty: give the schema")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*files)
