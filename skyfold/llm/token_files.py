"""Token ids in files of byte-aligned variable-length codes.

Ids are renumbered by how often they occur, the most frequent first, so that most
take one byte.  A block holds whole documents: two bits per id in a stream of
control bytes say how many bytes the id takes in the stream of data bytes, and a
table with a row for each control byte decodes four ids at a time.

The format is Parquet with a row for each block, so that it can be written to and read
from any store that Spark reaches; a block names its range of documents (``file``) and
its place in it.  Beside the blocks stands a folder ``ids`` with the id of each rank.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyfold.llm import wordpieces as wp
from skyfold.llm.common import lots, stored, valid
from skyfold.workspace import shared_folder

#: Ids after which a block ends with the document at hand, and texts that are taken out of a batch together.
BLOCK_IDS = 1 << 18
ROWS = 128

#: Fixed by the format: for each control byte, the bytes of its four ids, first id in the lowest two bits.
SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
_STARTS = np.cumsum(SIZES, axis=1) - SIZES
_SPENT = SIZES.sum(axis=1)
_BLOCK = "file int, first long, docs array<long>, sizes array<long>, control binary, data binary"
_KINDS = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype("<u4")
    size = np.ones(len(ranks), np.uint8)
    for most in (0xFF, 0xFFFF, 0xFFFFFF):
        size += ranks > most
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    control = codes[::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    start = np.cumsum(size, dtype=np.int64) - size
    data = np.empty(int(size.sum(dtype=np.int64)), np.uint8)
    for k, own in enumerate(ranks.view(np.uint8).reshape(-1, 4).T):
        longer = np.flatnonzero(size > k)
        data[start[longer] + k] = own[longer]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The numbers again, by a look-up of each control byte."""
    codes = np.frombuffer(control, np.uint8)
    begin = np.cumsum(_SPENT[codes]) - _SPENT[codes]
    at = (begin[:, None] + _STARTS[codes]).ravel()[:n]
    padded = np.frombuffer(data + bytes(4), np.uint8)
    words = padded[at].astype(np.uint32)
    size = SIZES[codes].ravel()[:n]
    for k in range(1, 4):
        if (size > k).any():
            words |= padded[np.minimum(at + k, len(padded) - 1)].astype(np.uint32) << np.uint32(8 * k)
    return words & _MASKS[size]


def _gathered(docs: DataFrame, path: str, end: int, text: str, id_column: str) -> DataFrame:
    """Blocks of whole documents in ascending order: ``file``, ``first`` (ids of the file before), ``docs``, ``sizes``, ``ids`` (32-bit little-endian bytes), and ``seen`` and ``times``, the counts of ids.

    Texts are dealt by ranges of their id, and rows with one id by the hash of their
    text, so that even an id that all rows share is spread.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, first, size, names, own = TaskContext.get().partitionId(), 0, 0, [], []
        total = np.zeros(0, np.int64)

        def block(last: bool = False) -> pa.RecordBatch:
            nonlocal total
            ids = np.concatenate(own) if own else np.zeros(0, "<u4")
            found = np.bincount(ids, minlength=len(total))
            found[: len(total)] += total
            total = found
            # The last block of a task has how often each id occurred in all of them.
            seen = np.flatnonzero(total) if last else np.zeros(0, np.int64)
            cells = [[file], [first], [names], [[len(x) for x in own]], [ids.tobytes()], [seen], [total[seen]]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, [*_KINDS, _KINDS[2], _KINDS[2]], strict=True)], ["file", "first", "docs", "sizes", "ids", "seen", "times"])

        for batch in batches:
            texts = itertools.chain.from_iterable(part.column(1).to_pylist() for part in lots([batch], ROWS))
            for doc, ids in zip(batch.column(0).to_pylist(), wp.encode(path, texts, end), strict=True):
                names.append(doc)
                own.append(ids)
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield block()
                    first, size, names, own = first + size, 0, [], []
        if len(total) or own:
            yield block(last=True)

    source = docs.select(docs[id_column].cast("long").alias("doc_id"), valid(F.coalesce(docs[text], F.lit(""))).alias("text")).withColumn("mixed", F.xxhash64("text"))
    ordered = source.repartitionByRange("doc_id", "mixed").sortWithinPartitions("doc_id", "mixed", "text").select("doc_id", "text")
    return ordered.mapInArrow(run, "file int, first long, docs array<long>, sizes array<long>, ids binary, seen array<long>, times array<long>")


def by_frequency(blocks: DataFrame) -> np.ndarray:
    """The ids from the most frequent to the rarest, ties to the smaller: as many as the vocabulary has at most."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids, times = (batch.column(k).flatten().to_numpy() for k in range(2))
            total = np.concatenate([total, np.zeros(max(0, int(ids.max(initial=-1)) + 1 - len(total)), np.int64)])
            np.add.at(total, ids, times)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counts = blocks.select("seen", "times").mapInArrow(add, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return counts.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.uint32)


def write(docs: DataFrame, path: str, folder: str, end: int = 2, text: str = "text", id_column: str = "doc_id") -> None:
    """Encode whole texts with a tokenizer file, ``end`` behind each, and write them to ``folder`` in ascending order of ids.

    Null texts count as empty, so that their documents hold the end id alone; null
    document ids come first; rows with one id follow each other in the order of the hashes of
    their texts.  An empty table gives files without blocks.
    """
    blocks = stored(_gathered(docs, path, end, text, id_column), "token-blocks")
    order = by_frequency(blocks)
    rank = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    docs.sparkSession.createDataFrame([(k, int(i)) for k, i in enumerate(order)], "rank int, id long").coalesce(1).write.parquet(f"{folder}/ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                control, data = pack(rank[np.frombuffer(batch.column(4)[k].as_buffer(), "<u4")])
                yield pa.RecordBatch.from_arrays([*(batch.slice(k, 1).column(c) for c in range(4)), pa.array([control], pa.binary()), pa.array([data], pa.binary())], ["file", "first", "docs", "sizes", "control", "data"])

    blocks.drop("seen", "times").mapInArrow(run, _BLOCK).write.option("compression", "zstd").parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (unsigned 32-bit little-endian bytes) from the files."""
    order = spark.read.schema("rank int, id long").parquet(f"{folder}/ids").toPandas().sort_values("rank")["id"].to_numpy("<u4")
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    # One row per file: the window runs over the list of files, not over documents.
    files = blocks.groupBy("file").agg(F.max(F.col("first") + F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, sizes, start, control, data in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                ids = order[unpack(control, data, sum(sizes))].astype("<u4")
                ends = np.cumsum([0, *sizes])
                for at in range(0, len(docs), ROWS):
                    cut = [ids[a:b].tobytes() for a, b in zip(ends[at : at + ROWS], ends[at + 1 : at + ROWS + 1], strict=False)]
                    columns = [pa.array(docs[at : at + ROWS], pa.int64()), pa.array(start + ends[at : at + len(cut)]), pa.array(sizes[at : at + ROWS], pa.int64()), pa.array(cut, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    # Hint with a proven bound: a row per file.
    placed = blocks.join(F.broadcast(files.select("file", before.alias("before"))), "file")
    placed = placed.select("docs", "sizes", (F.col("before") + F.col("first")).alias("start"), "control", "data")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, path: str, end: int = 2) -> DataFrame:
    """Write the documents to a folder of their own in the shared place and read them back."""
    folder = shared_folder(docs.sparkSession, "token-files")
    write(docs, path, folder, end)
    return read(docs.sparkSession, folder)
