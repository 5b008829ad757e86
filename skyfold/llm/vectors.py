"""Vectors in blocks, and a stated set of query vectors against all of them, block by block."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vectors in a block of rows, and in a block of queries.
ROWS, QUERIES = 4096, 1024
#: Cells of the grid on which blocks meet, at least, and pairs of vectors in one of them, about.
CELLS, PAIRS = 12, 1 << 30

Blocks = tuple[np.ndarray, np.ndarray]


def usable(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", zero: bool = True) -> DataFrame:
    """``id`` and ``v`` (doubles) of the vectors that take part: no null, no null or non-finite component, not empty, ``zero`` or not all zero."""
    found = vectors.select(vectors[id_column].cast("long").alias("id"), vectors[vector].cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = found.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad)
    return found if zero else found.where(F.exists("v", lambda x: x != 0))


def blocks(vectors: DataFrame, size: int, n: int, extra: list[str] | None = None) -> DataFrame:
    """``dim``, ``ids`` (signed 64-bit bytes), ``data`` (doubles, row by row) and each column of longs in ``extra`` as bytes, at most ``size`` vectors a row.

    The ``n`` vectors are dealt out to as few tasks as have full blocks, so that the number of
    blocks does not follow the number of partitions they come in.
    """
    names = extra or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dim: int, rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            cells = [np.array(columns[0], np.int64), np.array(columns[1], np.float64), *(np.array(c, np.int64) for c in columns[2:])]
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in cells)], ["dim", "ids", "data", *names])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = held.setdefault(len(row[1]), [])
                own.append(row)
                if len(own) == size:
                    yield out(len(row[1]), held.pop(len(row[1])))
        for dim, rows in held.items():
            yield out(dim, rows)

    dealt = vectors.select("id", "v", *names).repartition(max(1, -(-n // size)))
    return dealt.mapInArrow(run, "dim int, ids binary, data binary" + "".join(f", {c} binary" for c in names))


def unblocked(row: dict) -> Blocks:
    """The ids and the vectors of a block."""
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["data"], np.float64).reshape(-1, row["dim"])


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def grid(n: int, m: int) -> tuple[int, int]:
    """Stripes of ``n`` rows and of ``m`` queries, whose cells hold about ``PAIRS`` pairs each.

    Rows are copied to every stripe of queries and queries to every stripe of rows; this
    ratio makes the copies fewest.
    """
    cells = max(CELLS, -(-n * m // PAIRS))
    across = min(cells, max(1, round(math.sqrt(cells * n / max(m, 1)))))
    return across, -(-cells // across)


def meet(rows: DataFrame, queries: DataFrame, sizes: tuple[int, int], run: Callable[[dict, dict], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``run`` on each pair of a block of queries and a block of rows with one dimension.

    Blocks of both sides are dealt to the stripes of a grid that grows with the ``sizes`` (of rows and of queries),
    and meet by a join on its cells, each pair in one.
    """
    across, down = grid(*sizes)
    names = [f"r_{c}" for c in rows.columns] + [f"q_{c}" for c in queries.columns]
    left = rows.select(*(F.col(c).alias(f"r_{c}") for c in rows.columns), F.pmod(F.xxhash64("ids"), F.lit(across)).alias("r"), _each(down).alias("c"), F.col("dim").alias("d"))
    right = queries.select(*(F.col(c).alias(f"q_{c}") for c in queries.columns), _each(across).alias("r"), F.pmod(F.xxhash64("ids"), F.lit(down)).alias("c"), F.col("dim").alias("d"))
    pairs = left.join(right, ["r", "c", "d"]).select(*names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                found = run({c[2:]: v for c, v in row.items() if c[0] == "r"}, {c[2:]: v for c, v in row.items() if c[0] == "q"})
                if found is not None and found.num_rows:
                    yield found

    return pairs.mapInArrow(each, schema)


def single(vectors: DataFrame) -> DataFrame:
    """One vector for each id: of rows that share one, the least counts."""
    return vectors.groupBy("id").agg(F.min("v").alias("v"))
