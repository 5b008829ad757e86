"""Centroid clustering over a vector-approximation file (Weber, Schek and Blott 1998).

Every vector has one cell of a few bits per dimension.  For each centroid a table gives
the least and the largest distance a cell allows, and summed over dimensions these are the
interval in which the distance of a vector lies.  Where one interval ends before all others begin the
vector is assigned from its cells alone; full vectors are fetched, by a join with a table bucketed by
row, only where intervals overlap or a vector moves, since sums of centroids are kept by what moved.

Distances are taken less that to one common point, which moves no nearest centroid
and makes all intervals narrower.  All numbers are integers, so bounds and sums are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import stored
from skyfold.workspace import bucketed

#: Bits of a cell, rows whose quantiles part the cells, rows of a bucket, and vectors compared at once.
BITS, SAMPLE, BUCKET, ROWS = 8, 4096, 1 << 17, 2048
#: Integers from here on have squared distances that no long holds.
LARGEST = 1 << 27


def integers(vectors: DataFrame, dim: int = 64, scale: int = 1024, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x`` (``floor(scale * c)`` as 32-bit bytes) of the vectors with exactly ``dim`` entries, none null or non-finite.

    A vector with an entry whose integer is 2^27 or more has distances past a long and takes no part.
    """
    found = vectors.select(vectors[id_column].cast("long").alias("vec_id"), vectors[vector].cast("array<double>").alias("c")).where(F.size("c") == dim)
    found = found.where(~F.exists("c", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * scale >= float(LARGEST))))
    found = found.select("vec_id", F.transform("c", lambda c: F.floor(c * scale).cast("int")).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy().reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in flat], pa.binary())], ["vec_id", "x"])

    return found.mapInArrow(run, "vec_id long, x binary")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


class Cells:
    """Where the cells of each dimension begin, and between which integers they lie."""

    def __init__(self, full: DataFrame, bits: int):
        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low = high = None
            for batch in _parts(batches):
                x = _matrix(batch.column(0), np.int32)
                low, high = (x.min(0), x.max(0)) if low is None else (np.minimum(low, x.min(0)), np.maximum(high, x.max(0)))
            if low is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low), dtype=np.int32)), pa.array(low), pa.array(high)], ["j", "low", "high"])

        reach = full.select("x").mapInArrow(ends, "j int, low int, high int").groupBy("j").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("j").toPandas()
        sample = full.select("key", "x").orderBy(F.xxhash64("key"), "key").limit(SAMPLE).toPandas()["x"]
        own = np.sort(np.frombuffer(b"".join(sample), np.int32).reshape(len(sample), -1), axis=0)
        #: One row per dimension: the first integer of every cell but the lowest.
        self.cuts = own[np.arange(1, 1 << bits) * len(own) >> bits].T.astype(np.int64)
        self.low = np.column_stack([reach["low"], self.cuts]).astype(np.int64)
        self.high = np.column_stack([self.cuts - 1, reach["high"]]).astype(np.int64)

    def of(self, x: np.ndarray) -> np.ndarray:
        """The cell of every entry."""
        return np.column_stack([np.searchsorted(cuts, x[:, j], "right") for j, cuts in enumerate(self.cuts)]).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> np.ndarray:
        """For each dimension and cell the least distance to every centroid, then the largest, both less that to a common point."""
        common = np.rint(centroids.mean(0)).astype(np.int64)
        # The difference of two squared distances is linear in the vector, so it is least and largest at the ends of a cell.
        at = [(end - centroids[:, :, None]) ** 2 - (end - common[:, None]) ** 2 for end in (self.low, self.high)]
        return np.concatenate([np.minimum(*at), np.maximum(*at)]).transpose(1, 2, 0).copy()


def _compared(state: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """``key``, ``cells``, ``old``, and ``near``: a bit for each centroid whose interval begins no later than the first one ends."""
    tables, k = cells.tables(centroids), len(centroids)
    powers = 1 << np.arange(k, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            own = _matrix(part.column(1), np.uint8)
            bounds = np.zeros((len(own), 2 * k), np.int64)
            for j, table in enumerate(tables):
                bounds += table[own[:, j]]
            near = (bounds[:, :k] <= bounds[:, k:].min(axis=1)[:, None]) @ powers
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(near)], ["key", "cells", "old", "near"])

    return state.select("key", "cells", F.col("cluster").alias("old")).mapInArrow(run, "key long, cells binary, old int, near long")


def _decided(found: DataFrame, full: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Fetch the full vectors of rows: ``key``, ``cells``, ``old``, ``vec_id``, ``x``, the nearest centroid ``cluster`` and the squared ``distance``."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            x, near = _matrix(part.column(5), np.int32).astype(np.int64), part.column(3).to_numpy()
            apart = np.full((len(x), k), np.iinfo(np.int64).max)
            for c in range(k):
                mine = np.flatnonzero(near >> c & 1)
                gap = x[mine] - centroids[c]
                apart[mine, c] = (gap * gap).sum(axis=1)
            best = apart.argmin(axis=1)
            new = [part.column(0), part.column(1), part.column(2), part.column(4), part.column(5), pa.array(best.astype(np.int32)), pa.array(apart[np.arange(len(x)), best])]
            yield pa.RecordBatch.from_arrays(new, ["key", "cells", "old", "vec_id", "x", "cluster", "distance"])

    joined = found.join(full, "key").select("key", "cells", "old", "near", "vec_id", "x")
    return joined.mapInArrow(run, "key long, cells binary, old int, vec_id long, x binary, cluster int, distance long")


def _moves(decided: DataFrame, k: int, dim: int) -> np.ndarray:
    """What the sums of each centroid gain and lose, by dimension, and last how many vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dim + 1), np.int64)
        for part in _parts(batches):
            x = np.column_stack([_matrix(part.column(2), np.int32).astype(np.int64), np.ones(part.num_rows, np.int64)])
            old, new = part.column(0).to_numpy(), part.column(1).to_numpy()
            for c in range(k):
                total[c] += x[new == c].sum(axis=0) - x[old == c].sum(axis=0)
        if total.any():
            cell = np.flatnonzero(total).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel()[cell])], ["cell", "part"])

    moved = decided.where("old <> cluster").select("old", "cluster", "x").mapInArrow(run, "cell int, part long")
    out = np.zeros(k * (dim + 1), np.int64)
    for row in moved.groupBy("cell").agg(F.sum("part").alias("part")).collect():
        out[row["cell"]] = row["part"]
    return out.reshape(k, dim + 1)


def clustered(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64, scale: int = 1024, bits: int = BITS) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` for each vector that takes part (see ``integers``).

    The first centroids are the ``k`` vectors with the smallest SHA-256 of ``seed:vec_id``; null
    ids come last, and of equal ids the smaller vector comes first.  With fewer than ``k`` vectors each is a centroid.
    Repeated rows and ids are vectors of their own.  Ties go to the smaller number.  A sum of
    distances that no long holds is null.  An empty table gives no rows.  ``k`` is at most 62, ``bits`` at most 8.
    """
    if not (0 < k <= 62 and 0 < bits <= 8):
        raise ValueError("k must be 1 to 62 and bits 1 to 8")
    kept = stored(integers(vectors, dim, scale).withColumn("key", F.monotonically_increasing_id()), "cluster-vectors")
    first = kept.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "x").limit(k).toPandas()["x"]
    if not len(first):
        return _answer(kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), np.zeros((1, dim), np.int64))
    k, centroids = len(first), np.frombuffer(b"".join(first), np.int32).reshape(len(first), dim).astype(np.int64)
    full = bucketed(kept, "key", max(8, -(-kept.count() // BUCKET)), "cluster-vectors-by-row")
    cells = Cells(kept, bits)

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            own = cells.of(_matrix(part.column(1), np.int32))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.tobytes() for c in own], pa.binary()), pa.array(np.full(len(own), -1, np.int32))], ["key", "cells", "cluster"])

    state = stored(kept.select("key", "x").mapInArrow(approximate, "key long, cells binary, cluster int"), "cluster-cells")
    sums = np.zeros((k, dim + 1), np.int64)
    for _ in range(rounds):
        found = stored(_compared(state, cells, centroids), "cluster-intervals")
        stays = F.expr("old >= 0 and shiftleft(1L, old) = near")
        decided = _decided(found.where(~stays), full, centroids).select("key", "cells", "old", "cluster", F.expr("if(old <> cluster, x, null)").alias("x"))
        decided = stored(decided, "cluster-fetched")
        sums += _moves(decided, k, dim)
        filled = sums[:, dim] > 0
        centroids = np.where(filled[:, None], sums[:, :dim] // np.maximum(sums[:, dim:], 1), centroids)
        state = found.where(stays).select("key", "cells", F.col("old").alias("cluster")).union(decided.select("key", "cells", "cluster"))
    last = stored(_decided(_compared(state, cells, centroids), full, centroids).select("vec_id", "cluster", "distance"), "cluster-answer")
    return _answer(last, centroids)


def _answer(last: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The sums of distances and the digest of each centroid beside every vector: there are no more of them than centroids."""
    sums = {r["cluster"]: int(r["s"]) for r in last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}

    def fitting(total: int) -> int | None:
        return total if total < 1 << 63 else None

    known = [(c, fitting(sums.get(c, 0)), fitting(sum(sums.values())), ",".join(map(str, row.tolist()))) for c, row in enumerate(centroids)]
    beside = last.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, listed string")
    beside = beside.select("cluster", "cluster_inertia", "inertia", F.sha2("listed", 256).alias("centroid_sha256"))
    # A row for each centroid, 62 at most.
    return last.join(F.broadcast(beside), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
