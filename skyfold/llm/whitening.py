"""Whitening of integer vectors, each distinct vector once.

Rows with one and the same vector become one with its multiplicity, which weighs it
in the mean and the covariance (or one does: ``weighted=False``).  The covariance is a sum of weighted
products of centred blocks, one matrix for each task, summed by Spark by its cells; the
driver gets as many numbers as a covariance has, whatever the number of rows.
The components are projected once for each distinct vector and joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import stored

#: Entries past this are no exact integers as doubles.
LARGEST = 1 << 53
#: Components returned at most.
COMPONENTS = 32
_LONG = (1 << 63) - 1


def integers(vectors: DataFrame, scale: int = 64, shift: int = 1_000_000, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``dim`` and ``x`` (longs: ``floor(scale * c) + shift``) of the rows whose vector is not null and has finite entries only.

    An empty vector has no entry to whiten and takes no part, nor does one with an entry
    that as an integer is past 2^53, which no double holds exactly.
    """
    found = vectors.select(vectors[id_column].cast("long").alias("vec_id"), vectors[vector].cast("array<double>").alias("c")).where("size(c) > 0")
    found = found.where(~F.exists("c", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * scale >= float(LARGEST - abs(shift)))))
    return found.select("vec_id", F.size("c").alias("dim"), F.transform("c", lambda c: F.floor(c * scale) + shift).alias("x"))


def gathered(found: DataFrame) -> DataFrame:
    """Rows with one vector brought together as far as a batch holds them: ``dim``, ``x`` (bytes of longs), ``ids`` and ``n``.

    So a vector that a third of all rows share is a row for each batch, not for each
    row, in the exchanges that follow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[bytes, list] = {}
            for doc, x in zip(batch.column(0).to_pylist(), _vectors(batch.column(1)), strict=True):
                own.setdefault(x.tobytes(), []).append(doc)
            keys, ids = list(own), list(own.values())
            cells = [pa.array([len(k) // 8 for k in keys], pa.int32()), pa.array(keys, pa.binary()), pa.array(ids, pa.list_(pa.int64())), pa.array(map(len, ids), pa.int64())]
            yield pa.RecordBatch.from_arrays(cells, ["dim", "x", "ids", "n"])

    return found.select("vec_id", "x").mapInArrow(run, "dim int, x binary, ids array<long>, n long")


def _vectors(column: pa.ListArray) -> list[np.ndarray]:
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _blocks(batches: Iterable[pa.RecordBatch], kind: type) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The rows of each batch by dimension: it, the rows, their numbers as a matrix and their weights; columns ``dim``, numbers, ``w`` come first."""
    for batch in batches:
        dims = batch.column(0).to_numpy()
        for dim in np.unique(dims):
            own = batch.take(pa.array(np.flatnonzero(dims == dim)))
            matrix = np.frombuffer(b"".join(own.column(1).to_pylist()), kind).reshape(own.num_rows, -1)
            yield int(dim), own, matrix, own.column(2).to_numpy()


def _summed(table: DataFrame, of: Callable[[int, np.ndarray, np.ndarray], np.ndarray], kind: str, source: type = np.int64) -> dict[int, list]:
    """For each dimension the sum over blocks of a row of numbers: summed in the task, then by Spark cell by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for dim, _, matrix, weight in _blocks(batches, source):
            part = of(dim, matrix, weight)
            total[dim] = total[dim] + part if dim in total else part
        for dim, cells in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), dim, np.int32)), pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], ["dim", "cell", "part"])

    parts = table.mapInArrow(run, f"dim int, cell int, part {kind}")
    found = parts.groupBy("dim", "cell").agg(F.sum("part").alias("part")).orderBy("dim", "cell").toPandas()
    return {int(dim): own["part"].tolist() for dim, own in found.groupby("dim")}


class Fit:
    """Size, mean and components of the fit list of one dimension."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.over = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S/n``: whole numbers are subtracted as such, so that little is rounded."""
        return (x - self.whole) - self.over / self.n

    def solve(self, covariance: np.ndarray) -> None:
        """Unit eigenvectors by falling eigenvalue; those with no variance but rounding are not among them."""
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        values, vectors = values[::-1], vectors[:, ::-1]
        real = values > max(values[0], 0.0) * len(values) * np.finfo(float).eps
        self.rank = min(int(real.sum()), COMPONENTS)
        self.explained = values[: self.rank] / np.trace(covariance) if self.rank else values[:0]
        vectors = vectors[:, : self.rank]
        # Of the two signs, the one that makes the largest entry positive.
        signs = np.sign(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None, :], axis=0))
        self.axes = vectors * signs / np.sqrt(values[: self.rank])

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n*x - S)^2`` by row; null where one is too large for a long."""
        near = x - self.whole
        most = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if most * most * x.shape[1] <= _LONG:
            part = self.n * near - self.over
            return (part * part).sum(axis=1).tolist()
        exact = [sum((self.n * a - b) ** 2 for a, b in zip(row, self.over.tolist(), strict=True)) for row in near.tolist()]
        return [e if e <= _LONG else None for e in exact]


def whitened(vectors: DataFrame, weighted: bool = True, **names: object) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error`` for each row and component that takes part.

    See ``integers`` for who takes part.  Null and repeated ids and repeated rows
    are rows of their own.  Vectors of different dimension can't share a
    covariance: each dimension has a fit list of its own.  A component without variance can't be scaled
    to one, so a list of equal vectors has no component and no rows; an empty table has none either.
    ``weighted=False`` counts each distinct vector once in the fit; ``n`` is then the number of distinct vectors.
    """
    packs = stored(gathered(integers(vectors, **names)), "whitening-rows")
    distinct = packs.groupBy("dim", "x").agg(F.sum("n").alias("w"))
    distinct = stored(distinct if weighted else distinct.withColumn("w", F.lit(1).cast("long")), "whitening-distinct")

    def halves(_: int, x: np.ndarray, w: np.ndarray) -> np.ndarray:
        # Of numbers up to 2^53 the two halves, so that sums stay exact for 2^35 rows.
        high, low = x >> 27, x & ((1 << 27) - 1)
        return np.concatenate([[w.sum()], w @ high, w @ low])

    fits = {}
    for dim, cells in _summed(distinct, halves, "long").items():
        fits[dim] = Fit(cells[0], [(a << 27) + b for a, b in zip(cells[1 : dim + 1], cells[dim + 1 :], strict=True)])

    def products(centred: np.ndarray, w: np.ndarray) -> np.ndarray:
        return ((centred * w[:, None]).T @ centred).ravel()

    def spread(dim: int, x: np.ndarray, w: np.ndarray) -> np.ndarray:
        return products(fits[dim].centred(x), w)

    gram = _summed(distinct, spread, "double")
    for dim, cells in gram.items():
        fits[dim].solve(np.array(cells).reshape(dim, dim) / fits[dim].n)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, own, x, _ in _blocks(batches, np.int64):
            fit = fits[dim]
            if fit.rank:
                scores = fit.centred(x) @ fit.axes
                cells = [own.column(0), own.column(1), own.column(2), pa.array(fit.deviation(x), pa.int64()), pa.array([s.tobytes() for s in scores], pa.binary())]
                yield pa.RecordBatch.from_arrays(cells, ["dim", "x", "w", "deviation", "scores"])

    once = stored(distinct.mapInArrow(project, "dim int, x binary, w long, deviation long, scores binary"), "whitening-scores")

    # How far the covariance of what came out is from the identity: its mean first, then centred products.
    scored = once.select("dim", "scores", "w")
    mean = {dim: np.array(cells) / fits[dim].n for dim, cells in _summed(scored, lambda _, s, w: w.astype(float) @ s, "double", np.float64).items()}
    again = _summed(scored, lambda dim, s, w: products(s - mean[dim], w), "double", np.float64)
    error = {dim: float(np.abs(np.array(cells).reshape(len(mean[dim]), -1) / fits[dim].n - np.eye(len(mean[dim]))).max()) for dim, cells in again.items()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, ids, deviation, scores in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                fit, own = fits[dim], np.frombuffer(scores)
                for at in range(0, len(ids), 512):
                    some = ids[at : at + 512]
                    count = len(some) * fit.rank
                    cells = [
                        pa.array(some, pa.int64()).take(pa.array(np.repeat(np.arange(len(some)), fit.rank))), pa.array(np.tile(np.arange(1, fit.rank + 1, dtype=np.int32), len(some))),
                        pa.array(np.full(count, fit.n)), pa.array([deviation] * count, pa.int64()), pa.array(np.tile(own, len(some))),
                        pa.array(np.tile(fit.explained, len(some))), pa.array(np.full(count, error[dim])),
                    ]
                    yield pa.RecordBatch.from_arrays(cells, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    joined = packs.join(once.drop("w"), ["dim", "x"]).select("dim", "ids", "deviation", "scores")
    return joined.mapInArrow(rows, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
