"""Nearest neighbours by one-bit codes of randomly rotated vectors (RaBitQ, Gao and Long 2024).

Each vector less the centroid is scaled to unit length and rotated at random; its code
is the sign of each component.  The inner product of the code with the rotated query,
divided by that of the code with the vector itself, estimates the cosine without bias, and
the error is within a known bound with high probability.  A block first measures
the rows that are nearest by estimate; the k-th of these distances is what the lower
bound of any other row must beat to be measured as well, on the original vectors.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm import vectors as vec
from skyfold.llm.common import stored

#: Standard errors of the estimate that the bound allows for; more measures more rows and misses fewer.
WIDTH = 3.0
#: Rows measured by estimate alone, as a multiple of k.
FIRST = 2
#: Pairs measured at once.
LOT = 1 << 16


@functools.cache
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task: its seed is the dimension."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _turned(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rotated unit vectors and the lengths before; zero vectors stay zero."""
    moved = x - centre
    norm = np.linalg.norm(moved, axis=1)
    return moved @ rotation(x.shape[1]) / np.where(norm > 0, norm, 1)[:, None], norm


def centroids(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The mean vector of each dimension that occurs: as many numbers as components."""
    each = vectors.select(F.size("v").alias("dim"), F.posexplode("v").alias("at", "x"))
    found: dict[int, np.ndarray] = {}
    for r in each.groupBy("dim", "at").agg(F.avg("x").alias("x")).collect():
        found.setdefault(r["dim"], np.zeros(r["dim"]))[r["at"]] = r["x"]
    return found


def index(vectors: DataFrame) -> DataFrame:
    """Blocks with packed sign bits (``codes``), distances from the centroid (``norms``) and inner products of code and vector (``scale``)."""
    centre = centroids(vectors)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                _, x = vec.unblocked(row)
                turned, norm = _turned(x, centre[row["dim"]])
                scale = np.abs(turned).sum(axis=1) / np.sqrt(row["dim"])
                cells = [np.packbits(turned > 0, axis=1).tobytes(), norm.tobytes(), np.where(scale > 0, scale, 1).tobytes()]
                yield pa.RecordBatch.from_arrays([*(batch.slice(k, 1).column(c) for c in range(3)), *(pa.array([c], pa.binary()) for c in cells)], ["dim", "ids", "data", "codes", "norms", "scale"])

    return vec.blocks(vectors, vec.ROWS, vectors.count()).mapInArrow(code, "dim int, ids binary, data binary, codes binary, norms binary, scale binary")


def _measure(q: np.ndarray, x: np.ndarray, at: np.ndarray, member: np.ndarray) -> np.ndarray:
    # Component by component, so that a distance does not depend on what it is measured with.
    parts = [np.zeros(0)]
    for k in range(0, len(at), LOT):
        total = np.zeros(len(at[k : k + LOT]))
        for one in ((q[at[k : k + LOT]] - x[member[k : k + LOT]]) ** 2).T:
            total += one
        parts.append(np.sqrt(total))
    return np.concatenate(parts)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, width: float = WIDTH) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each query the ``k`` vectors found nearest, ties to the smaller id.

    Both sides have ``id`` and ``v`` (doubles), one row for each id; a query is not
    compared with the row of its own id, and vectors of other lengths are no candidates.
    A query with fewer candidates gets them all; without queries or vectors there are
    no rows.
    """
    vectors = stored(vectors, "vectors")
    centre = centroids(vectors)

    def search(row: dict, query: dict) -> pa.RecordBatch | None:
        row_ids, x = vec.unblocked(row)
        query_ids, q = vec.unblocked(query)
        dim = row["dim"]
        norms, scale = (np.frombuffer(row[c], np.float64) for c in ("norms", "scale"))
        codes = np.frombuffer(row["codes"], np.uint8).reshape(len(x), -1)
        signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
        turned, far = _turned(q, centre[dim])
        cosine = (turned.astype(np.float32) @ signs.T) / (np.sqrt(dim) * scale)
        error = width * np.sqrt(np.maximum(1 - scale**2, 0)) / scale / np.sqrt(max(dim - 1, 1))
        base = far[:, None] ** 2 + norms**2
        spread = 2 * far[:, None] * norms
        own = query_ids[:, None] == row_ids
        guess = np.where(own, np.inf, base - spread * cosine)
        first = min(FIRST * k, len(x))
        at = np.repeat(np.arange(len(q)), first)
        member = np.argpartition(guess, first - 1, axis=1)[:, :first].ravel()
        distance = _measure(q, x, at, member)
        distance[own[at, member]] = np.inf
        # Rounding of the estimate counts as an error too.
        limit = np.partition(distance.reshape(len(q), first), min(k, first) - 1, axis=1)[:, min(k, first) - 1] if first >= k else np.full(len(q), np.inf)
        least = base - spread * np.minimum(cosine + error, 1) - 1e-5 * (base + 1e-30)
        more = (least <= limit[:, None] ** 2) & ~own
        more[at, member] = False
        also, others = np.nonzero(more)
        at, member = np.concatenate([at, also]), np.concatenate([member, others])
        distance = np.concatenate([distance, _measure(q, x, also, others)])
        ids = row_ids[member]
        order = np.lexsort((ids, distance, at))
        order = order[np.isfinite(distance[order])]
        at, ids, distance = at[order], ids[order], distance[order]
        few = np.arange(len(at)) - np.searchsorted(at, at) < k
        return pa.RecordBatch.from_arrays([pa.array(query_ids[at[few]]), pa.array(ids[few]), pa.array(distance[few])], ["query_id", "vec_id", "score"])

    sizes = vectors.count(), queries.count()
    near = vec.meet(stored(index(vectors), "codes"), vec.blocks(queries, vec.QUERIES, sizes[1]), sizes, search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
