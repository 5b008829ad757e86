"""The k highest inner products of each query with all vectors, by global histograms of the scores.

Each round scores every pair again, block by block, and counts for each query how
many scores fall into each bin of the interval that holds its k-th highest; the bin in
which the count from the top reaches k is the next interval.  Once it is one integer
wide, the k-th value is known, and a last pass keeps what lies above it and, of the
ties at it, the smallest ids.  A block counts only bins that can matter: those from
its own k-th highest score up, below which the global one can't lie.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm import vectors as vec
from skyfold.llm.common import stored

#: Bins into which a round divides each query's interval.
BINS = 1024
#: Scores up to here are exact as double sums.
EXACT = 1 << 53
#: Length that vectors stay below.
LONGEST = float(1 << 31)


def _scores(row: dict, query: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, row ids and the scores, those of a query with its own row as the least integer."""
    row_ids, x = vec.unblocked(row)
    query_ids, q = vec.unblocked(query)
    if x.shape[1] * np.abs(x).max(initial=0) * np.abs(q).max(initial=0) < EXACT:
        score = (q @ x.T).astype(np.int64)
    else:
        score = q.astype(np.int64) @ x.astype(np.int64).T
    order = np.argsort(row_ids)
    at = order[np.minimum(np.searchsorted(row_ids, query_ids, sorter=order), len(order) - 1)]
    own = row_ids[at] == query_ids
    score[np.flatnonzero(own), at[own]] = np.iinfo(np.int64).min
    return query_ids, row_ids, score


def _floor(score: np.ndarray, k: int) -> np.ndarray:
    """A bound for each query that its k-th highest score in the block does not fall below: the k-th of the maxima of groups of rows."""
    groups = min(2 * k, score.shape[1])
    if groups <= k:
        return np.full(len(score), np.iinfo(np.int64).min)
    size = score.shape[1] // groups
    most = score[:, : groups * size].reshape(len(score), groups, size).max(axis=2)
    return np.partition(most, groups - k, axis=1)[:, groups - k]


def _length() -> Column:
    return F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))


def fitting(vectors: DataFrame) -> DataFrame:
    """The vectors shorter than ``LONGEST``: scores of any two of them fit 64 bits, so that one long vector doesn't end a search."""
    return vectors.where(_length() < LONGEST)


def top(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each query its ``k`` highest scores, ties to the smaller id.

    Both sides have ``id`` and ``v`` with integer components held as doubles, one row for
    each id; a query is not compared with the row of its own id, and vectors of other
    lengths are no candidates.  A query with fewer candidates gets them all; without
    queries or vectors there are no rows.  Scores must fit 64 bits; see ``fitting``.
    """
    queries = stored(queries, "queries")
    norm = _length()
    sizes = [df.agg(F.max(norm).alias("norm"), F.count(F.lit(1)).alias("n")).first() for df in (vectors, queries)]
    longest = [r["norm"] or 0.0 for r in sizes]
    if not all(map(math.isfinite, longest)) or longest[0] * longest[1] >= 2**62:
        raise OverflowError("scores do not fit 64 bits")
    bound = math.ceil(longest[0] * longest[1] * (1 + 1e-9)) + 1
    rows = stored(vec.blocks(vectors, vec.ROWS, sizes[0]["n"]), "vectors")
    # A power of the number of bins, so that the bins of each interval fill it exactly.
    low, width = -bound, 1
    while width < 2 * bound:
        width *= BINS
    state = queries.select("id", F.lit(low).cast("long").alias("low"), F.lit(0).cast("long").alias("above"), F.lit(False).alias("all"))
    while width > 1:
        step, bins = width // BINS, BINS

        def count(row: dict, query: dict, step: int = step, width: int = width, bins: int = bins) -> pa.RecordBatch | None:
            query_ids, _, score = _scores(row, query)
            low = np.frombuffer(query["low"], np.int64)
            least = np.maximum(_floor(score, k), low)
            least = low + (least - low) // step * step
            at, member = np.nonzero(score >= least[:, None])
            # What lies above the interval has been counted in an earlier round.
            over = score[at, member] - low[at]
            inside = over < width
            cells, n = np.unique(at[inside] * bins + over[inside] // step, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(query_ids[cells // bins]), pa.array(cells % bins), pa.array(n)], ["id", "bin", "n"])

        asked = vec.blocks(queries.join(state.where("NOT all"), "id"), vec.QUERIES, sizes[1]["n"], ["low"])
        counts = vec.meet(rows, asked, (sizes[0]["n"], sizes[1]["n"]), count, "id long, bin long, n long").groupBy("id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("id").orderBy(F.col("bin").desc())
        reached = state.join(counts, "id", "left").withColumn("to", F.col("above") + F.sum("n").over(down))
        # The first bin from the top at which the count reaches k, and the count over it.  Where it never does, in the
        # first round, there are fewer candidates: the interval stays as it is and nothing is counted any more.
        found = reached.groupBy("id").agg(
            F.first("low").alias("low"),
            F.max(F.when(F.col("to") >= k, F.col("bin"))).alias("bin"),
            F.coalesce(F.max(F.when(F.col("to") < k, F.col("to"))), F.first("above")).alias("above"),
        )
        moved = F.col("low") + F.coalesce("bin", F.lit(0).cast("long")) * step
        state = stored(found.select("id", moved.alias("low"), "above", F.col("bin").isNull().alias("all")), "intervals")
        width = step

    def keep(row: dict, query: dict) -> pa.RecordBatch | None:
        query_ids, row_ids, score = _scores(row, query)
        low = np.frombuffer(query["low"], np.int64)
        at, member = np.nonzero(score >= low[:, None])
        value, ids = score[at, member], row_ids[member]
        order = np.lexsort((ids, -value, at))
        at, value, ids = at[order], value[order], ids[order]
        nth = np.arange(len(at)) - np.searchsorted(at, at)
        few = nth < k
        return pa.RecordBatch.from_arrays([pa.array(query_ids[at[few]]), pa.array(ids[few]), pa.array(value[few])], ["query_id", "vec_id", "score"])

    asked = vec.blocks(queries.join(state, "id"), vec.QUERIES, sizes[1]["n"], ["low"])
    near = vec.meet(rows, asked, (sizes[0]["n"], sizes[1]["n"]), keep, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
