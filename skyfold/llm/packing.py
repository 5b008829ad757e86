"""Packing of documents into sequences of a fixed number of tokens.

How many pieces there are of each length decides the packing, and there are no more
lengths than tokens in a sequence.  So one task solves the packing for counts of
lengths, however many documents stand behind them: first pairs are fixed for good
that dominate every other use of their longer piece (Martello and Toth 1990), which
shrinks the instance, then the rest goes best fit, longest first.  The answer is a list
of patterns, each for a number of sequences, and every piece finds its place in it
by its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import itertools
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm import wordpieces as wp
from skyfold.llm.common import lots, stored, valid

#: Documents taken out of a batch and written at once.
ROWS = 128

Pattern = tuple[tuple[tuple[int, int], ...], int]


def reduce_by_dominance(counts: dict[int, int], room: int) -> tuple[list[Pattern], Counter]:
    """Sequences that some best packing has, and the counts of lengths left.

    A longest partner that fits beside a piece dominates every other filling of its
    sequence if no two pieces together take more than the partner without
    overflowing: whatever a best packing puts beside the piece can change places with
    the partner.  That is so if the two fill the sequence, if no two pieces fit
    in beside it, or if three don't and the best two take no more than the partner.
    """
    left, fixed = Counter({w: n for w, n in counts.items() if n}), []
    changed = True
    while changed:
        changed = False
        for w in sorted(left, reverse=True):
            while left[w]:
                free, others = room - w, sorted(s for s in left if left[s] > (s == w))
                at = bisect_left(others, free + 1) - 1
                if at < 0:
                    fixed.append((((w, 1),), left[w] if free < w else 1))
                    left[w] -= fixed[-1][1]
                    changed = True
                    continue
                partner = others[at]
                if not (w + partner == room or _dominates(left, others, w, partner, free)):
                    break
                times = left[w] // 2 if partner == w else min(left[w], left[partner])
                fixed.append((((w, 2),) if partner == w else ((w, 1), (partner, 1)), times))
                left[w] -= times
                left[partner] -= times
                changed = True
    return fixed, Counter({w: n for w, n in left.items() if n})


def _dominates(left: Counter, own: list[int], w: int, partner: int, free: int) -> bool:
    """Whether every two pieces beside one of length ``w`` that leave no overflow take at most ``partner``, and no three fit."""
    smallest = [s for s in own[:3] for _ in range(min(3, left[s] - (s == w)))][:3]
    if len(smallest) < 2 or smallest[0] + smallest[1] > free:
        return True
    if len(smallest) == 3 and sum(smallest) <= free:
        return False
    low, high = 0, len(own) - 1
    while low <= high:
        if own[low] + own[high] > free:
            high -= 1
        elif low == high and left[own[low]] - (own[low] == w) < 2:
            break
        elif own[low] + own[high] > partner:
            return False
        else:
            low += 1
    return True


def best_fit(counts: dict[int, int], room: int) -> list[Pattern]:
    """Best fit, longest first, for counts of lengths: equal sequences are filled together."""
    open_, spaces = {}, []  # free space: [(pattern, sequences)], and the spaces in order

    def put(free: int, pattern: tuple, times: int) -> None:
        if times:
            if free not in open_:
                open_[free] = []
                insort(spaces, free)
            open_[free].append((pattern, times))

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            at = bisect_left(spaces, w)
            free = spaces[at] if at < len(spaces) else room
            pattern, times = open_[free].pop() if at < len(spaces) else ((), n)
            if at < len(spaces) and not open_[free]:
                del open_[free], spaces[at]
            # One after the other, each takes as many as fit: after one more it is the fullest that has room.
            each = min(free // w, n)
            full = min(times, n // each)
            n -= full * each
            put(free - each * w, (*pattern, (w, each)), full)
            if pattern:
                put(free, pattern, times - full)
    return [x for found in open_.values() for x in found]


def solve(counts: dict[int, int], room: int) -> list[Pattern]:
    fixed, rest = reduce_by_dominance(counts, room)
    return fixed + best_fit(rest, room)


def pieces(docs: DataFrame, path: str, room: int = 2048, end: int = 0, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The pieces of every whole text: ``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (32-bit little-endian bytes).

    A document is its ids and ``end``; only one longer than ``room`` is cut.  ``part`` and
    ``nth`` number the pieces of a length in the order of the task that made them.
    The table is stored, so that the numbers stay what they are.  Null texts count as
    empty; null ids and repeated rows are documents of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            texts = itertools.chain.from_iterable(part.column(1).to_pylist() for part in lots([batch], ROWS))
            for some in itertools.batched(zip(batch.column(0).to_pylist(), wp.encode(path, texts, end), strict=True), ROWS):
                rows = []
                for doc, ids in some:
                    for k in range(0, len(ids), room):
                        own = ids[k : k + room]
                        rows.append((doc, k // room, k, len(own), own.tobytes(), part, seen[len(own)]))
                        seen[len(own)] += 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = ["doc_id", "piece", "start", "length", "ids", "part", "nth"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    source = docs.select(docs[id_column].cast("long").alias("doc_id"), valid(docs[text]).alias("text"))
    return stored(source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary, part int, nth long"), "pieces")


def place(cut: DataFrame, room: int = 2048) -> DataFrame:
    """``sequence_id`` and ``offset`` for every piece; other columns are kept, ``part`` and ``nth`` go.

    What the driver gets is one count per length, ``room`` at most.  An empty table has
    no sequences.
    """
    by_task = stored(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # For each length: the rank from which a pattern takes pieces, how many for each sequence, its first sequence and the place in it.
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    used, sequences = Counter(), 0
    for pattern, times in solve(counts, room):
        at = 0
        for length, each in pattern:
            table.setdefault(length, []).append((used[length], each, sequences, at))
            used[length] += each * times
            at += each * length
        sequences += times
    plans = {length: np.array(rows, np.int64) for length, rows in table.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                mine, plan = np.flatnonzero(length == one), plans[int(one)]
                row = plan[np.searchsorted(plan[:, 0], rank[mine], "right") - 1]
                nth = rank[mine] - row[:, 0]
                sequence[mine] = row[:, 2] + nth // row[:, 1]
                offset[mine] = row[:, 3] + nth % row[:, 1] * one
            kept = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    ranked = cut.join(by_task.withColumn("before", before).drop("n"), ["part", "length"])
    kept = [c for c in cut.columns if c not in ("part", "nth")]
    ranked = ranked.select(*kept, (F.col("before") + F.col("nth")).alias("rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1])
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")
