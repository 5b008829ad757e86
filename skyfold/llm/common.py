"""Helpers that several operators share: stored tables and components of a graph."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.workspace import shared_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Cut the lineage: write a table to the shared folder and read it back."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lots(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time, so that a task holds few texts as Python strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def tucked(docs: DataFrame, but: str | None = None) -> Column:
    """All columns, ``but`` one, as one struct, ``row``, so that no name of theirs meets a name of an operator's own."""
    return F.struct(*(docs[f"`{c}`"].alias(c) for c in docs.columns if c != but)).alias("row")


def valid(text: Column) -> Column:
    """A text that can be decoded: bytes that are no UTF-8 become U+FFFD, valid texts and null stay."""
    return F.make_valid_utf8(text)


def untucked(found: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns out of ``row`` again, some of them made anew."""
    return found.select(*((new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in columns))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node on a link ``a``, ``b``.

    Each round points every node to the least of its own root, its neighbours' roots
    and their roots' roots, so that the number of rounds grows with the logarithm of
    the longest path.  A hub is met by joins whose large keys Spark can split, and by
    sums that are made before rows are sent.
    """
    both = links.where("a <> b").select("a", "b").union(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "links")
    roots = stored(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("root")), "roots")
    while True:
        # Hook: the root of each node learns the least root among the node's neighbours.
        near = both.join(roots.withColumnRenamed("root", "far"), both["b"] == roots["node"]).select("a", "far")
        offers = near.groupBy(F.col("a").alias("node")).agg(F.min("far").alias("far")).join(roots, "node").select("node", "root", F.least("root", "far").alias("low"))
        hooks = offers.groupBy(F.col("root").alias("hook")).agg(F.min("low").alias("to"))
        moved = offers.join(hooks, offers["root"] == hooks["hook"]).select("node", F.least("low", "to").alias("root"), F.col("root").alias("old"))
        # Jump: take the root of the root.
        ahead = moved.select(F.col("node").alias("at"), F.col("root").alias("then"))
        moved = moved.join(ahead, moved["root"] == ahead["at"]).select("node", F.least("root", "then").alias("root"), "old")
        moved = stored(moved, "roots")
        roots = moved.select("node", "root")
        if moved.where("root <> old").isEmpty():
            return roots.withColumnRenamed("root", "component")


class Sieve:
    """Which 64-bit numbers may be in a column: a bitmap of a fixed size, whatever the number of rows.

    It says no only where the answer is no; the fuller it gets, the less it keeps back.
    """

    def __init__(self, column: DataFrame, bits: int = 1 << 25):
        name = column.columns[0]
        place = F.pmod(F.col(name), F.lit(bits))
        words = column.where(F.col(name).isNotNull()).select((place / 64).cast("long").alias("w"), F.expr(f"shiftleft(1L, cast(pmod({name}, 64) as int))").alias("b"))
        found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
        self.words = np.zeros(bits // 64, np.int64)
        self.words[found["w"].to_numpy()] = found["b"].to_numpy()

    def may_hold(self, values: np.ndarray) -> np.ndarray:
        place = np.mod(values, len(self.words) * 64)
        return (self.words[place >> 6] >> (place & 63)) & 1 == 1
