"""Near copies of whole documents: those whose sets of five-word shingles have a Jaccard similarity of ``LIKE`` or more.

A 64-bit fingerprint alone can't find them: at 0.8 two fingerprints differ by about 10 bits, far
beyond the three of ``simhash``.  Candidates meet as paragraphs do, in a band of
minima (of ten bands, so that 99.99 of 100 pairs at 0.8 meet), and the exact similarity of the sets decides.
The links of fingerprints can be taken as well: components are then those of both kinds of links together.
Rows are told apart by themselves and not by their id, which gives the order only.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm import paragraphs, simhash
from skyfold.llm.common import components, lots, stored, tucked, untucked, valid

BANDS = paragraphs.MOST_BANDS


def _whole(text: str) -> list[str]:
    """A text as its only part."""
    return [text]


def _keyed(batches: Iterator[pa.RecordBatch], words: int | None) -> Iterator[pa.RecordBatch]:
    for batch in lots(batches):
        units, raws, keys, marks = [], [], [], []
        for text in batch.column(2).to_pylist():
            marks.append(None if words is None else simhash.fingerprint(text, words))
            numbers = paragraphs._numbers((text or "").lower().split())
            raws.append(paragraphs.raw_hash(text or ""))
            units.append(paragraphs._unit(numbers))
            n = len(numbers) - paragraphs.WORDS + 1
            keys.append(paragraphs.bands(paragraphs._rolled(numbers), np.array([0]), np.array([n]), BANDS)[0].tolist() if n > 0 else [])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(units, pa.int64()), pa.array(raws, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.int64())], ["doc", "own", "unit", "raw", "keys", "fp"])


def _marked(found: DataFrame) -> DataFrame:
    """Links between units that connect those whose fingerprints ``fp`` link, one fewer than the units of each component."""
    marks = found.select("unit", "fp").distinct()
    linked = components(simhash.links(marks.select("fp").distinct()))
    placed = marks.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("mark", F.coalesce("component", "fp"))
    least = placed.groupBy("mark").agg(F.min("unit").alias("a"))
    return placed.join(least, "mark").select("a", F.col("unit").alias("b")).where("a <> b")


def first_of_alike(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int | None = None) -> DataFrame:
    """The documents that stay, all columns: of each component of near copies the row with the smallest id, null last, ties by the text's hash.

    Texts of the same words are copies, also those of fewer words than a shingle and those
    without any; null counts as empty.  Rows that share an id, or have none, are
    judged by their texts like all others.  An empty table stays empty.  With ``words`` documents
    whose fingerprints of shingles of so many words link (``simhash.links``) are near copies too.
    """
    own = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    source = docs.select(docs[id_column].cast("long").alias("doc"), own.alias("own"), valid(docs[text]).alias("text"))
    found = stored(source.mapInArrow(functools.partial(_keyed, words=words), "doc long, own long, unit long, raw long, keys array<long>, fp long"), "copies")
    links = paragraphs.near(found, source.select("doc", "text"), _whole)
    linked = components(links if words is None else links.unionByName(_marked(found)))
    order = F.struct(F.col("doc").isNull().alias("last"), "doc", "own")
    least = found.groupBy("unit").agg(F.min(order).alias("least"))
    placed = least.join(linked.withColumnRenamed("node", "unit"), "unit", "left").withColumn("component", F.coalesce("component", "unit"))
    heads = placed.groupBy("component").agg(F.min("least").alias("head")).select(F.col("head.doc").alias("met"), F.col("head.own").alias("same"))
    whole = docs.select(tucked(docs), docs[id_column].cast("long").alias("doc"), own.alias("own"))
    first = whole.join(heads, F.col("doc").eqNullSafe(F.col("met")) & (F.col("own") == F.col("same")), "left_semi")
    nth = F.row_number().over(Window.partitionBy("doc", "own").orderBy(F.lit(0)))
    return untucked(first.withColumn("nth", nth).where("nth = 1"), docs.columns)
