"""Near copies by 64-bit fingerprints of word shingles.

A fingerprint is eight bytes, each at its position.  Two that differ in at most three
bits differ in at most three bytes, so they share at least five positional bytes,
and at least three of them lie among the first four positions or among the last
four.  The inverted index therefore has postings for the eight triples of positions
within either half.  In a posting the shared positional bytes of each pair are
tallied, pairs with five or more are verified bit by bit, and what leaves the task is
a spanning forest of the links: as many rows as fingerprints, however many pairs link.
A posting that is too long for a task is cut into blocks, and every two blocks meet.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import batched, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.common import components, stored, tucked, untucked, valid

#: Fingerprints of a posting that one task holds twice at most; longer postings are cut into blocks.
BLOCK = 2048
SEED = 42
BITS = 3
#: Bytes that fingerprints within ``BITS`` share at least, and the triples of positions of which they share one.
SHARED = 8 - BITS
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
#: Shingles whose bits are counted at once.
LOT = 1 << 14


def fingerprint(text: str | None, words: int = 3) -> int:
    """The bits that are set in over half the hashes of the shingles, repeats included.

    Letters A to Z are lower-cased, words stand between ASCII white space; a text of
    fewer words is one shingle, one without words has fingerprint zero, and null
    counts as empty.
    """
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return 0
    shingles = map(b" ".join, zip(*(own[k:] for k in range(words)), strict=False)) if len(own) >= words else [b" ".join(own)]
    total = np.zeros(64, np.int64)
    digest = functools.partial(xxhash.xxh64_intdigest, seed=SEED)
    for lot in batched(shingles, LOT):
        hashes = np.fromiter(map(digest, lot), np.uint64, len(lot))
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > max(1, len(own) - words + 1)).view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = 3, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``fp`` (the bits as a signed long) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])

    return docs.select(docs[id_column].cast("long").alias("doc_id"), valid(docs[text]).alias("text")).mapInArrow(run, "doc_id long, fp long")


def _forest(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what links within ``BITS`` connect, one fewer than the members of each component."""
    rest, left, right = np.arange(len(values)), [], []
    as_bytes = values.view(np.uint8).reshape(-1, 8)
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            one = reached.pop()
            shared = (as_bytes[rest] == as_bytes[one]).sum(axis=1)
            near = (shared >= SHARED) & (np.bitwise_count(values[rest] ^ values[one]) <= BITS)
            found = rest[near]
            left.append(np.full(len(found), values[one]))
            right.append(values[found])
            reached.extend(found)
            rest = rest[~near]
    return (np.concatenate(left), np.concatenate(right)) if left else (values[:0], values[:0])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of rows with equal ``posting``, ``i``, ``j``; rows come in that order."""
    held, key = [], None

    def flush() -> Iterator[pa.RecordBatch]:
        a, b = _forest(np.unique(np.concatenate(held)))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        posting, i, j = (batch.column(k).to_numpy() for k in range(3))
        values = batch.column(3).to_numpy().view(np.uint64)
        cuts = np.flatnonzero((np.diff(posting) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        pairs_a, pairs_b = [], []
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True):
            own = (posting[start], i[start], j[start])
            if own != key:
                if held:
                    yield from flush()
                held, key = [], own
            held.append(values[start:stop])
            if stop < len(values) and len(held) == 1 and stop - start == 2:  # most postings: one pair
                if np.bitwise_count(held[0][0] ^ held[0][1]) <= BITS:
                    pairs_a.append(held[0][0])
                    pairs_b.append(held[0][1])
                held, key = [], None
        if pairs_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (pairs_a, pairs_b)], ["a", "b"])
    if held:
        yield from flush()


def links(distinct: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` with the components that all links within ``BITS`` have."""

    def part(position: int) -> F.Column:
        return F.shiftrightunsigned("fp", 56 - 8 * position).bitwiseAND(F.lit(255).cast("long"))

    keys = [functools.reduce(lambda x, p: F.shiftleft(x, 8).bitwiseOR(part(p)), t, F.lit(k).cast("long")) for k, t in enumerate(TRIPLES)]
    postings = distinct.select("fp", F.explode(F.array(*keys)).alias("posting"))
    sizes = postings.groupBy("posting").count().where("count > 1").select("posting", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    member = postings.join(sizes, "posting").withColumn("block", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    met = member.select("posting", "block", "fp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("posting", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "fp")
    dealt = met.repartition("posting", "i", "j").sortWithinPartitions("posting", "i", "j")
    return dealt.mapInArrow(_links, "a long, b long")


def groups(docs: DataFrame, words: int = 3, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest document id that links reach.

    Fingerprint zero links like any other.  Repeated rows stay; a null document id is
    the component's only where there is no other.  An empty table gives no rows.
    """
    found = stored(fingerprints(docs, words, text, id_column), "fingerprints")
    distinct = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = components(links(distinct.select("fp")))
    placed = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.join(placed.select("fp", "component").join(least, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def hexadecimal(column: str) -> F.Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def first_of_each_group(docs: DataFrame, words: int = 3) -> DataFrame:
    """The documents that stay: of each component the row with the smallest id.

    All columns are kept.  Of rows that share the id, the first by its text stays; rows
    without an id stay, for nothing tells them apart.
    """
    known = docs.where("doc_id IS NOT NULL")
    member = groups(known, words).where("doc_id = component_id").select("doc_id").distinct()
    whole = known.select(tucked(known), "doc_id", "text")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    first = whole.join(member, "doc_id", "left_semi").withColumn("nth", nth).where("nth = 1")
    return untucked(first, docs.columns).unionByName(docs.where("doc_id IS NULL"))
