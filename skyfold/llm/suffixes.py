"""Removal of every string of ``LENGTH`` bytes that occurs more than once in the corpus.

No suffix array of a whole corpus fits a task, so the corpus is cut where equal strings are
cut alike.  Of the grams in a window of ``LENGTH`` bytes the leftmost with the least hash is
its anchor: equal windows have equal anchors at the same place, and the windows of one
anchor follow each other.  Windows can therefore only be equal if their anchors are, and
most grams occur once and are done with.

Around an anchor the windows are taken in blocks of ``BLOCK``.  All windows of a block
share its core, so equal windows lie in blocks with equal cores.  A block is then a short
text: the bytes that only its first windows have, its core as a single symbol, and the
bytes that only its last ones have.  Copies of a text are stored once with
their number.  Texts with one core go to one task, which builds their suffix array by
Lyndon grouping: in it, equal windows are neighbours that agree in their first
``BLOCK`` symbols, and a window is repeated if such neighbours stand for more than one
occurrence.  A core with more than ``MANY`` different texts would be too much for a task; the windows of its texts
are counted each by itself instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm.common import Sieve, stored
from skyfold.llm.lyndon import suffix_array

LENGTH = 200
GRAM = 50
BLOCK = 16
#: Different texts of one core that go to a task, and symbols that it sorts at once.
MANY = 4096
SYMBOLS = 1 << 15
#: Windows looked at together, and rows of output held.
STRETCH = 1 << 20
OUT = 1 << 15

_TABLE = np.random.default_rng(1).integers(1, 2**62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_STEP, STRETCH + 2 * LENGTH)
_BACK = _powers(pow(_STEP, -1, 1 << 64), STRETCH + 2 * LENGTH)


def _grams(found: np.ndarray) -> np.ndarray:
    """A hash of each ``GRAM`` bytes, from sums of the bytes' hashes times powers."""
    total = np.zeros(len(found) + 1, np.uint64)
    np.cumsum(_TABLE[found] * _POWERS[: len(found)], out=total[1:])
    mixed = (total[GRAM:] - total[:-GRAM]) * _BACK[: len(found) - GRAM + 1]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ mixed >> np.uint64(29)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` values in a row, from running minima to both sides within stretches of ``width``."""
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max)
    padded[: len(values)] = values
    grid = padded.reshape(rows, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def anchors(body: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Gram hash, place, first and last window of each anchor of a text, in stretches of it."""
    every = np.frombuffer(body, np.uint8)
    for start in range(0, len(body) - LENGTH + 1, STRETCH):
        part = every[start : start + STRETCH + LENGTH - 1]
        grams = _grams(part)
        keyed = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        place = (_least(keyed, LENGTH - GRAM + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(first[1:], len(place)) - 1
        at = place[first]
        yield grams[at].view(np.int64), at + start, first + start, last + start


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(j)[k] for j, c in enumerate(batch.schema.names)}


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each anchor: its gram, a hash of all that its windows cover, and where they are."""
    names = ["gram", "around", "doc", "mix", "low", "left", "more"]
    for row in _rows(batches):
        body = row["text"].as_py()
        view = memoryview(body)
        for gram, at, first, last in anchors(body):
            around = [xxhash.xxh3_64_intdigest(view[a : b + LENGTH], p - a) for a, b, p in zip(first.tolist(), last.tolist(), at.tolist(), strict=True)]
            n = len(gram)
            cells = [pa.array(gram), pa.array(np.array(around, np.uint64).view(np.int64)), pa.array([row["doc"].as_py()] * n, pa.int64()), pa.array(np.full(n, row["mix"].as_py()))]
            yield pa.RecordBatch.from_arrays([*cells, pa.array(first), pa.array((at - first).astype(np.int16)), pa.array((last - first).astype(np.int16))], names)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block of an anchor's windows: a hash of its core, the bytes beside the core, and where its windows are."""
    names = ["core", "left", "right", "weight", "doc", "mix", "low"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    rows: list[tuple] = []
    for row in _rows(batches):
        body = row["text"].as_py()
        doc, mix = row["doc"].as_py(), row["mix"].as_py()
        for one in row["around"].as_py():
            at, low, high = one["low"] + one["left"], one["low"], one["low"] + one["more"]
            for k in range((at - high) // BLOCK, (at - low) // BLOCK + 1):
                end = at - k * BLOCK
                start = end - BLOCK + 1
                first, last = max(low, start), min(high, end)
                core = xxhash.xxh3_64_intdigest(body[end : start + LENGTH], k) - (1 << 63)
                rows.append((core, body[first:end], body[start + LENGTH : last + LENGTH], one["n"], doc, mix, first))
        if len(rows) >= OUT:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def repeated(texts: list[tuple[int, bytes, bytes, int]]) -> list[np.ndarray]:
    """For each text (core, bytes before, bytes behind, number of copies) its repeated windows, by place in the text.

    A text with b bytes behind the core has windows that end with the core's symbol and 0 to b
    bytes more; its j-th window has ``BLOCK`` symbols from the j-th on.
    """
    symbols: list[int] = []
    owner: list[int] = []
    numbers: dict[int, int] = {}
    for k, (core, left, right, _) in enumerate(texts):
        own = [*(1 + b for b in left), numbers.setdefault(core, 257 + len(numbers)), *(1 + b for b in right), 0]
        symbols += own
        owner += [k] * len(own)
    order = np.array(suffix_array(symbols), np.int64)
    padded = np.array(symbols + [-1] * BLOCK, np.int64)
    whose = np.array(owner, np.int64)
    begin = np.searchsorted(whose, np.arange(len(texts)))
    ends = np.append(begin[1:], len(symbols)) - 1
    # A window starts where ``BLOCK`` symbols follow in its own text.
    order = order[order + BLOCK <= ends[whose[order]]]
    if not len(order):
        return [np.zeros(0, np.int64) for _ in texts]
    same = np.ones(len(order) - 1, bool)
    for j in range(BLOCK):
        same &= padded[order[1:] + j] == padded[order[:-1] + j]
    run = np.cumsum(np.append(0, ~same))
    times = np.bincount(run, np.array([t[3] for t in texts])[whose[order]])
    found = order[times[run] > 1]
    return [np.sort(found[whose[found] == k]) - begin[k] for k in range(len(texts))] if len(texts) < 64 else _by_text(found, whose, begin)


def _by_text(found: np.ndarray, whose: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    found = np.sort(found)
    cuts = np.searchsorted(whose[found], np.arange(1, len(begin)))
    return [part - start for part, start in zip(np.split(found, cuts), begin, strict=True)]


def _sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that are repeated, from rows in the order of their cores; only texts with one copy are asked about."""
    names, kinds = ["doc", "mix", "low", "high"], [pa.int64()] * 4
    groups: dict[int, dict[tuple[bytes, bytes], list]] = {}
    size, out = 0, []

    def solve() -> None:
        texts = [(core, *text, sum(r[0] for r in rows)) for core, found in groups.items() for text, rows in found.items()]
        # A core with one text needs no order: its windows occur as often as the text.
        alone = {core for core, found in groups.items() if len(found) == 1}
        several = [t for t in texts if t[0] not in alone]
        windows = dict(zip(((t[0], t[1], t[2]) for t in several), repeated(several), strict=True)) if several else {}
        for core, left, right, n in texts:
            if core in alone:
                hits = np.arange(len(left) + len(right) + 2 - BLOCK) if n > 1 else np.zeros(0, np.int64)
            else:
                hits = windows[core, left, right]
            if not len(hits):
                continue
            cuts = np.flatnonzero(np.diff(hits) > 1)
            spans = list(zip(hits[np.append(0, cuts + 1)].tolist(), hits[np.append(cuts, len(hits) - 1)].tolist(), strict=True))
            for weight, doc, mix, low in groups[core][left, right]:
                if weight == 1:
                    out.extend((doc, mix, low + a, low + b) for a, b in spans)

    for batch in batches:
        for core, left, right, weight, doc, mix, low in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if core not in groups:
                if size >= SYMBOLS:
                    solve()
                    groups, size = {}, 0
                groups[core] = {}
            found = groups[core].setdefault((left, right), [])
            size += 0 if found else len(left) + len(right) + 2
            found.append((weight, doc, mix, low))
        if len(out) >= OUT:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
            out = []
    solve()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _asked(column: str, sieve: Sieve) -> Column:
    @F.pandas_udf("boolean")
    def may_be(values: pd.Series) -> pd.Series:
        return pd.Series(sieve.may_hold(values.to_numpy(np.int64)))

    return may_be(column)


def _single_windows(wide: DataFrame) -> DataFrame:
    """The repeated windows of texts whose core has very many: each window is counted by itself."""
    last = F.length("left") + F.length("right") + 1 - BLOCK
    each = wide.withColumn("j", F.explode(F.sequence(F.lit(0), last)))
    # The j-th window has the bytes before the core from the j-th on, and as many behind it as fill the block.
    before = F.expr("substring(left, j + 1, length(left) - j)")
    behind = F.expr(f"substring(right, 1, {BLOCK} - 1 - (length(left) - j))")
    each = each.select("core", before.alias("l"), behind.alias("r"), "weight", "doc", "mix", (F.col("low") + F.col("j")).alias("low"))
    counts = each.groupBy("core", "l", "r").agg(F.sum("weight").alias("n")).where("n > 1").drop("n")
    return each.where("weight = 1").join(counts, ["core", "l", "r"]).select("doc", "mix", "low", F.col("low").alias("high"))


def windows(source: DataFrame) -> DataFrame:
    """``doc``, ``mix``, ``low``, ``high``: runs of starts of repeated windows, for texts with these two keys."""
    found = stored(source.mapInArrow(_occurrences, "gram long, around long, doc long, mix long, low long, left short, more short"), "anchors")
    grams = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("around").alias("a"), F.max("around").alias("b"))
    again = stored(grams.where("n > 1").select("gram", (F.col("a") == F.col("b")).alias("alike")), "grams")
    met = stored(found.where(_asked("gram", Sieve(again.select("gram")))).join(again, "gram"), "repeated-anchors")
    spans = lambda df: df.select("doc", "mix", "low", (F.col("low") + F.col("more")).alias("high"))
    several = met.where("NOT alike")
    place = F.struct("doc", "mix", "low", "left", "more")
    distinct = stored(several.groupBy("gram", "around").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p")), "surroundings")
    copies = several.join(distinct.where("n > 1").select("gram", "around"), ["gram", "around"])
    asked = distinct.select("p.*", "n").groupBy("doc", "mix").agg(F.collect_list(F.struct("low", "left", "more", "n")).alias("around"))
    asked = stored(asked, "asked").withColumnsRenamed({"doc": "_doc", "mix": "_mix"})
    texts = source.where(_asked("mix", Sieve(asked.select("_mix")))).dropDuplicates(["doc", "mix"])
    texts = texts.join(asked, (texts["doc"] == F.col("_doc")) & (texts["mix"] == F.col("_mix"))).select("doc", "mix", "text", "around")
    blocks = stored(texts.mapInArrow(_blocks, "core long, left binary, right binary, weight long, doc long, mix long, low long"), "blocks")
    cores = blocks.groupBy("core").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("texts")).where("n > 1").select("core", "texts")
    cores = stored(cores, "cores")
    kept = blocks.where(_asked("core", Sieve(cores.select("core")))).join(cores, "core")
    columns = ["core", "left", "right", "weight", "doc", "mix", "low"]
    narrow = kept.where(F.col("texts") <= MANY).select(columns).repartition("core").sortWithinPartitions("core")
    sorted_ = narrow.mapInArrow(_sorted_windows, "doc long, mix long, low long, high long")
    wide = _single_windows(stored(kept.where(F.col("texts") > MANY).select(columns), "wide-cores"))
    return spans(met.where("alike")).unionByName(spans(copies)).unionByName(sorted_).unionByName(wide)


def _covered(found: list[dict]) -> tuple[list[int], list[int]]:
    """Maximal runs of bytes under windows that start in these runs."""
    starts, ends = [], []
    for low, high in sorted((x["low"], x["high"]) for x in found):
        if ends and low <= ends[-1]:
            ends[-1] = max(ends[-1], high + LENGTH)
        else:
            starts.append(low)
            ends.append(high + LENGTH)
    return starts, ends


def cleaned(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` (start and end of each maximal run of removed bytes) and ``kept`` (the bytes left).

    Matches never cross documents; strings are judged on the input, as bytes, valid UTF-8 or not.  Null texts count as
    empty, and no string of them or of shorter texts is long enough.  Repeated rows are
    documents of their own, so that all of a long one goes; null ids are kept.  An empty
    table gives no rows.
    """
    name, body = docs[id_column].cast("long"), F.coalesce(docs[text].cast("binary"), F.lit(b""))
    # Rows with one id and one text have the same repeats, so these two share a key: 128 bits of hashes
    # of both, which tell texts under one id apart however many they are.
    source = docs.select(name.alias("doc_id"), F.xxhash64(name, body).alias("doc"), F.xxhash64(F.lit(1), body, name).alias("mix"), body.alias("text"))
    lost = windows(source).groupBy("doc", "mix").agg(F.collect_list(F.struct("low", "high")).alias("lost"))
    lost = stored(lost, "repeats").withColumnsRenamed({"doc": "_doc", "mix": "_mix"})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            whole = row["text"].as_py()
            starts, ends = _covered(row["lost"].as_py() or [])
            kept = b"".join(whole[a:b] for a, b in zip([0, *ends], [*starts, len(whole)], strict=True))
            cells = [[row["doc_id"].as_py()], [len(whole)], [[{"start": a, "end": b} for a, b in zip(starts, ends, strict=True)]], [kept]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, kinds, strict=True)], names)

    names = ["doc_id", "n_bytes", "spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
    schema = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    marked = source.withColumn("_met", _asked("mix", Sieve(lost.select("_mix"))))
    met = marked.where("_met").join(lost, (F.col("doc") == F.col("_doc")) & (F.col("mix") == F.col("_mix")), "left")
    whole = F.col("text")
    rest = marked.where("NOT _met").select("doc_id", F.length(whole).cast("long").alias("n_bytes"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"), whole.alias("kept"))
    return met.select("doc_id", "text", "lost").mapInArrow(cut, schema).unionByName(rest)
