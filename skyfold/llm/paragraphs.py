"""Removal of paragraphs and sentences that stand in the corpus before.

The units of a text are its paragraphs (lines) and, in a paragraph of several sentences,
the sentences.  Equal units are brought together by their hash.  Near copies of
paragraphs are found by MinHash: two that share ``LIKE`` of their shingles of five
words agree in a band of ``ROWS`` minima with a chance of LIKE ** ROWS, so that with
``BANDS`` bands 99.4 of 100 such pairs meet.  Those that collide are compared exactly, by the
Jaccard similarity of their sets of shingles, and the links' components are the
clusters: of each the first unit in the corpus stays, the others go.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.llm.common import Sieve, components, lots, stored, tucked, untucked, valid

WORDS = 5
LIKE = 0.8
ROWS, BANDS = 2, 5
#: Bands that there are multipliers for.
MOST_BANDS = 10
#: Paragraphs of a bucket that one task compares at most; larger buckets are cut into blocks of half as many.
BLOCK = 512
#: Words whose hashes a worker keeps.
KEPT_WORDS = 1 << 18
#: Rows of output held at once.
OUT = 1 << 15
#: Bytes of the texts that are cut into words together.
LETTERS = 1 << 21

_MULTIPLIERS = np.random.default_rng(4).integers(1, 2**62, ROWS * MOST_BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A mark that ends a sentence, and the white space behind it.
_END = re.compile(r"[.!?]\s+")
_MARKS = np.frombuffer(b".!?", np.uint8)
#: White space beyond ASCII, none of it above U+3000, and in ASCII.
_WIDE = re.compile("[" + "".join(chr(c) for c in range(0x80, 0x3001) if chr(c).isspace()) + "]")
_BLANK = bytes(c for c in range(0x80) if chr(c).isspace())
_IS_BLANK = bytes(c in _BLANK for c in range(256))


class Unit:
    """A stretch of a text: a paragraph, or a sentence of one."""

    __slots__ = ("start", "end", "line", "words", "raw")

    def __init__(self, start: int, end: int, line: int, words: list[str], raw: str = ""):
        self.start, self.end, self.line, self.words, self.raw = start, end, line, words, raw


def units(text: str) -> tuple[list[Unit], list[list[Unit]]]:
    """The paragraphs, and the sentences of each, those that have words."""
    lines, sentences, at = [], [], 0
    for raw in text.split("\n"):
        own, start = [], 0
        for end in [*(m.end() for m in _END.finditer(raw)), len(raw)]:
            piece = raw[start:end]
            if words := piece.lower().split():
                begin = at + end - len(piece.lstrip())
                own.append(Unit(begin, at + start + len(piece.rstrip()), len(lines), words))
            start = end
        if own:
            lines.append(Unit(own[0].start, own[-1].end, len(lines), [w for s in own for w in s.words] if len(own) > 1 else own[0].words, raw))
            sentences.append(own)
        at += len(raw) + 1
    return lines, sentences


class _Words(dict):
    """Word to its hash; as many as a worker keeps before it starts anew."""

    def __missing__(self, word: str) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


_WORDS = _Words()


def _numbers(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def _unit(numbers: np.ndarray) -> int:
    """The hash of a unit from those of its words, as a signed long."""
    return xxhash.xxh64_intdigest(numbers.tobytes(), 1) - (1 << 63)


def _hash(words: list[str]) -> int:
    return _unit(_numbers(words))


def _raw(part: bytes) -> int:
    return xxhash.xxh3_64_intdigest(part, 2) - (1 << 63)


def raw_hash(part: str) -> int:
    """The hash of a stretch of text as it stands, which needs no words."""
    return _raw(part.encode("utf-8", "surrogatepass"))


def _rolled(numbers: np.ndarray) -> np.ndarray:
    """Hashes of every five words in a row."""
    total = numbers[: len(numbers) - WORDS + 1].copy()
    for k in range(1, WORDS):
        total = total * np.uint64(0x9E3779B97F4A7C15) + numbers[k : len(numbers) - WORDS + 1 + k]
    return total ^ total >> np.uint64(29)


def shingles(words: list[str]) -> np.ndarray:
    """The set of hashes of the shingles of a paragraph of five words or more, in order."""
    return np.unique(_rolled(_numbers(words)))


def bands(found: np.ndarray, starts: np.ndarray, ends: np.ndarray, count: int = BANDS) -> np.ndarray:
    """For each stretch of shingles a key for each band of minima."""
    edges = np.stack([starts, ends], axis=1).ravel()
    padded = np.append(found, np.uint64(0))
    keys = np.zeros((len(starts), count), np.uint64)
    for k in range(count):
        for j in range(ROWS):
            mixed = padded * _MULTIPLIERS[k * ROWS + j]
            mixed ^= mixed >> np.uint64(32)
            keys[:, k] = keys[:, k] * np.uint64(0xD6E8FEB86659FD93) + np.minimum.reduceat(mixed, edges)[::2]
    return (keys ^ np.arange(count, dtype=np.uint64)).view(np.int64)


def _out(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, so many at a time that their texts, in the last column, have about ``LETTERS`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
        lot = np.cumsum(sizes, dtype=np.int64) // LETTERS
        cuts = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), batch.num_rows]
        for first, last in zip(cuts, cuts[1:], strict=False):
            if last > first:
                yield batch.slice(first, last - first)


def _edges(text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The text as UTF-8, each white space one byte of it, and where its words start and end there."""
    data = (text if text.isascii() else _WIDE.sub(" ", text)).encode("utf-8", "surrogatepass")
    turns = np.flatnonzero(np.diff(np.frombuffer(data.translate(_IS_BLANK), np.bool_), prepend=True, append=True))
    return data, turns[::2], turns[1::2]


def _numbered(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of all words, those of ``_numbers``; each distinct word is hashed once."""
    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
    letters = pa.py_buffer(data.translate(None, _BLANK))
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), letters]).dictionary_encode()
    each = np.fromiter(map(xxhash.xxh64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return each[words.indices.to_numpy()]


def _places(data: bytes, at: np.ndarray) -> np.ndarray:
    """The characters before each of these bytes."""
    if data.isascii():
        return at
    inner = np.frombuffer(data, np.int8) < -64
    return at - np.append(0, np.cumsum(inner))[at]


def _units(numbers: np.ndarray, firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """``_unit`` of each stretch of words."""
    whole = memoryview(numbers).cast("B")
    pairs = zip((8 * firsts).tolist(), (8 * lasts).tolist(), strict=True)
    found = np.fromiter((xxhash.xxh64_intdigest(whole[a:b], 1) for a, b in pairs), np.uint64, len(firsts))
    return (found ^ np.uint64(1 << 63)).view(np.int64)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The units of ``units``, of many texts at once: all are cut into words together."""
    names = ["unit", "raw", "doc", "own", "at", "keys"]
    for batch in _stretches(batches):
        texts = [text or "" for text in batch.column(2).to_pylist()]
        joined = "\n".join(texts)
        data, starts, ends = _edges(joined)
        if not len(starts):
            continue
        numbers = _numbered(*_edges(joined.lower()))
        letters = np.frombuffer(data, np.uint8)
        line = np.searchsorted(np.flatnonzero(letters == ord("\n")), starts)
        opens = np.append(True, line[1:] != line[:-1])
        firsts = np.flatnonzero(opens)
        lasts = np.append(firsts[1:], len(starts))
        # A sentence starts a line or follows a word with a mark at its end.
        heads = np.flatnonzero(opens | np.append(True, np.isin(letters[ends[:-1] - 1], _MARKS)))
        tails = np.append(heads[1:], len(starts))
        of = np.searchsorted(firsts, heads, "right") - 1
        own = (tails - heads >= WORDS) & (np.bincount(of)[of] > 1)
        heads, tails = heads[own], tails[own]
        # Fewer words than a shingle: only equal ones count, and only as whole paragraphs.
        whole = lasts - firsts >= WORDS
        keys = bands(_rolled(numbers), firsts[whole], lasts[whole] - WORDS + 1) if whole.any() else np.zeros((0, BANDS), np.int64)
        raws = joined.encode("utf-8", "surrogatepass").split(b"\n")
        raw = np.zeros(len(firsts) + len(heads), np.int64)
        raw[: len(firsts)][whole] = [_raw(raws[k]) for k in line[firsts[whole]].tolist()]
        judged = np.append(whole, np.zeros(len(heads), bool))
        bases = np.append(0, np.cumsum([len(text) + 1 for text in texts]))
        places = _places(data, starts[np.append(firsts, heads)])
        doc = np.searchsorted(bases, places, "right") - 1
        at = 2 * (places - bases[doc])
        at[len(firsts) :] += 1
        rows = pa.array(doc)
        edges = np.append(0, np.cumsum(judged * BANDS)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(_units(numbers, firsts, lasts), _units(numbers, heads, tails))),
                pa.array(raw, mask=~judged),
                batch.column(0).take(rows),
                batch.column(1).take(rows),
                pa.array(at.astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(edges), pa.array(keys.ravel())),
            ],
            names,
        )


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of rows with equal ``key``, ``i``, ``j``; as many as connect what all links connect."""
    held: dict[int, np.ndarray] = {}
    last, out = None, []
    for batch in batches:
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
        for own, unit, found in zip(keys, batch.column(3).to_pylist(), batch.column(4), strict=True):
            if own != last:
                out += _forest(held)
                held, last = {}, own
            held[unit] = np.frombuffer(found.as_buffer(), np.uint64)
        if len(out) >= OUT:
            yield _out(out, ["a", "b"], [pa.int64(), pa.int64()])
            out = []
    out += _forest(held)
    if out:
        yield _out(out, ["a", "b"], [pa.int64(), pa.int64()])


def _forest(members: dict[int, np.ndarray]) -> list[tuple[int, int]]:
    rest = sorted(members)
    links = []
    while rest:
        reached, rest = [rest[0]], rest[1:]
        while reached and rest:
            one = reached.pop()
            mine, still = members[one], []
            for other in rest:
                theirs = members[other]
                small, large = sorted((len(mine), len(theirs)))
                if small >= LIKE * large:
                    # Each is a set in order: what stands twice in a row is in both.
                    all_of = np.concatenate((mine, theirs))
                    all_of.sort(kind="stable")
                    both = np.count_nonzero(all_of[1:] == all_of[:-1])
                    if both >= LIKE * (small + large - both) - 1e-9:
                        links.append((one, other))
                        reached.append(other)
                        continue
                still.append(other)
            rest = still
    return links


def _lines(text: str) -> list[str]:
    return text.split("\n")


def near(found: DataFrame, source: DataFrame, parts: Callable[[str], list[str]] = _lines) -> DataFrame:
    """Links between distinct units that are alike; ``parts`` cuts a text into those that are units.

    The shingles of a unit are made from one of the ways in which it is written, the one with the
    least ``raw`` hash; texts are read again for those only, and not split into words to find them.
    """
    keyed = found.select("unit", "raw", F.explode("keys").alias("key")).groupBy("unit", "key").agg(F.min("raw").alias("raw"))
    sizes = keyed.groupBy("key").count().where("count > 1").select("key", F.ceil(F.col("count") / (BLOCK // 2)).cast("int").alias("blocks"))
    met = stored(keyed.join(sizes, "key"), "buckets")
    sieve = Sieve(met.select("raw"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _stretches(batches):
            own = [part for text in batch.column(1).to_pylist() for part in parts(text or "")]
            asked = np.flatnonzero(sieve.may_hold(np.fromiter(map(raw_hash, own), np.int64, len(own))))
            bodies = [own[k].lower() for k in asked.tolist()]
            data, starts, ends = _edges("\n".join(bodies))
            numbers = _numbered(data, starts, ends)
            edges = np.searchsorted(_places(data, starts), np.append(0, np.cumsum([len(body) + 1 for body in bodies])))
            whole = np.diff(edges) >= WORDS
            if whole.any():
                firsts, lasts, rolled = edges[:-1][whole], edges[1:][whole], _rolled(numbers)
                found = [np.unique(rolled[a:b]).tobytes() for a, b in zip(firsts.tolist(), (lasts - WORDS + 1).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(_units(numbers, firsts, lasts)), pa.array(found, pa.binary())], ["unit", "found"])

    # Copies of a paragraph have the same set: one is kept before they are sent.
    known = source.mapInArrow(sets, "unit long, found binary").groupBy("unit").agg(F.min("found").alias("found"))
    dealt = met.withColumn("block", F.pmod(F.xxhash64("unit"), "blocks").cast("int"))
    dealt = dealt.select("key", "unit", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "unit").join(known, "unit")
    dealt = dealt.select("key", "i", "j", "unit", "found").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(_compared, "a long, b long")


def _own(docs: DataFrame, text: str) -> Column:
    return F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("own")


def repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc``, ``own`` and ``lost``, the units of it that stand in the corpus before, for each document that has any.

    A document is told apart by its id and the hash of its text, so that many rows
    without an id, or with one and the same, are as many documents and never one group.
    A unit is its place (twice its first character, and one more for a sentence) and its
    hash.  The order of the corpus is that of document ids, null first, then that of
    the texts' hashes, then that of places.
    """
    source = docs.select(docs[id_column].cast("long").alias("doc"), _own(docs, text), valid(docs[text]).alias("text"))
    found = stored(source.mapInArrow(_occurrences, "unit long, raw long, doc long, own long, at int, keys array<long>"), "units")
    linked = components(near(found, source.select("doc", "text")))
    first = found.groupBy("unit").agg(F.min(F.struct("doc", "own", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
    placed = first.join(linked.withColumnRenamed("node", "unit"), "unit", "left").withColumn("cluster", F.coalesce("component", "unit"))
    # Only a unit that is linked or occurs again can lose an occurrence.
    placed = stored(placed.where("n > 1 OR component IS NOT NULL").select("unit", "cluster", "first"), "clusters")
    heads = placed.groupBy("cluster").agg(F.min("first").alias("head"))
    judged = placed.select("unit", "cluster").join(heads, "cluster").select("unit", "head")
    again = found.select("unit", "doc", "own", "at").join(judged, "unit").where(~F.struct("doc", "own", "at").eqNullSafe(F.col("head")))
    return again.groupBy("doc", "own").agg(F.collect_set(F.struct("at", "unit")).alias("lost"))


def without(text: str, lost: set[tuple[int, int]]) -> str:
    """The text less these units: whole paragraphs with their line break, else sentences.

    A sentence that is too short to be judged goes if those on both sides go.
    """
    places = {at for at, _ in lost}
    inner = sorted(at >> 1 for at in places if at & 1)
    gone: list[tuple[int, int]] = []
    at = 0
    # Only paragraphs that are named, or hold a sentence that is, are split into words.
    for raw in text.split("\n"):
        start, after = at + len(raw) - len(raw.lstrip()), at + len(raw)
        if start < after and 2 * start in places and (2 * start, _hash(raw.lower().split())) in lost:
            gone.append((start, at + len(raw.rstrip())))
        elif bisect.bisect_left(inner, start) < bisect.bisect_left(inner, after):
            for own in units(raw)[1]:
                out = [2 * (at + s.start) + 1 in places and (2 * (at + s.start) + 1, _hash(s.words)) in lost for s in own]
                for k, s in enumerate(own):
                    between = len(s.words) < WORDS and 0 < k < len(own) - 1 and out[k - 1] and out[k + 1]
                    if out[k] or between:
                        gone.append((at + s.start, at + s.end))
        at = after + 1
    kept, at = [], 0
    for start, end in gone:
        kept.append(text[at:start])
        at = end + len(text[end:]) - len(text[end:].lstrip(" \t")) if end < len(text) and text[end] in " \t" else end
        if (not start or text[start - 1] == "\n") and text[at : at + 1] == "\n":
            at += 1
    return "".join([*kept, text[at:]])


def cleaned(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The documents, all columns, less every unit that stands in the corpus before; ``text`` is what is left.

    Null texts stay null and empty ones empty.  Rows that share an id, or
    have none, are documents of their own if their texts differ; rows that share both
    are one, and stay alike.  A
    sentence inside a paragraph that goes as a near copy counts as an occurrence.  An
    empty table stays empty.  Documents that lose nothing are not shuffled.
    """
    lost = stored(repeats(docs, text, id_column), "repeats").withColumnsRenamed({"doc": "met", "own": "same"})
    sieve = Sieve(lost.select("same"))

    @F.pandas_udf("boolean")
    def may_lose(own: pd.Series) -> pd.Series:
        return pd.Series(sieve.may_hold(own.to_numpy(np.int64)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lots(batches):
            bodies = batch.column(1).to_pylist()
            found = batch.column(2)
            # The lists' edges within all their values; a null list has none.
            edges = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)))
            values = found.flatten()
            pairs = list(zip(values.field("at").to_pylist(), values.field("unit").to_pylist(), strict=True))
            for k in np.flatnonzero(np.diff(edges)).tolist():
                if bodies[k]:
                    bodies[k] = without(bodies[k], set(pairs[edges[k] : edges[k + 1]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.string())], ["row", "body"])

    # The text itself goes on as ``body`` alone.
    whole = docs.select(tucked(docs, text), docs[id_column].cast("long").alias("doc"), _own(docs, text), valid(docs[text]).alias("body"))
    whole = whole.withColumn("asked", may_lose("own"))
    met = whole.where("asked").join(lost, (F.col("own") == F.col("same")) & F.col("doc").eqNullSafe(F.col("met")), "left").select("row", "body", "lost")
    done = met.mapInArrow(cut, T.StructType([whole.schema["row"], whole.schema["body"]]))
    return untucked(done.unionByName(whole.where("NOT asked").select("row", "body")), docs.columns, **{text: F.col("body")})
