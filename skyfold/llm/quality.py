"""A filter of junk documents that learns from heuristic labelers alone.

Each labeler looks at one share of a document (words that end in runs of marks, words
without letters, capitals, repeated words and lines, and so on) and votes for it, against it or
not at all.  The labelers overlap; expectation maximisation over the counts of vote
patterns estimates how often each votes either way on good and on bad documents.
The posteriors of a bounded sample then train a linear scorer over hashed features, which
are the shapes of words and of neighbouring words, and the shares in steps; the scorer
decides on every document.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.llm import weak
from skyfold.llm.common import lots, stored, tucked, untucked, valid

#: Labelers: the share each looks at, from which it votes against, and below which it votes for.
LABELERS = (
    ("marks", 0.2, 0.05),
    ("bare", 0.2, 0.05),
    ("capitals", 0.5, 0.2),
    ("repeats", 0.2, 0.05),
    ("sameness", 0.6, 0.4),
    ("lines", 0.5, 0.3),
    ("oddities", 0.25, 0.2),
    ("long", 0.05, 0.01),
)
#: Slots of hashed features, and documents in the training sample at most: the parameters that bound what the driver gets.
SLOTS = 2048
SAMPLE = 4000
#: Score from which a document is kept.
KEEP = 0.5
#: What is taken for granted of a labeler, as if it had voted on ten documents of either class: against good
#: ones it votes in one of two hundred cases, so that a rare pattern is not called good on the strength of its own few documents.
PRIOR = {True: {"+": 9.0, "0": 0.95, "-": 0.05}, False: {"+": 6.0, "0": 1.5, "-": 2.5}}
#: Words in a stretch whose distinct words are counted.
STRETCH = 50
STEPS, RATE, RIDGE = 400, 4.0, 1e-4

_LETTER, _CAPITAL, _DIGIT, _OTHER = (ord(c) for c in "aA9m")


class _Shapes(dict):
    """Code point to the byte of its class: letters, capitals, digits; white space and ASCII marks stand for themselves."""

    def __missing__(self, point: int) -> int:
        c = chr(point)
        if c.isspace():
            out = 0x0A if c == "\n" else 0x20
        elif c.isalpha():
            out = _CAPITAL if c.isupper() else _LETTER
        elif c.isdigit():
            out = _DIGIT
        else:
            out = point if point < 0x7F else _OTHER
        self[point] = out
        return out


_SHAPES = _Shapes()


def shares(text: str, shape: bytes) -> list[float]:
    """The share that each labeler looks at; zero for an empty text."""
    words = text.split()
    if not words:
        return [0.0] * len(LABELERS)
    letters = np.frombuffer(shape, np.uint8)
    letter, capital = (letters == _LETTER) | (letters == _CAPITAL), letters == _CAPITAL
    mark = ~letter & (letters != _DIGIT) & (letters > 0x20)
    blank = letters <= 0x20
    ends = np.append(blank[1:], True) & ~blank
    twice = np.append(False, mark[1:] & mark[:-1])
    n = len(words)
    starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    bare = np.add.reduceat(letter | (letters == _DIGIT), starts) == 0 if len(starts) else np.zeros(0, bool)
    # A last stretch of less than half the words is part of the one before.
    edges = [*range(0, max(1, n - STRETCH // 2), STRETCH), n]
    stretches = [words[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        float((ends & twice).sum()) / n,
        float(bare.sum()) / n,
        float(capital.sum()) / max(1, int(letter.sum())),
        sum(map(str.__eq__, words, words[1:])) / n,
        1 - sum(len(set(x)) for x in stretches) / sum(map(len, stretches)),
        1 - len(set(lines)) / max(1, len(lines)),
        float(mark.sum()) / max(1, int((~blank).sum())),
        sum(len(w) > 40 for w in words) / n,
    ]


def votes(found: list[float]) -> str:
    return "".join("-" if x >= against else "+" if x < favour else "0" for x, (_, against, favour) in zip(found, LABELERS, strict=True))


def _shape(text: str) -> bytes:
    return text.translate(_SHAPES).encode("ascii")


@functools.lru_cache(1 << 16)
def _kept_slot(name: bytes) -> int:
    return zlib.crc32(name) % SLOTS


def _slot(name: bytes) -> int:
    # Long names are not remembered, so that the memory of those that are is bounded.
    return _kept_slot(name) if len(name) <= 64 else zlib.crc32(name) % SLOTS


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, str]:
    """Slots and values of the hashed features, and the votes; null counts as empty."""
    text = text or ""
    shape = _shape(text)
    found = shares(text, shape)
    letters = np.frombuffer(shape, np.uint8)
    # Runs of one class count as two.
    again = letters[2:] == letters[1:-1]
    again &= letters[1:-1] == letters[:-2]
    words = letters[np.append([True, True][: len(letters)], ~again)].tobytes().split() if len(letters) else []
    values: Counter = Counter()
    for name, n in Counter(words).items():
        values[_slot(name)] += n / len(words)
    for (a, b), n in Counter(zip(words, words[1:], strict=False)).items():
        values[_slot(a + b" " + b)] += n / len(words)
    for (name, _, _), x in zip(LABELERS, found, strict=True):
        values[_slot(f"{name} {min(9, int(10 * x))}".encode())] += 1
    return np.fromiter(values.keys(), np.int32, len(values)), np.fromiter(values.values(), np.float32, len(values)), votes(found)


def train(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic regression on soft labels, by gradient descent with momentum."""
    w, b, speed, push = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32), 0.0
    scale = np.sqrt((x**2).mean(axis=0)) + 1e-3
    x = x / scale
    rate = RATE / x.shape[1] ** 0.5
    for _ in range(STEPS):
        off = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y).astype(np.float32)
        speed = 0.9 * speed - rate * (x.T @ off / len(y) + RIDGE * w)
        push = 0.9 * push - rate * float(off.mean())
        w, b = w + speed, b + push
    return w / scale, b


def fit(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, float]:
    """Weights and offset of the scorer, from all documents' votes and a sample of ``SAMPLE`` texts.

    The votes of every document count.  The sample has the distinct texts with the
    smallest hashes.  Without documents the scorer keeps everything.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lots(batches):
            found = [votes(shares(t, _shape(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["key", "votes"])

    body = valid(F.coalesce(docs[text], F.lit("")))
    keyed = docs.select(F.xxhash64(body).alias("key"), body.alias("text"))
    voted = stored(keyed.mapInArrow(vote, "key long, votes string"), "votes")
    counts = {r["votes"]: r["n"] for r in voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return np.zeros(SLOTS, np.float32), 1.0
    start = {v: (0.95, 0.4)[v.count("-")] if v.count("-") < 2 else 0.05 for v in counts}
    posterior = weak.posteriors(counts, start, prior=PRIOR)[0]

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lots(batches):
            rows = [features(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.float32())), pa.array([r[2] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "slots", "worth", "votes"])

    last = voted.select("key").distinct().orderBy("key").limit(SAMPLE).agg(F.max("key")).first()[0]
    sample = keyed.where(F.col("key") <= last).dropDuplicates(["key"]).mapInArrow(sampled, "key long, slots array<int>, worth array<float>, votes string").orderBy("key").toPandas()
    x = np.zeros((len(sample), SLOTS), np.float32)
    for k, (slots, values) in enumerate(zip(sample["slots"], sample["worth"], strict=True)):
        x[k, slots] = values
    return train(x, np.array([posterior[v] for v in sample["votes"]], np.float32))


def scored(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text") -> DataFrame:
    """``row`` (all columns) and ``score``, from 0 (junk) to 1."""
    weight, offset = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lots(batches):
            out = []
            for t in batch.column(1).to_pylist():
                slots, values, _ = features(t)
                out.append(1 / (1 + np.exp(-np.clip(float(weight[slots] @ values) + offset, -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["row", "score"])

    whole = docs.select(tucked(docs), valid(docs[text]).alias("text"))
    return whole.mapInArrow(run, T.StructType([whole.schema["row"], T.StructField("score", T.DoubleType())]))


def kept(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that the scorer keeps, all columns.

    Null and empty texts have no share against them and are judged like any other;
    repeated rows get the same score; an empty table stays empty.
    """
    return untucked(scored(docs, fit(docs, text), text).where(F.col("score") >= KEEP), docs.columns)
