"""Documents packed as they come into windows of a fixed number of tokens, by sums of squares.

A window that would be padded counts at its fill level.  Each document goes where it
leaves the sum of the squares of these counts least (Csirik, Johnson, Kenyon et al.
2006), so no level gathers many windows that nothing completes.  A document may also
be cut, its first part completing a window, when that lowers the sum by more than
``CUT``; a level can then hold about ``CUT`` / 4 windows before the next one is
completed by a cut, which bounds what a task holds.

A task packs the documents of its own partition in one pass: no exchange, no state
outside the task, and the same windows if it has to run again.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from skyfold.llm import bytepieces
from skyfold.llm.common import lots

#: What a cut costs, in squares.
CUT = 32
#: Documents encoded at once.
ROWS = 128

#: A piece: its document, the start in it, the ids, and the tokens of the document.
Piece = tuple[int | None, int, np.ndarray, int]
Window = list[Piece]


def _cut(piece: Piece, at: int) -> tuple[Piece, Piece]:
    doc, start, ids, total = piece
    return (doc, start, ids[:at], total), (doc, start + at, ids[at:], total)


class Windows:
    """The open windows of a task by fill level, and the rule that places a piece in them."""

    def __init__(self, room: int):
        self.room = room
        self.open: list[list[Window]] = [[] for _ in range(room)]
        # A window is padded unless it is full or holds a power of two.
        self.padded = np.array([h > 0 and h & (h - 1) != 0 for h in range(room)] + [False])
        #: Windows at each level, and the change of the sum of squares when one leaves it or comes to it.
        self.count = np.zeros(room + 1, np.int64)
        self.leave, self.enter = np.zeros(room + 1, np.int64), np.where(self.padded, 1, 0)
        self.usable = np.zeros(room, bool)
        self.usable[0] = True

    def _move(self, level: int, by: int) -> None:
        if level and level < self.room:
            self.count[level] += by
            self.usable[level] = self.count[level] > 0
            if self.padded[level]:
                self.leave[level], self.enter[level] = 1 - 2 * self.count[level], 1 + 2 * self.count[level]

    def _put(self, level: int, piece: Piece) -> Window | None:
        """The piece on top of a window of this level; the window if it is full then."""
        window = self.open[level].pop() if level else []
        self._move(level, -1)
        window.append(piece)
        level += len(piece[2])
        if level == self.room:
            return window
        self.open[level].append(window)
        self._move(level, 1)
        return None

    def place(self, piece: Piece) -> Iterator[Window]:
        """Place a piece of at most ``room`` tokens; windows that are full then."""
        room, length, far = self.room, len(piece[2]), np.iinfo(np.int64).max
        # Whole, on a level that has room: ties go to the fullest.
        fits = room - length
        whole = np.where(self.usable[: fits + 1], self.leave[: fits + 1] + self.enter[length : room + 1], far)[::-1]
        best = int(whole.argmin())
        level, squares = fits - best, whole[best]
        if fits + 1 < room:
            # Cut: the window is completed, and what is over opens one.
            over = np.where(self.usable[fits + 1 :], self.leave[fits + 1 : room] + self.enter[1:length], far)[::-1]
            cut = int(over.argmin())
            if over[cut] != far and over[cut] + CUT < squares:
                level = room - 1 - cut
                first, piece = _cut(piece, room - level)
                yield self._put(level, first)
                level = 0
        full = self._put(level, piece)
        if full is not None:
            yield full

    def close(self) -> Iterator[Window]:
        """All windows that are left: the emptiest are cut to complete the fullest, and the last is cut at powers of two."""
        rest = []
        for level in range(self.room - 1, 0, -1):
            if self.padded[level]:
                rest += self.open[level]
            else:
                yield from self.open[level]
        low, high = 0, len(rest) - 1
        while low < high:
            free = self.room - _fill(rest[low])
            while free and low < high:
                piece = rest[high].pop()
                if free < len(piece[2]):
                    stays, piece = _cut(piece, len(piece[2]) - free)
                    rest[high].append(stays)
                rest[low].append(piece)
                free -= len(piece[2])
                if not rest[high]:
                    high -= 1
            if not free:
                yield rest[low]
                low += 1
        if low == high:
            yield from _at_powers(rest[low])


def _fill(window: Window) -> int:
    return sum(len(ids) for _, _, ids, _ in window)


def _at_powers(window: Window) -> Iterator[Window]:
    """The pieces of a window in windows of powers of two, none of which is padded."""
    left, pieces = _fill(window), window[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        own = []
        while size:
            piece = pieces.pop()
            if size < len(piece[2]):
                piece, over = _cut(piece, size)
                pieces.append(over)
            own.append(piece)
            size -= len(piece[2])
        yield own


_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def packed(docs: DataFrame, path: str, room: int = 1024, end: int = 0, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The pieces of every whole text and their places: ``doc_id``, ``start``, ``length``, ``ids`` (32-bit little-endian bytes), ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is its ids and ``end``; whole windows are cut off one longer than ``room`` first.
    No sequence is padded, as the last windows of a task are cut to fill each other, and
    the very last at powers of two.  Null and empty texts are ``end`` alone; null ids, repeated
    ids and repeated rows are documents of their own; an empty table has no sequences; no
    other column is read.  Texts that are no valid UTF-8 are read with U+FFFD in place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, number = Windows(room), TaskContext.get().partitionId() << 32

        def rows(full: Window) -> list[tuple]:
            nonlocal number
            ends = list(itertools.accumulate(len(ids) for _, _, ids, _ in full))
            number += 1
            return [(doc, start, len(ids), ids.tobytes(), total, number - 1, stop - len(ids)) for (doc, start, ids, total), stop in zip(full, ends, strict=True)]

        def full_windows() -> Iterator[Window]:
            for lot in lots(batches, ROWS):
                for doc, ids in zip(lot.column(0).to_pylist(), bytepieces.encode(path, lot.column(1).to_pylist(), end), strict=True):
                    over = len(ids) % room
                    for start in range(0, len(ids) - over, room):
                        yield [(doc, start, ids[start : start + room], len(ids))]
                    if over:
                        # A copy, so that an open window does not hold the whole of a long document.
                        yield from windows.place((doc, len(ids) - over, ids[-over:].copy(), len(ids)))
            yield from windows.close()

        for some in itertools.batched(full_windows(), 512):
            done = [row for full in some for row in rows(full)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), _KINDS, strict=True)], _NAMES)

    source = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text].cast("binary").alias("text"))
    return source.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
