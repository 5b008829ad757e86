"""Byte-pair encoding of whole texts over a trie of their distinct words, and decoding.

A prefix of a word ends in one certain token: the only one whose pair with the last
token of what stands before it is left as it is by the merges.  So the last token
is a state of a trie node; walking the trie depth first works it out once for all
words that share the prefix, and the tokens of a word are read off backwards.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyfold.llm import wordpieces as wp
from skyfold.llm.common import valid

#: Texts whose ids and decoded text are held at once.
ROWS = 128


class Encoder:
    """The merges of one vocabulary and the walk over tries of words."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end_of_word: str = ""):
        self.ids, self.end = vocabulary, end_of_word
        self.ranks = {pair: k for k, pair in reversed(list(enumerate(merges)))}
        self.fits: dict[tuple[str, str], bool] = {}
        #: Every ending of a token, and whether it is a token that the merges make of its own letters.
        self.tails: dict[str, bool] = {}
        for token in vocabulary:
            letters = self._cut(token)
            for k in range(len(letters)):
                self.tails.setdefault("".join(letters[k:]), False)
            self.tails[token] = self.merged(letters) == [token]

    def symbols(self, word: str) -> list[str]:
        return [*word[:-1], word[-1] + self.end] if word else []

    def merged(self, parts: list[str]) -> list[str]:
        """Merge the pair of least rank, leftmost first, until none is left."""
        parts = list(parts)
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), k) for k, pair in enumerate(itertools.pairwise(parts)))
            if rank == len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _cut(self, token: str) -> list[str]:
        return self.symbols(token[: -len(self.end)]) if self.end and token.endswith(self.end) and token != self.end else list(token)

    def is_pair(self, left: str, right: str) -> bool:
        """Whether the merges leave these two tokens side by side."""
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > wp.KEPT_WORDS:
                self.fits.clear()
            known = self.fits[left, right] = self.merged([*left, *self._cut(right)]) == [left, right]
        return known

    def last_token(self, text: str, end: int, sizes: list[int], suffix: str = "") -> int:
        """Letters of ``text`` in the last token of its first ``end`` letters, to which ``suffix`` is added.

        ``sizes[k]`` is the same for the first k letters.  The walk to the left ends
        where no token ends in the letters passed.
        """
        tails, fits, start, found = self.tails, self.fits, end, []
        while start:
            start -= 1
            token = text[start:end] + suffix
            kind = tails.get(token)
            if kind is None:
                break
            if kind:
                found.append((start, token))
        for start, token in reversed(found):
            if not start:
                return end
            left = text[start - sizes[start] : start]
            known = fits.get((left, token))
            if known or known is None and self.is_pair(left, token):
                return end - start
        raise ValueError(f"the vocabulary lacks {text[end - 1 : end] + suffix!r}")

    def encode(self, words: Iterable[str]) -> dict[str, list[str]]:
        """The tokens of each word.

        Words in sorted order visit the nodes of their trie depth first, so it is
        enough to hold the states on the path from the root to the present node.
        """
        out: dict[str, list[str]] = {"": []}
        path, sizes = "", [0]
        for word in sorted(set(words) - {""}):
            stem = word[:-1] if self.end else word
            shared = len(os.path.commonprefix((path, stem)))
            del sizes[shared + 1 :]
            for end in range(shared + 1, len(stem) + 1):
                sizes.append(self.last_token(stem, end, sizes))
            path, at, tokens = stem, len(stem), []
            if self.end:
                at = len(word) - self.last_token(word, len(word), sizes, self.end)
                tokens.append(word[at:] + self.end)
            while at:
                tokens.append(word[at - sizes[at] : at])
                at -= sizes[at]
            out[word] = tokens[::-1]
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, once per process."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    return Encoder(model["vocab"], merges, model["end_of_word_suffix"] or "")


@functools.cache
def _known(path: str) -> wp.Known:
    own, added = encoder(path), wp.special(path)

    def of_words(new: list[str]) -> dict[str, bytes]:
        letters = {w: w if wp.is_word(w) else wp.byte_letters(w) for w in new if w not in added}
        tokens = own.encode(letters.values())
        out = {w: wp.packed([added[w]]) for w in new if w in added}
        for word, x in letters.items():
            out[word] = b"".join([one[t] for t in tokens[x]])
        return out

    one = {t: wp.packed([i]) for t, i in own.ids.items()}
    return wp.Known(path, of_words)


@functools.cache
def _token_of_id(path: str) -> np.ndarray:
    """The token of each id, to decode with."""
    every = {i: t for t, i in encoder(path).ids.items()} | {i: t for t, i in wp.special(path).items()}
    return np.array([every.get(i, "") for i in range(max(every) + 1)], object)


def encode(path: str, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """The ids of each text."""
    known = _known(path)
    for lot in itertools.batched(texts, wp.LOT):
        found = [wp.chunks(path, t) for t in lot]
        known.add(found)
        for own in found:
            yield np.frombuffer(b"".join(map(known.__getitem__, own)), "<u4")


def decode(path: str, ids: np.ndarray) -> str:
    """The text of ids as a file without a decoder has it: tokens with a space between them, special ones too."""
    return " ".join(_token_of_id(path)[ids].tolist())


def encode_documents(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``id_column``, the ids of every whole text (``ids``) and the text decoded from them (``decoded``).

    Row by row: nothing is shuffled, and an executor that is lost costs its own
    partitions.  Null and empty texts have no ids and decode to an empty text; null
    document ids and repeated rows stay as they are; other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = list(encode(path, part.column(1).to_pylist()))
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, "<u4"), *ids]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array([decode(path, x) for x in ids])], names)

    names = ["_id", "ids", "decoded"]
    source = docs.select(docs[id_column].alias("_id"), valid(docs[text]).alias("_text"))
    kind = source.schema["_id"].dataType.simpleString()
    return source.mapInArrow(run, f"_id {kind}, ids array<int>, decoded string").withColumnRenamed("_id", id_column)
