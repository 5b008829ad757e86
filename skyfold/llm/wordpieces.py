"""Texts as the words that a tokenizer file's normaliser and splitter make of them, and their ids.

The tokenizers library splits and encodes; what is added here is that a word is
encoded once for many texts however often it occurs, a quick way to split
texts in Latin letters, for which the classes of the splitting pattern are known, and
a compiled encoder for the words of a file whose ids follow the order of its merges.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer
from tokenizers.models import BPE

#: Words whose encodings by the trie a worker keeps before it starts anew: a bound on its memory, not on the words.
KEPT_WORDS = 600_000
#: Texts that the trie looks up together, and letters of texts that the library's model gets together.
LOT = 32
LETTERS = 1 << 23
#: Letters of the longest chunk that goes to the compiled encoder.
LONGEST = 100
#: The splitting pattern of the public file, which the quick way stands for.
KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_RANGE = [chr(c) for c in (9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x180)) if c != 0x130]
_LETTERS = "".join(re.escape(c) for c in _RANGE if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(re.escape(c) for c in _RANGE if unicodedata.category(c)[0] == "N")
_PLAIN = re.compile("[" + "".join(map(re.escape, _RANGE)) + "]*")
#: The known pattern with its ways in another order: no two of the first three begin with the same sign.
_WORD = re.compile(rf"[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")


@functools.cache
def load(path: str) -> Tokenizer:
    """The tokenizer of a file, once per process, without truncation and padding."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.cache
def special(path: str) -> dict[str, int]:
    """The ids of the special tokens, which are found in a text before it is normalised."""
    return {x.content: i for i, x in load(path).get_added_tokens_decoder().items()}


@functools.cache
def _special_pattern(path: str) -> re.Pattern | None:
    longest_first = sorted(special(path), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None


@functools.cache
def _lowered_mark(path: str) -> re.Pattern | None:
    """Finds what is a special token once it is lower-cased: a text that only then has one must not be taken to have it."""
    marks = _special_pattern(path)
    return marks and re.compile(marks.pattern, re.IGNORECASE)


@functools.cache
def _quick(path: str) -> bool:
    import json

    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    kinds = [x["type"] for x in (parts.get("normalizer") or {}).get("normalizers", [])]
    steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    return kinds == ["NFC", "Replace", "Lowercase"] and (steps[0].get("pattern") or {}).get("Regex") == KNOWN_PATTERN


def _byte_alphabet() -> dict[int, str]:
    """A letter for each byte: itself where it can be printed, else the next free one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = itertools.count(0x100)
    return {b: chr(b if b in shown else next(free)) for b in range(256)}


_LETTER_OF_BYTE = _byte_alphabet()
BYTE_OF_LETTER = {letter: byte for byte, letter in _LETTER_OF_BYTE.items()}


def byte_letters(word: str) -> str:
    """A word in the alphabet in which byte-level vocabularies are written."""
    return word.encode().decode("latin-1").translate(_LETTER_OF_BYTE)


def chunks(path: str, text: str | None) -> list[str]:
    """A text cut into chunks that are split on their own; null counts as empty.

    A chunk is what stands between white space where the text has plain letters
    only, else one word of the library's splitter.  A special token is a chunk.
    """
    if not text:
        return []
    if is_plain(path, text):
        return text.lower().split()
    marks = _special_pattern(path)
    if marks is None or not marks.search(text):
        return _library_split(path, text)
    out = []
    for k, piece in enumerate(marks.split(text)):
        if k % 2:
            out.append(piece)
        elif piece:
            out += _library_split(path, piece)
    return out


def is_plain(path: str, text: str) -> bool:
    """Whether a text has plain letters only and nothing like a special token, so that it may be cut at white space."""
    marks = _lowered_mark(path)
    return bool(_quick(path) and _PLAIN.fullmatch(text) and not (marks and marks.search(text)))


def words(path: str, chunk: str) -> list[str]:
    """The words of a chunk."""
    shown = chunk.isascii() and chunk.isprintable()
    if (shown or _PLAIN.fullmatch(chunk)) and _quick(path) and chunk not in special(path):
        return _WORD.findall(chunk)
    return [chunk]


def _library_split(path: str, text: str) -> list[str]:
    tokenizer = load(path)
    normal = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
    if not tokenizer.pre_tokenizer:
        return [normal]
    return [normal[start:end] for _, (start, end) in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]


class Known(dict):
    """The packed ids of each chunk seen so far, made from those of its words when a chunk is first met.

    ``of_words`` gets new words and returns the packed ids of each.
    """

    def __init__(self, path: str, of_words: Callable[[list[str]], dict[str, bytes]]):
        super().__init__()
        self.path, self.of_words, self.words = path, of_words, {}

    def add(self, found: Iterable[list[str]]) -> None:
        """Make sure that all these chunks are known."""
        every = set().union(*found)
        new = {x for x in every if x not in self}
        if len(self) + len(new) > KEPT_WORDS:
            self.clear()
            new = every
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        own = {x: [x] if is_word(x) else words(self.path, x) for x in new}
        if unknown := set().union(*own.values()).difference(self.words):
            self.words |= self.of_words(sorted(unknown))
        known = self.words.__getitem__
        for chunk, parts in own.items():
            self[chunk] = known(chunk) if len(parts) == 1 and parts[0] == chunk else b"".join(map(known, parts))


def is_word(chunk: str) -> bool:
    """Whether a chunk is Latin letters alone, so that it is one word and its own byte letters; False says nothing."""
    return chunk.isascii() and chunk.isalpha()


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.cache
def _compiled(path: str) -> tuple[tiktoken.Encoding, np.ndarray] | None:
    """A compiled encoder of words with a space behind each, and which ids end a word; none where the file's ids don't follow its merges.

    No word has a space, so that it can stand for the mark of a word's end.  That the last
    letter takes the mark comes before all merges, as in the file.
    """
    import json

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    mark, added, tokenize = model.get("end_of_word_suffix"), special(path), load(path).model.tokenize
    if not _quick(path) or model["type"] != "BPE" or not mark or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges")):
        return None
    own = {w: i for w, i in model["vocab"].items() if w not in added}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    in_order = {own.get(x) for x in BYTE_OF_LETTER} == set(range(256)) and {own.get(x + mark) for x in BYTE_OF_LETTER} == set(range(256, 512))
    if not in_order or [own.get(w) for w in merged] != list(range(512, len(own))):
        return None
    # Where each token is what its own letters give, no token can be met by other ways than the file's merges.
    inside = BPE(vocab=model["vocab"], merges=[tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]).tokenize
    if any([x.id for x in (tokenize(w.removesuffix(mark)) if w.endswith(mark) else inside(w))] != [own[w]] for w in merged):
        return None
    ranks = {bytes(BYTE_OF_LETTER[c] for c in w.removesuffix(mark)) + b" " * w.endswith(mark): i for w, i in own.items()}
    closing = np.zeros(len(own), bool)
    closing[[i for w, i in own.items() if w.endswith(mark)]] = True
    return tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}), closing


class _Library:
    """The ids of texts by a file's model, those of each chunk worked out once for all texts that are given together."""

    def __init__(self, path: str):
        self.path, self.tokenize, self.added, self.compiled = path, load(path).model.tokenize, special(path), _compiled(path)

    def encode(self, texts: list[str], tail: bytes) -> Iterator[np.ndarray]:
        """The ids of each text with ``tail`` behind them."""
        plain = np.array([is_plain(self.path, t) for t in texts], bool)
        split = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(list(itertools.compress(texts, plain)), pa.large_string())))
        others = [chunks(self.path, t) for t in itertools.compress(texts, ~plain)]
        # Texts in plain letters come first, the others behind them.
        ends = np.cumsum([*pc.list_value_length(split).to_pylist(), *map(len, others)], dtype=np.int64)
        met = pa.concat_arrays([split.flatten(), pa.array(list(itertools.chain.from_iterable(others)), pa.large_string())]).dictionary_encode()
        del split, others
        ids, starts = self._of(met.dictionary.to_numpy(zero_copy_only=False).tolist())
        data = pa.py_buffer(ids.tobytes() + tail)
        each = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts * 4, data.size)), data])
        _, offsets, data = each.take(pa.array(np.insert(met.indices.to_numpy(), ends, len(starts) - 1))).buffers()
        stops = np.frombuffer(offsets, np.int64)[ends + np.arange(1, len(ends) + 1)] // 4
        ids = np.frombuffer(data or b"", "<u4", int(stops[-1]))
        place = np.empty(len(texts), np.int64)
        place[np.argsort(~plain, kind="stable")] = np.arange(len(texts))
        for start, stop in zip(np.append(0, stops)[place].tolist(), stops[place].tolist(), strict=True):
            yield ids[start:stop]

    def _of(self, met: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks one behind the other, and where those of each start, and the end."""
        # The compiled encoder's time grows with the square of a word's length.
        slow = [k for k, c in enumerate(met) if len(c) > LONGEST or c in self.added or not self.compiled]
        own = [[c] if is_word(c) else words(self.path, c) for c in met]
        alone = [[i for w in own[k] for i in self._by_model(w)] for k in slow]
        for k in slow:
            own[k] = []
        ids, starts = np.zeros(0, "<u4"), np.zeros(len(met) + 1, np.int64)
        if self.compiled:
            encoding, closing = self.compiled
            ids = encoding.encode_to_numpy(" ".join([*itertools.chain.from_iterable(own), ""]), disallowed_special=()).astype("<u4", copy=False)
            starts = np.append(0, np.flatnonzero(closing[ids]) + 1)[np.cumsum([0, *map(len, own)])]
        if slow:
            sizes = np.zeros(len(starts), np.int64)
            sizes[np.array(slow) + 1] = [len(x) for x in alone]
            ids = np.insert(ids, np.repeat(starts[slow], sizes[np.array(slow) + 1]), np.fromiter(itertools.chain.from_iterable(alone), "<u4"))
            starts = starts + np.cumsum(sizes)
        return ids, starts

    def _by_model(self, word: str) -> list[int]:
        return [self.added[word]] if word in self.added else [x.id for x in self.tokenize(word if is_word(word) else byte_letters(word))]


_library = functools.cache(_Library)


def _together(texts: Iterable[str | None]) -> Iterator[list[str]]:
    lot, size = [], 0
    for text in texts:
        lot.append(text or "")
        size += len(lot[-1])
        if size >= LETTERS:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def encode(path: str, texts: Iterable[str | None], end: int | None = None) -> Iterator[np.ndarray]:
    """The ids of each text by the library's model, with ``end`` behind them where one is given."""
    tail = b"" if end is None else packed([end])
    for lot in _together(texts):
        yield from _library(path).encode(lot, tail)
