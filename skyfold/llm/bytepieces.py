"""Ids of texts by a byte-level tokenizer file, at the speed of a compiled encoder."""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import tiktoken

from skyfold.llm import wordpieces as wp

#: The splitting pattern that byte-level files mean when they name none.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.cache
def _encoder(path: str) -> Callable[[str], list[int]]:
    """A compiled encoder where the ids of the file follow the order of its merges, else the tokenizers library."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    vocabulary, merges, splitter = parts["model"]["vocab"], parts["model"]["merges"], parts.get("pre_tokenizer") or {}
    special = wp.special(path)
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
    bytes_first = sorted(vocabulary[letter] for letter in wp.BYTE_OF_LETTER if letter in vocabulary) == list(range(256))
    plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space") and not parts.get("normalizer")
    if plain and bytes_first and all(vocabulary[w] == 256 + k for k, w in enumerate(merged)):
        ranks = {bytes(wp.BYTE_OF_LETTER[c] for c in w): i for w, i in vocabulary.items() if w not in special}
        compiled = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: compiled.encode(text, allowed_special="all")
    library = wp.load(path)
    return lambda text: library.encode(text, add_special_tokens=False).ids


def encode(path: str, texts: Iterable[bytes | None], end: int) -> Iterator[np.ndarray]:
    """The ids of each text (UTF-8; null: empty; what is no UTF-8 becomes U+FFFD) and ``end``, as the tokenizers library has them."""
    own = _encoder(path)
    for text in texts:
        yield np.array([*own(text.decode("utf-8", "replace")), end] if text else [end], "<u4")
