"""Packing as documents come: every id once, nothing padded, few cuts."""

import itertools
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.conftest import SF_DIR
from skyfold.llm import bytepieces, queries, sum_of_squares
from skyfold.llm import wordpieces as wp

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def check(rows, texts, library, room=1024):
    """The pieces of each document make up its ids, sequences have no gap, and none is padded."""
    known = Counter((i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 0])) for i, t in texts)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["length"] * 4 == len(r["ids"]) and r["length"] > 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == room or at & (at - 1) == 0 and at < room
    own = defaultdict(list)
    for r in rows:
        own[r["doc_id"], r["doc_tokens"]].append((r["start"], r["ids"]))
    # Documents that share id and length can only be told apart as a whole.
    for (doc, size), pieces in own.items():
        same = [ids for (i, ids), n in known.items() for _ in range(n) if i == doc and len(ids) == size]
        assert sum(len(ids) // 4 for _, ids in pieces) == size * len(same)
        if len(set(same)) == 1 and len(same) == 1:
            assert b"".join(ids for _, ids in sorted(pieces)) == np.array(same[0], "<u4").tobytes()
    assert sum(len(k[1]) * n for k, n in known.items()) == sum(r["length"] for r in rows)


def test_odd_documents(spark, odd, clashing, none, library):
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for docs in (odd, clashing):
        check(sum_of_squares.packed(docs, BYTE_BPE).collect(), texts, library)
    assert sum_of_squares.packed(none, BYTE_BPE).count() == 0
    check(sum_of_squares.packed(odd, BYTE_BPE, room=16).collect(), texts, library, 16)


def test_whole_table(spark, documents, library):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    rows = sum_of_squares.packed(documents, BYTE_BPE).collect()
    check(rows, texts, library)
    found = queries.op11_sum_of_squares(spark, SF_DIR)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and found.count() == len(rows)


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    assert sum_of_squares.packed(docs, BYTE_BPE).first()["doc_tokens"] == len(list(bytepieces.encode(BYTE_BPE, ["a�b".encode()], 0))[0])


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aeinst ÉßĿ'.,!12²<|>\n\t\x1c\x85　́中ΣİK😀") | st.characters(codec="utf-8"), max_size=60))
def test_ids_are_the_librarys(text):
    for t in (text, f"{text}<|endoftext|>{text}"):
        assert next(bytepieces.encode(BYTE_BPE, [t.encode()], 0)).tolist() == [*wp.load(BYTE_BPE).encode(t, add_special_tokens=False).ids, 0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=120))
def test_windows(sizes):
    windows = sum_of_squares.Windows(32)
    done = []
    for k, size in enumerate(sizes):
        done += windows.place((k, 0, np.full(size, k), size))
    held = sum(map(len, windows.open))
    done += windows.close()
    fills = [sum(len(p[2]) for p in w) for w in done]
    assert all(f == 32 or f & (f - 1) == 0 for f in fills)
    parts = sorted((p[0], p[1], len(p[2])) for w in done for p in w)
    for k, own in itertools.groupby(parts, key=lambda p: p[0]):
        at = 0
        for _, start, length in own:
            assert start == at
            at += length
        assert at == sizes[k]
    assert held <= len(sizes)


def test_one_length_only_keeps_few_windows_open():
    # No two of these fit a window, so that without cuts each would stay open.
    windows = sum_of_squares.Windows(1024)
    for k in range(5000):
        list(windows.place((k, 0, np.zeros(600, np.uint32), 600)))
        assert sum(map(len, windows.open)) < 2000
    assert windows.count.max() <= 2 * sum_of_squares.CUT


def test_most_documents_stay_whole(documents, library):
    rows = sum_of_squares.packed(documents.coalesce(1), BYTE_BPE).collect()
    short = [r for r in rows if r["doc_tokens"] <= 1024]
    docs = {r["doc_id"] for r in short}
    assert len(short) < 1.6 * len(docs)
