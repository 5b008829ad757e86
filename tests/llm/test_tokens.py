import json
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import ODD, WORD_BPE
from skyfold.llm import packing, token_files, trie_bpe
from skyfold.llm import wordpieces as wp


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aeinorst ÉéßŉĿ'.,!1²x<|>\n\t́  中ΣσİK") | st.characters(codec="utf-8"), max_size=30), max_size=4))
def test_encoders_agree_with_the_library(texts):
    known = [wp.load(WORD_BPE).encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in wp.encode(WORD_BPE, texts)] == known
    assert [x.tolist() for x in trie_bpe.encode(WORD_BPE, texts)] == known
    assert [trie_bpe.decode(WORD_BPE, x) for x in trie_bpe.encode(WORD_BPE, texts)] == [wp.load(WORD_BPE).decode(x, skip_special_tokens=False) for x in known]


def test_trie_on_odd_documents(odd, none, library):
    found = sorted((r.doc_id or 0, r.ids, r.decoded) for r in trie_bpe.encode_documents(odd, WORD_BPE).collect())
    ids = [(d or 0, library.encode(t or "", add_special_tokens=False).ids) for d, t in ODD]
    assert found == sorted((d, i, library.decode(i, skip_special_tokens=False)) for d, i in ids)
    assert trie_bpe.encode_documents(none, WORD_BPE).count() == 0


@pytest.mark.parametrize("top", [3, 300, 70_000, 2**32 - 1])
def test_codes_round_trip(top):
    for n in (0, 1, 3, 4, 5, 1000):
        numbers = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64).astype(np.uint32)
        assert (token_files.unpack(*token_files.pack(numbers), n) == numbers).all()


def test_frequent_ids_take_one_byte():
    assert len(token_files.pack(np.arange(256))[1]) == 256


def _files(docs):
    return [(r.doc_id, r.start, r.n_tokens, r.ids) for r in token_files.round_trip(docs, WORD_BPE).orderBy("start").collect()]


def test_files_of_odd_documents(odd, none, library):
    found = _files(odd)
    ids = {(d, t): [*library.encode(t or "", add_special_tokens=False).ids, 2] for d, t in ODD}
    assert [d for d, *_ in found] == sorted((d for d, _ in ODD), key=lambda d: (d is not None, d or 0))
    assert sorted(np.frombuffer(x[3], "<u4").tolist() for x in found) == sorted(ids[x] for x in ODD)
    at = 0
    for _, start, n, own in found:
        assert start == at and len(own) == 4 * n
        at += n
    assert _files(none) == []


def test_files_of_all_documents(documents, library):
    at, known = 0, []
    for r in documents.orderBy("doc_id").collect():
        ids = np.array([*library.encode(r.text, add_special_tokens=False).ids, 2], "<u4").tobytes()
        known.append((r.doc_id, at, len(ids) // 4, ids))
        at += len(ids) // 4
    assert _files(documents) == known


def _least(items, room):
    best = [len(items)]

    def put(k, bins):
        if len(bins) < best[0]:
            if k == len(items):
                best[0] = len(bins)
                return
            for b in {bins[j]: j for j in range(len(bins)) if bins[j] + items[k] <= room}.values():
                put(k + 1, [x + items[k] * (j == b) for j, x in enumerate(bins)])
            put(k + 1, [*bins, items[k]])

    items = sorted(items, reverse=True)
    put(0, [])
    return best[0]


def test_reduction_loses_no_best_packing():
    rng = random.Random(5)
    for _ in range(300):
        room = rng.choice([10, 15, 30])
        items = [rng.randint(1, room) for _ in range(rng.randint(0, 8))]
        fixed, rest = packing.reduce_by_dominance(Counter(items), room)
        assert sum(n for _, n in fixed) + _least(list(rest.elements()), room) == _least(items, room)


def test_packing_is_near_the_bound():
    lengths = Counter(np.minimum(2048, np.exp(np.random.default_rng(0).normal(6, 1.2, 100_000)).astype(int) + 1).tolist())
    found = packing.solve(lengths, 2048)
    used = Counter()
    for pattern, times in found:
        assert sum(w * k for w, k in pattern) <= 2048
        for w, k in pattern:
            used[w] += k * times
    assert used == lengths
    assert sum(n for _, n in found) <= 1.001 * sum(w * n for w, n in lengths.items()) / 2048 + 1


def test_packed_odd_documents(odd, none, library):
    cut = packing.pieces(odd, WORD_BPE, room=64).withColumnRenamed("ids", "rank")  # a clashing name
    found = packing.place(cut.withColumnRenamed("rank", "ids"), room=64).toPandas()
    known = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in ODD]
    assert sorted(zlib.crc32(x) for x in found["ids"]) == sorted(zlib.crc32(np.array(i[k : k + 64], "<u4").tobytes()) for i in known for k in range(0, len(i), 64))
    found = found.sort_values(["sequence_id", "offset"])
    assert (found.groupby("sequence_id")["length"].cumsum() - found["length"] == found["offset"]).all()
    assert found.groupby("sequence_id")["length"].sum().max() <= 64
    assert packing.place(packing.pieces(none, WORD_BPE)).count() == 0


def test_bytes_that_are_no_utf8_are_replaced(spark):
    broken = spark.sql("select id as doc_id, cast(concat(x'61ff62', cast(' abc def' as binary)) as string) as text from range(2)")
    want = wp.load(WORD_BPE).encode("a\ufffdb abc def", add_special_tokens=False).ids
    assert [list(r.ids) for r in trie_bpe.encode_documents(broken, WORD_BPE).collect()] == [want, want]
    assert [r.n_tokens for r in token_files.round_trip(broken, WORD_BPE).collect()] == [len(want) + 1] * 2
    assert [r.length for r in packing.pieces(broken, WORD_BPE).collect()] == [len(want) + 1] * 2


def test_letters_alone_are_one_word_without_a_search(monkeypatch):
    """Only chunks with other signs are split by the pattern; ids are the library's in any case."""
    split, words = [], wp.words

    def counted(path, chunk):
        split.append(chunk)
        return words(path, chunk)

    monkeypatch.setattr(wp, "words", counted)
    texts = ["Quixotically plain zyzzyvas", "quixotically, it's plain 42 qx7 naïve", "<|endoftext|> plain"]
    known = [wp.load(WORD_BPE).encode(t, add_special_tokens=False).ids for t in texts]
    for way, caches in ((wp, wp._library), (trie_bpe, trie_bpe._known)):
        caches.cache_clear()
        split.clear()
        assert [x.tolist() for x in way.encode(WORD_BPE, texts)] == known
        assert sorted(split) == sorted({"quixotically,", "it's", "42", "qx7", "naïve", "<|endoftext|>"})


def test_special_tokens_in_capitals_are_plain_text(library):
    texts = ["a <|ENDOFTEXT|> b", "<|EndOfText|>", "<|STARTOFTEXT|><|endoftext|>"]
    known = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in wp.encode(WORD_BPE, texts)] == known
    assert [x.tolist() for x in trie_bpe.encode(WORD_BPE, texts)] == known


def test_chunks_are_encoded_once_for_many_texts(monkeypatch, library):
    """Rare words go to a compiled encoder together; ids are the library's whatever the lot, the length of a word or its letters."""
    rng = random.Random(2)
    rare = ["".join(rng.choice("abeéiñosßtŸŉ") for _ in range(rng.choice([3, 12, 99, 100, 101, 300]))) + rng.choice(["", ".", ",&&&", "'s"]) for _ in range(400)]
    texts = [" ".join(rng.choices(rare, k=30)) for _ in range(60)] + ["", None, " \n", "中文 Σίσυφος ΟΔΟΣ", "x" * 5000, "".join(wp._RANGE), " ".join(wp._RANGE), "a<|endoftext|>b"]
    rng.shuffle(texts)
    known = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    asked, by_model = [], wp._Library._by_model
    monkeypatch.setattr(wp._Library, "_by_model", lambda self, word: asked.append(word) or by_model(self, word))
    for letters in (1, 1000, 1 << 23):
        monkeypatch.setattr(wp, "LETTERS", letters)
        asked.clear()
        assert [x.tolist() for x in wp.encode(WORD_BPE, texts)] == known
        assert [x.tolist() for x in wp.encode(WORD_BPE, texts, 7)] == [[*x, 7] for x in known]
    assert set(asked) <= {w for c in rare if len(c) > wp.LONGEST for w in wp.words(WORD_BPE, c.lower())} | {"x" * 5000, "".join(wp._RANGE), "<|endoftext|>"} | set(wp.words(WORD_BPE, "".join(wp._RANGE).lower()))
    monkeypatch.setattr(wp._library(WORD_BPE), "compiled", None)
    assert [x.tolist() for x in wp.encode(WORD_BPE, texts)] == known


def test_compiled_encoder_is_only_for_files_in_order_of_merges(tmp_path):
    """Without the merge that the file makes a token by, the compiled encoder would still make it."""
    with open(WORD_BPE, encoding="utf-8") as file:
        parts = json.load(file)
    assert wp._compiled(WORD_BPE)
    merges = parts["model"]["merges"]
    k = next(k for k, m in enumerate(merges) if len("".join(m)) == 3 and "</w>" not in "".join(m))
    a, b = merges[k] if isinstance(merges[k], list) else merges[k].split(" ")
    word = a + b
    other = [word[:1], word[1:]] if len(a) == 2 else [word[:2], word[2:]]
    parts["model"]["merges"] = [*merges[:k], other if isinstance(merges[k], list) else " ".join(other), *merges[k + 1 :]]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(parts), encoding="utf-8")
    assert wp._compiled(str(path)) is None
    texts = [word, f"{word}s the {word}ing", "river"]
    assert [x.tolist() for x in wp.encode(str(path), texts)] == [wp.load(str(path)).encode(t, add_special_tokens=False).ids for t in texts]
