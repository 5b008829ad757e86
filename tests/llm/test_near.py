import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from llm.conftest import CLASHES, LONG, ODD, PROSE
from skyfold.llm import copies, paragraphs, simhash, suffixes
from skyfold.llm.common import Sieve, components
from skyfold.llm.lyndon import suffix_array


def _roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(200, 290)] + [(500, k) for k in range(510, 560)] + [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(80)]
    rng.shuffle(links)
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    known = _roots({x for p in links for x in p}, links)
    assert found == {n: r for n, r in known.items() if n in found}
    assert set(known) - set(found) <= {a for a, b in links if a == b}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sieve_says_no_only_where_it_is_no(spark):
    numbers = [-5, 0, 7, 2**62, -(2**63), None]
    sieve = Sieve(spark.createDataFrame([(n,) for n in numbers], "x long"), 1 << 12)
    assert sieve.may_hold(np.array(numbers[:-1], np.int64)).all()
    assert not sieve.may_hold(np.array([8, 1], np.int64)).any()


def _fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_on_odd_documents(odd, none):
    found = sorted((r.doc_id or 0, r.hex, r.component_id) for r in simhash.groups(odd).withColumn("hex", simhash.hexadecimal("fp")).collect())
    own = [(d, _fingerprint(t)) for d, t in ODD]
    roots = _roots({f for _, f in own}, [(a, b) for _, a in own for _, b in own if (a ^ b).bit_count() <= 3])
    least = {r: min((d for d, f in own if roots[f] == r and d is not None), default=None) for r in set(roots.values())}
    assert found == sorted((d or 0, f"{f:016x}", least[roots[f]]) for d, f in own)
    assert simhash.groups(none).count() == 0


@pytest.mark.parametrize("block", [simhash.BLOCK, 4])
def test_no_link_is_lost_in_crowds(spark, monkeypatch, block):
    """Chains and crowds of fingerprints, also where a posting is cut into blocks."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(2)
    values = set()
    for _ in range(6):
        one = rng.getrandbits(64)
        for _ in range(25):
            values.add(one)
            for _ in range(rng.randint(1, 4)):
                one ^= 1 << rng.randrange(64)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    pairs = [(a % (1 << 64), b % (1 << 64)) for a, b in found]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    near = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3]
    assert _roots(values, pairs) == _roots(values, near)


def test_first_of_each_group(clashing):
    kept = simhash.first_of_each_group(clashing)
    assert kept.columns == clashing.columns
    own = [r.doc_id for r in kept.collect()]
    assert sorted(d for d in own if d is not None) == sorted({r.component_id for r in simhash.groups(clashing.where("doc_id IS NOT NULL")).collect()})
    assert own.count(None) == 1


def test_near_copies_of_documents_go(spark, clashing, none):
    """Copies with edited words, more than three bits apart; rows that share an id or have none are judged by their texts."""
    import corpus_pipeline

    words = [f"w{k}" for k in range(200)]
    edit = lambda *places: " ".join("x" + w if k in places else w for k, w in enumerate(words))
    rows = [(5, " ".join(words)), (7, edit(20, 90)), (8, edit(34, 45, 82, 139)), (9, edit(*range(5, 200, 16))), (10, "few words"), (11, "few  Words"), (12, "few"), (None, edit(30)), (None, "alone here"), (None, "alone here"), (9, "another text")]
    jaccard = lambda a, b: len(a & b) / len(a | b)
    sets = {k: {tuple(t.split()[i : i + 5]) for i in range(196)} for k, (_, t) in enumerate(rows[:4])}
    assert jaccard(sets[0], sets[1]) >= 0.8 and jaccard(sets[0], sets[2]) >= 0.8 > jaccard(sets[0], sets[3])
    assert (simhash.fingerprint(rows[0][1]) ^ simhash.fingerprint(rows[2][1])).bit_count() > 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.keep_first_copies(spark, docs, "").collect())
    assert kept == sorted([(5, rows[0][1]), (9, rows[3][1]), (10, "few words"), (12, "few"), (0, "alone here"), (9, "another text")])
    odd = copies.first_of_alike(clashing)
    assert odd.columns == clashing.columns
    assert sorted(r.doc_id or 0 for r in odd.collect()) == [0, 1, 4, 5, 8, 9, 10, 11]
    assert copies.first_of_alike(none).count() == 0


def test_near_copies_against_brute_force(documents):
    rows = [(r.doc_id, r.text.lower().split()) for r in documents.collect()]
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} or {tuple(t)} for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    roots, least = _roots(range(len(rows)), links), {}
    for k, r in roots.items():
        least[r] = min(rows[k][0], least.get(r, rows[k][0]))
    found = {r.doc_id for r in copies.first_of_alike(documents).collect()}
    assert found >= set(least.values()) and len(found) <= 1.01 * len(least)


def _without_repeats(rows):
    """Paragraph removal by brute force: all pairs of paragraphs."""
    occur, sets = defaultdict(list), {}
    for d, text in rows:
        lines, sentences = paragraphs.units(text or "")
        for line, own in zip(lines, sentences, strict=True):
            occur[tuple(line.words)].append((d, 2 * line.start))
            if len(line.words) >= 5:
                sets[tuple(line.words)] = {tuple(line.words[k : k + 5]) for k in range(len(line.words) - 4)}
                if len(own) > 1:
                    for s in own:
                        if len(s.words) >= 5:
                            occur[tuple(s.words)].append((d, 2 * s.start + 1))
    alike = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    roots, lost, heads = _roots(occur, alike), defaultdict(set), {}
    for unit, places in occur.items():
        heads[roots[unit]] = min([*places, heads.get(roots[unit], (float("inf"), 0))])
    for unit, places in occur.items():
        for d, at in places:
            if (d, at) != heads[roots[unit]]:
                lost[d].add((at, paragraphs._hash(list(unit))))
    return [(d, paragraphs.without(t, lost[d]) if t and d in lost else t) for d, t in rows]


def test_paragraphs_against_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = {r.doc_id: r.text for r in paragraphs.cleaned(documents).collect()}
    known = dict(_without_repeats(rows))
    assert sum(found[d] == t for d, t in known.items()) >= 0.99 * len(known)  # near pairs meet by chance
    assert sum(len(t) for t in found.values()) < 0.95 * sum(len(t) for _, t in rows)


@pytest.mark.parametrize("block", [paragraphs.BLOCK, 4])
def test_near_paragraphs_meet(spark, monkeypatch, block):
    monkeypatch.setattr(paragraphs, "BLOCK", block)
    words = [f"w{k}" for k in range(80)]
    rows = [(d, " ".join([*words[:-1], f"x{d}"])) for d in range(30)] + [(100, " ".join(reversed(words)))]
    found = {r.doc_id: r.text for r in paragraphs.cleaned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d for d, t in found.items() if t} == {0, 100}


def test_paragraphs_on_odd_documents(clashing, none):
    found = paragraphs.cleaned(clashing)
    assert found.columns == clashing.columns
    own = sorted((r.doc_id or 0, r.text or "") for r in found.collect())
    left = {d: t for d, t in own}
    assert len(own) == len(ODD) and left[5] == PROSE and left[6] == "" and left[12] == "" and left[1] == "" and left[11] == "one two three"
    assert [r.key for r in found.limit(1).collect()] == [CLASHES.index("key")]
    assert paragraphs.cleaned(none).count() == 0


def test_rows_without_an_id_are_documents_of_their_own(spark):
    """A third of all rows has no id, and many have the same: each keeps or loses by its own text."""
    first, second = (" ".join(f"{w}{k}" for k in range(12)) for w in "ab")
    own = [" ".join(f"own{d}x{k}" for k in range(8)) for d in range(40)]
    rows = [(None, f"{t}\n{first}") for t in own[:20]] + [(7, f"{t}\n{second}") for t in own[20:]] + [(9, f"{first}\n{second}")]
    kept = [(r.doc_id, r.text) for r in paragraphs.cleaned(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()]
    for k, t in enumerate(own):
        assert sum(t in text and doc == (None if k < 20 else 7) for doc, text in kept) == 1
    assert [sum(p in text for _, text in kept) for p in (first, second)] == [1, 1] and (9, "") in kept


def test_bytes_that_are_no_utf8_are_replaced(spark):
    """Every operator that reads characters takes them as U+FFFD, so that no row ends a job."""
    import corpus_pipeline

    broken = spark.sql("select id as doc_id, cast(concat(x'61ff62', cast(repeat(' abc def', 12) as binary)) as string) as text, 0 as n_chars from range(3)")
    clean = broken.select("doc_id", F.make_valid_utf8("text").alias("text"), "n_chars")
    for run in (simhash.groups, copies.first_of_alike, paragraphs.cleaned):
        a, b = (sorted(r[0] for r in run(d).collect()) for d in (broken, clean))
        assert a == b and a
    kept = corpus_pipeline.keep_good(spark, broken, "")
    assert kept.count() in (0, 3)


def test_a_passage_inside_a_paragraph_goes():
    text = "Start of it all here. " + PROSE + " The end of it all comes."
    lines, sentences = paragraphs.units(text)
    gone = {(2 * s.start + 1, paragraphs._hash(s.words)) for s in sentences[0][1:-1]}
    assert paragraphs.without(text, gone) == "Start of it all here. The end of it all comes."


def test_texts_are_cut_into_words_together(monkeypatch):
    """Units made from many texts at once are those of each text alone, at the same characters."""
    odd = [
        *("", None, "\n\n \n", "one", PROSE),
        "\u0130\u0130 one two three four five. Six seven EIGHT nine ten eleven! Twelve a b c d e? f",
        " \u3000\u0391\u03a3 \u03a3\u0391\u03a3. \u039f\u03a3\x1c\u03a3 a b c d e.\x85A b c d e f g! \n\n  .  \nx. y. z. w. v. u\r\nK \u212aelvin a. B c d e f g h.  ",
        "\n a b c d e f. g h i j k l?!  m n o p q r\n\U0001f600 \u65e5\u672c. g h i j k\u2003l m",
    ] * 20
    calls, made = [], paragraphs.bands
    monkeypatch.setattr(paragraphs, "bands", lambda *a: calls.append(1) or made(*a))
    batch = pa.RecordBatch.from_arrays([pa.array([None, *range(1, len(odd))], pa.int64()), pa.array(range(len(odd))), pa.array(odd)], ["doc", "own", "text"])
    found = {(r["unit"], r["raw"], r["doc"], r["own"], r["at"], tuple(r["keys"])) for b in paragraphs._occurrences(iter([batch])) for r in b.to_pylist()}
    assert len(calls) == 1
    known = set()
    for k, text in enumerate(odd):
        lines, sentences = paragraphs.units(text or "")
        for line, own in zip(lines, sentences, strict=True):
            whole = len(line.words) >= paragraphs.WORDS
            rolled = paragraphs._rolled(paragraphs._numbers(line.words)) if whole else None
            keys = tuple(made(rolled, np.array([0]), np.array([len(rolled)]))[0].tolist()) if whole else ()
            known.add((paragraphs._hash(line.words), paragraphs.raw_hash(line.raw) if whole else None, k or None, k, 2 * line.start, keys))
            known |= {(paragraphs._hash(s.words), None, k or None, k, 2 * s.start + 1, ()) for s in own if len(own) > 1 and len(s.words) >= paragraphs.WORDS}
    assert found == known


def test_stretches_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(paragraphs, "LETTERS", 10)
    texts = ["x" * 25, None, "", "abc", "abcdefghij", "ab"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["k", "text"])
    parts = list(paragraphs._stretches(iter([batch, batch.slice(0, 0)])))
    assert [k for p in parts for k in p.column(0).to_pylist()] == list(range(len(texts))) and len(parts) > 3


def test_only_paragraphs_that_lose_something_are_cut_into_sentences(monkeypatch):
    text = "A b c d e f. G h i j k l.\n" + PROSE + "\nA last one of it."
    lines, sentences = paragraphs.units(text)
    seen, cut = [], paragraphs.units
    monkeypatch.setattr(paragraphs, "units", lambda t: seen.append(t) or cut(t))
    gone = {(2 * lines[1].start, paragraphs._hash(lines[1].words)), (2 * sentences[0][1].start + 1, paragraphs._hash(sentences[0][1].words))}
    assert paragraphs.without(text, gone) == "A b c d e f. \nA last one of it."
    assert seen == ["A b c d e f. G h i j k l."]


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(600):
        text = [rng.randint(0, rng.choice([1, 2, 5, 30])) for _ in range(rng.randint(0, 40))]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda k: text[k:])


def _removed(rows):
    bodies = [(d, (t or "").encode()) for d, t in rows]
    n = suffixes.LENGTH
    times = Counter(b[k : k + n] for _, b in bodies for k in range(len(b) - n + 1))
    out = []
    for d, b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if times[b[k : k + n]] > 1:
                gone[k : k + n] = b"\1" * n
        out.append((d or 0, len(b), len(re.findall(b"\1+", gone)), bytes(x for x, y in zip(b, gone, strict=True) if not y)))
    return sorted(out)


def _kept(docs):
    return sorted((r.doc_id or 0, r.n_bytes, len(r.spans), bytes(r.kept)) for r in suffixes.cleaned(docs).collect())


def test_repeated_strings_in_odd_documents(clashing, none):
    assert _kept(clashing.where(F.coalesce(F.length("text"), F.lit(0)) < 10_000)) == _removed([x for x in ODD if x[1] != LONG])
    assert _kept(none) == []


@pytest.mark.parametrize("many", [suffixes.MANY, 1])
def test_repeated_strings_against_brute_force(spark, monkeypatch, many):
    """Passages of all lengths about the limit in other surroundings, also where each window is counted by itself."""
    monkeypatch.setattr(suffixes, "MANY", many)
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefgé ") for _ in range(n))
    shared = [noise(n) for n in (180, 199, 205, 230, 420, 900)]
    rows = [(d, noise(rng.randint(0, 300)) + rng.choice(shared)[rng.randint(0, 9) :] + noise(rng.randint(0, 9)) + rng.choice(shared) + noise(rng.randint(0, 200))) for d in range(60)]
    rows += [(100, "ab" * 300), (101, "x" * 199), (102, noise(250))]
    assert _kept(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == _removed(rows)


def test_long_texts_are_cut_into_stretches_without_loss(monkeypatch):
    monkeypatch.setattr(suffixes, "STRETCH", 700)
    body = np.random.default_rng(1).integers(97, 123, 5000, dtype=np.uint8).tobytes()
    windows = [w for _, at, first, last in suffixes.anchors(body) for p, a, b in zip(at, first, last, strict=True) for w in range(a, b + 1) if a <= p <= a + 150]
    assert windows == list(range(5000 - suffixes.LENGTH + 1))


def test_texts_under_one_id_are_told_apart(spark):
    # Two texts with one 32-bit hash under one id: what is repeated in the one is not cut from the other.
    rng, seen, pair = random.Random(5), {}, None
    while pair is None:
        lot = ["".join(rng.choices("abcdefghij ", k=320)) for _ in range(40_000)]
        for text, h in zip(lot, (r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(lot)], "k int, t string").orderBy("k").selectExpr("hash(t)").collect())):
            if seen.setdefault(h, text) != text:
                pair = seen[h], text
    rows = [(7, pair[0]), (7, pair[1]), (8, pair[0][30:300]), (None, pair[1][:100]), (None, pair[0][:150])]
    assert _kept(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == _removed(rows)


def test_bytes_that_are_no_text_are_bytes(spark):
    docs = spark.sql("select id as doc_id, cast(concat(x'61ff62', cast(repeat('abc def ', 40) as binary)) as string) as text from range(2)")
    assert [(r.n_bytes, len(r.kept)) for r in suffixes.cleaned(docs).collect()] == [(323, 0), (323, 0)]


def test_the_pipeline_links_fingerprints_too(spark):
    """Two texts of a repeated passage: their fingerprints link, their sets of five words are less than 0.8 alike."""
    import corpus_pipeline

    passage = "the river ran dry that one year " * 60
    rows = [(4, passage + "and nobody kept a record of it at all"), (9, passage + "others say that it never had before then"), (11, PROSE)]
    assert (simhash.fingerprint(rows[0][1]) ^ simhash.fingerprint(rows[1][1])).bit_count() <= simhash.BITS
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in copies.first_of_alike(docs).collect()) == [4, 9, 11]
    assert sorted(r.doc_id for r in corpus_pipeline.keep_first_copies(spark, docs, "").collect()) == [4, 11]
