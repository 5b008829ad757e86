import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import CLASHES, LONG, ODD, PROSE, SF_DIR, WORD_BPE
from skyfold.llm import pii, quality, queries, weak

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c%d@e.f x..y@z.zz.q- x@y.z@w.v a@b.c.d@e.f", "1.2.3.4.5.6.7.8 001.002.003.0255 256.1.1.1 9.9.9.99999999999999", "4111 1111-1111 1111 4111111111111112 5", None, "",
    "+1 (252) 555-3250 +12345678 +1(((((((((((((((2 😀 +49 30 901820 é+1-2-3-4-5-6-7-8-9", "@" * 50 + "a" * 3000 + "@b." + ".c" * 9000, "1" * 3000, "1 " * 9000,
    "call 030 123 4567 or mail joe (at) example (dot) com; card no 4111-1111-1111-1112", "Anna: +44 20 7946 0958, anna.b@mail.example.org, 10.0.0.1, 4539 1488 0343 6467." * 40,
]


def _luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def _base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(digits) <= 19 and _luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda x: (x[0], x[2]))


@pytest.fixture(scope="session")
def personal(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(2)


def test_base_spans(personal, none):
    found = {r.row.doc_id: r for r in pii.spans(personal).collect()}
    for k, text in enumerate(TEXTS):
        assert [(x.s, x.e, x.kind) for x in found[k].base] == _base(text)
        assert {tuple(x) for x in found[k].base} <= {tuple(x) for x in found[k].spans}
    assert pii.spans(none).count() == 0


def test_no_python_on_the_main_path(personal):
    plan = pii.redacted(personal)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pii_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = queries.op5_pii_votes(spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        base = [f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in _base(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(filter(None, r.spans.split(",")))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k + ":") for x in base) for k in pii.KINDS]


def test_redaction(clashing, personal):
    found = pii.redacted(clashing)
    assert found.columns == clashing.columns
    assert sorted((r.doc_id or 0, r.text) for r in found.where("text IS NOT NULL").collect()) == sorted((d or 0, t) for d, t in ODD if t is not None)
    text = {r.doc_id: r.text for r in pii.redacted(personal).collect()}
    assert text[2] == TEXTS[2] and "@mail" not in text[10] and text[10].count("<phone>") == 40 and text[3] is None


def test_spelled_addresses_in_capitals(spark):
    """Texts with no lower-case mark."""
    known = ["call 030 123 4567 or mail joe (at) example (dot) com", "mail ann (at) mail (dot) org"] * 20
    texts = [*known, "WRITE TO JOE (AT) EXAMPLE (DOT) COM", "Joe At Example Dot Com"]
    found = {r.row.doc_id: r.spans for r in pii.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    own = lambda k: [(texts[k][x.s : x.e], x.kind) for x in found[k]]
    assert ("joe (at) example (dot) com", 0) in own(0)
    assert own(40) == [("JOE (AT) EXAMPLE (DOT) COM", 0)] and own(41) == [("Joe At Example Dot Com", 0)]


def test_numbers_in_a_row(spark):
    """A chain of more digits than any number has gives proposals; only those of the text's own groups count."""
    cards, row = "7536784127813050 4845168114407329", "phone 030 123 4567 2026 12 01 10 30 15 22"
    texts = [cards, row, "1" * 40, "5 " * 3000, "call 030 123 4567 now", "id 4111111111111111 +1 (252) 555-3250 190.137.223.204"]
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, _text string")
    found = {r.row: [(texts[r.row][x.s : x.e], x.kind, x.votes) for x in r._proposed] for r in pii.proposals(docs, chains=True).collect()}
    assert [x[:2] for x in found[0]] == [("7536784127813050", 2), ("4845168114407329", 2)]
    assert ("030 123 4567", 3, "-++0-") in found[1] and ("4567 2026 12 01 10 30", 2, "-0++-") in found[1]
    assert all(re.fullmatch(r"[0-9]+( [0-9]+)*", v) and 7 <= len(re.sub("[^0-9]", "", v)) <= 16 for v, _, _ in found[1])
    assert found[2] == [] and len(found[3]) == 2994 + 2988 and found[4] == [("030 123 4567", 3, "-++0+")]
    # The base takes the phone number and the address after it as one match of too many digits.
    assert {k for _, k, v in found[5] if v.startswith("+")} == {1, 2} and ("+1 (252) 555-3250", 3) in [x[:2] for x in found[5]]


def test_many_matches_in_one_text(spark):
    text = " word ".join(f"+1 (252) 555-{k % 9000 + 1000}, a{k}@b.com" for k in range(4000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [(x.s, x.e, x.kind) for x in pii.spans(docs).first().base] == _base(text)
    assert pii.redacted(docs).first().text == " word ".join(["<phone>, <email>"] * 4000)


def test_posteriors_find_the_better_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.7
    rates = [0.95, 0.9, 0.8, 0.55]
    votes = ["".join("+" if t == (rng.random() < p) else "-" for p in rates) for t in truth]
    counts = {v: votes.count(v) for v in set(votes)}
    start = {v: 0.9 if v.count("+") > 1 else 0.1 for v in counts}
    posterior, share, tables = weak.posteriors(counts, start)
    assert abs(share - 0.7) < 0.05
    assert [abs(t[True]["+"] - p) < 0.06 for t, p in zip(tables, rates, strict=True)] == [True] * 4
    assert np.mean([(posterior[v] > 0.5) == t for v, t in zip(votes, truth, strict=True)]) > 0.93


def test_quality_against_held_out_labels(spark):
    """No label is used in training: all of them are held out."""
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")
    found = queries.op10_weak_quality(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").toPandas()
    assert (found["keep"] == (found["quality"] == 1)).mean() > 0.98
    assert found.loc[found["quality"] == 1, "keep"].mean() > 0.99


def test_quality_of_odd_documents(clashing, none):
    found = quality.scored(clashing, quality.fit(clashing)).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    scores = {r.row.doc_id: r.score for r in found}
    assert scores[1] == scores[2] and len({r.score for r in found if r.row.doc_id == 5}) == 1
    assert quality.kept(clashing).columns == clashing.columns
    assert quality.kept(none).count() == 0


def test_shares_of_junk_and_prose():
    def votes(text):
        return quality.votes(quality.shares(text, quality._shape(text)))

    assert "-" not in votes(PROSE) and "-" not in votes(LONG) and "-" not in votes("")
    for junk in (" | ".join(PROSE.split()), PROSE.upper().replace(" ", "!! "), "he " * 100, "***, ".join(PROSE.split()), (PROSE + "\n") * 9):
        assert "-" in votes(junk)


def test_pipeline_stages_in_turn(spark, clashing, none):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "substring dedup", "PII", "best-fit packing"]
    for docs in (clashing, none.withColumn("n_chars", F.lit(0))):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
        assert set(corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).columns) >= {"doc_id", "ids", "sequence_id", "offset"}


def test_pipeline_keeps_clean_documents(spark):
    """Against a brute-force run: every stage's own operator is tested by itself, here their order and what they hand on."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, left, SF_DIR).collect()
        left = spark.createDataFrame(rows, docs.schema)
        assert all(r.n_chars == len(r.text) for r in rows)
    texts = {r.doc_id: r.text for r in rows}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert sum(d in texts for d, q in labels.items() if q == 0) <= 1
    first = {}
    for r in docs.orderBy("doc_id").collect():
        first.setdefault(r.text, r.doc_id)
    clean = [d for d in first.values() if labels.get(d) == 1]
    assert sum(d in texts for d in clean) > 0.8 * len(clean)
    assert len(set(texts)) == len(rows) and not any(_base(t) for t in texts.values())
    packed = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert set(packed["doc_id"]) == set(texts)
    ids = packed.sort_values("piece").groupby("doc_id")["ids"].apply(lambda x: b"".join(map(bytes, x)))
    from skyfold.llm import wordpieces as wp

    for d, own in list(ids.items())[:50]:
        assert np.frombuffer(own, "<u4").tolist() == [*wp.load(WORD_BPE).encode(texts[d], add_special_tokens=False).ids, 0]
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048


def test_every_operator_has_its_query():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.REGISTRY}


def test_names_that_clash_are_the_ones_used():
    assert len(set(CLASHES)) == len(CLASHES)
