import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import SF_DIR
from skyfold.llm import histogram_topk, rotated_bits
from skyfold.llm import vectors as vec

NAN, INF = float("nan"), float("inf")
#: Null, empty, zero, non-finite and short vectors, ties, one repeated id and a null id.
ODD = [
    (0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [NAN, 1.0]), (5, [INF, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, [1.0, 2.0]), (9, [1.0, 2.0]),
    (10, [-3.0, 0.5]), (11, [4.0, 4.0]), (11, [4.0, 3.0]), (None, [1.0, 1.0]), (20, [1.5, -2.0]),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("v", F.lit(1))


def _known(zero):
    own = {}
    for i, v in ODD:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v)):
            own[i] = min(own.get(i, v), v)
    return own


def _best(known, asked, score, k):
    out = []
    for q in asked:
        others = sorted((score(known[q], v), i) for i, v in known.items() if i != q and len(v) == len(known[q]))
        out += [(q, n + 1, i, s) for n, (s, i) in enumerate(others[:k])]
    return sorted(out)


def test_nearest_of_odd_vectors(odd):
    known = _known(False)
    found = vec.single(vec.usable(odd, zero=False))
    got = sorted(map(tuple, rotated_bits.nearest(found, found.where("id % 10 = 0"), 3).collect()))
    want = _best(known, [i for i in known if i % 10 == 0], math.dist, 3)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-12)
    empty = found.limit(0)
    assert rotated_bits.nearest(empty, empty, 3).count() == 0 == rotated_bits.nearest(found, empty, 3).count()


@pytest.mark.parametrize("bins", [2, 1024])
def test_top_of_odd_vectors(odd, monkeypatch, bins):
    monkeypatch.setattr(histogram_topk, "BINS", bins)
    known = {i: [math.floor(64 * x) for x in v] for i, v in _known(True).items()}
    found = vec.single(vec.usable(odd)).withColumn("v", F.transform("v", lambda x: F.floor(x * 64).cast("double")))
    got = sorted(map(tuple, histogram_topk.top(found, found.where("id % 10 = 0"), 3).collect()))
    want = _best(known, [i for i in known if i % 10 == 0], lambda a, b: -sum(x * y for x, y in zip(a, b, strict=True)), 3)
    assert got == [(q, n, i, -s) for q, n, i, s in want]
    empty = found.limit(0)
    assert histogram_topk.top(empty, empty, 3).count() == 0 == histogram_topk.top(found, empty, 3).count()


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, [float(2**29 + 3 * i), float(-(2**28) + i)]) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = sorted(map(tuple, histogram_topk.top(df, df.where("id < 3"), 4).collect()))
    whole = {i: list(map(int, v)) for i, v in rows}
    want = _best(whole, [0, 1, 2], lambda a, b: -sum(x * y for x, y in zip(a, b, strict=True)), 4)
    assert got == [(q, n, i, -s) for q, n, i, s in want]
    with pytest.raises(OverflowError):
        histogram_topk.top(spark.createDataFrame([(1, [1e300]), (2, [1e300])], "id long, v array<double>"), df.limit(0), 1)


@pytest.mark.parametrize("scores", [[-1.0 + 0.0157 * n for n in range(15)], [-300.0 + 40 * n for n in range(15)]])
def test_fewer_candidates_than_k_are_all_found(spark, scores):
    """Negative scores over a range that is narrow or wide for the first bins, and a second query with enough candidates."""
    rows = [(0, [64.0])] + [(n + 1, [float(math.floor(64 * s))]) for n, s in enumerate(scores)]
    rows += [(100 + n, [float(n - 20), 1.0]) for n in range(40)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = sorted(map(tuple, histogram_topk.top(df, df.where("id IN (0, 100)"), 20).collect()))
    whole = {i: list(map(int, v)) for i, v in rows}
    want = _best(whole, [0, 100], lambda a, b: -sum(x * y for x, y in zip(a, b, strict=True)), 20)
    assert got == [(q, n, i, -s) for q, n, i, s in want] and sum(q == 0 for q, *_ in got) == 15


def test_recall_over_blocks(spark, monkeypatch):
    """Many blocks, and a third of all rows one and the same vector."""
    monkeypatch.setattr(vec, "ROWS", 128)
    monkeypatch.setattr(vec, "QUERIES", 4)
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    rows = [(i, rows[0][1] if i % 3 == 0 else v) for i, v in rows]
    found = vec.single(vec.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), zero=False))
    got = {(r.query_id, r.vec_id) for r in rotated_bits.nearest(found, found.where("id % 50 = 0"), 10).collect()}
    want = {(q, i) for q, _, i, _ in _best(dict(rows), range(0, 500, 50), math.dist, 10)}
    assert len(got) == len(want) and len(got & want) >= 0.99 * len(want)


def test_rotation_keeps_lengths():
    x = np.random.default_rng(0).standard_normal((5, 64))
    assert np.allclose(np.linalg.norm(x @ rotated_bits.rotation(64), axis=1), np.linalg.norm(x, axis=1))


def test_a_long_vector_does_not_end_a_search(spark):
    rows = [(i, [float(i), 1.0]) for i in range(6)] + [(9, [1e300, 1.0])]
    fit = histogram_topk.fitting(spark.createDataFrame(rows, "id long, v array<double>"))
    got = sorted(map(tuple, histogram_topk.top(fit, fit.where("id IN (0, 9)"), 2).collect()))
    assert got == [(0, 1, 1, 1), (0, 2, 2, 1)]


def test_the_grid_grows_with_both_sides(spark, monkeypatch):
    """Every pair of blocks meets once, in cells that hold about as many pairs whatever the size."""
    assert vec.grid(2000, 20) == (12, 1) and vec.grid(0, 0)[1] >= 1
    across, down = vec.grid(10**9, 10**7)
    assert 0.9 <= across * down * vec.PAIRS / 10**16 <= 1.1 and across > down > 1
    monkeypatch.setattr(vec, "PAIRS", 8)
    monkeypatch.setattr(vec, "ROWS", 3)
    monkeypatch.setattr(vec, "QUERIES", 2)
    df = spark.createDataFrame([(i, [float(i * 7 % 13), float(i % 5)]) for i in range(40)], "id long, v array<double>")
    assert vec.grid(40, 20)[1] > 1
    got = sorted(map(tuple, histogram_topk.top(df, df.where("id % 2 = 0"), 5).collect()))
    whole = {i: [i * 7 % 13, i % 5] for i in range(40)}
    want = _best(whole, range(0, 40, 2), lambda a, b: -sum(x * y for x, y in zip(a, b, strict=True)), 5)
    assert got == [(q, n, i, -s) for q, n, i, s in want]
