"""Whitening and clustering against plain numpy, on odd and on whole tables."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import SF_DIR
from skyfold.llm import queries, va_file, whitening

NAN, INF = float("nan"), float("inf")
ODD = [
    (0, [1.0, 2.0]), (1, None), (2, []), (4, [NAN, 1.0]), (5, [INF, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, [1.0, 2.0]), (9, [1.0, 2.0]), (10, [-3.0, 0.5]),
    (11, [4.0, 4.0]), (11, [4.0, 4.0]), (11, [4.0, 3.01]), (None, [1.0, 1.0]), (20, [1.5, -2.0]), (21, [1e300, 1.0]), (22, [0.0, 0.0]), (23, [-0.001, 0.25]),
]


def odd(spark, rows=ODD):
    # Names that the operators use themselves.
    names = ("dim", "x", "ids", "n", "w", "key", "cells", "cluster", "distance", "c")
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *(F.lit(1).alias(c) for c in names)).repartition(3)


def usable(rows, dim, scale, shift):
    good = [(i, v) for i, v in rows if v and len(v) == dim and all(x is not None and math.isfinite(x) and abs(x) < 1e5 for x in v)]
    return [i for i, _ in good], np.array([[math.floor(scale * x) + shift for x in v] for _, v in good], np.int64).reshape(-1, dim)


def check_whitened(got, ids, x, most=32, weighted=True):
    # Components have a sign of their own, so they are compared without.
    n = len(x)
    fit = x if weighted else np.unique(x, axis=0)
    sums = [int(s) for s in fit.sum(0)]
    centred = np.array([[float(int(a) * len(fit) - s) / len(fit) for a, s in zip(row, sums)] for row in x])
    own = np.array([[float(int(a) * len(fit) - s) / len(fit) for a, s in zip(row, sums)] for row in fit])
    values, vectors = np.linalg.eigh(own.T @ own / len(fit))
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    want = centred @ vectors / np.sqrt(values)
    deviation = [sum((len(fit) * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert len(got) == n * len(values)
    trace = np.trace(own.T @ own / len(fit))
    rows = sorted(zip([-1 if i is None else i for i in ids], range(n)), key=lambda r: (r[0], deviation[r[1]]))
    found = sorted(got, key=lambda r: (-1 if r["vec_id"] is None else r["vec_id"], r["deviation"], r["component"]))
    signs = np.zeros(len(values))
    for k, (_, at) in enumerate(rows):
        for c in range(len(values)):
            row = found[k * len(values) + c] if len({i for i, _ in rows}) == n else None
            if row is None:
                continue
            assert (row["component"], row["n"], row["deviation"]) == (c + 1, len(fit), deviation[at])
            assert abs(row["whitened"]) == pytest.approx(abs(want[at, c]), rel=1e-6, abs=1e-6)
            assert row["explained"] == pytest.approx(values[c] / trace, rel=1e-9)
            assert row["identity_error"] < 1e-6
            if abs(want[at, c]) > 1e-3:
                sign = np.sign(row["whitened"] / want[at, c])
                assert signs[c] in (0, sign)
                signs[c] = sign
    assert sorted(r["deviation"] for r in got) == sorted(d for d in deviation for _ in values)


@pytest.mark.parametrize("weighted", [True, False])
def test_whitening_of_odd_vectors(spark, weighted):
    ids, x = usable(ODD, 2, 64, 1_000_000)
    got = whitening.whitened(odd(spark), weighted).collect()
    # The only vector of its own length has no variance, hence no component.
    assert {r["component"] for r in got} == {1, 2} and None in {r["vec_id"] for r in got} and 7 not in {r["vec_id"] for r in got}
    check_whitened(got, ids, x, weighted=weighted)
    unique = [(k, v) for k, (_, v) in enumerate(ODD)]
    ids, x = usable(unique, 2, 64, 1_000_000)
    check_whitened(whitening.whitened(odd(spark, unique), weighted).collect(), ids, x, weighted=weighted)


def test_whitening_of_nothing_and_of_large_numbers(spark):
    assert whitening.whitened(odd(spark).limit(0)).count() == 0
    assert whitening.whitened(odd(spark, [(1, [2.0, 3.0]), (2, [2.0, 3.0])])).count() == 0
    got = whitening.whitened(odd(spark, [(1, [4e7, 1.0]), (2, [-4e7, 3.0]), (3, [0.0, 7.0])])).collect()
    assert len(got) == 6 and {r["deviation"] for r in got} == {None, (3 * 64 * 7 - 64 * 11) ** 2}


def test_whitening_of_the_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    ids, x = usable(rows, 64, 64, 1_000_000)
    check_whitened(queries.op12_whitening(spark, SF_DIR).collect(), ids, x)


def clusters(rows, dim, scale, k=8, rounds=10, seed=3):
    ids, x = usable(rows, dim, scale, 0)
    key = [(i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()) for i in ids]
    order = sorted(range(len(ids)), key=lambda i: (key[i], x[i].astype(np.int32).tobytes()))[:k]
    centroids = [list(map(int, x[i])) for i in order]

    def assign():
        apart = [[sum((int(a) - b) ** 2 for a, b in zip(row, c)) for c in centroids] for row in x]
        return [a.index(min(a)) for a in apart], [min(a) for a in apart]

    for _ in range(rounds):
        own, _ = assign()
        for c in range(len(centroids)):
            mine = x[[i for i, o in enumerate(own) if o == c]]
            if len(mine):
                centroids[c] = [int(s) // len(mine) for s in mine.sum(0)]
    own, apart = assign()
    sums = [sum(d for o, d in zip(own, apart) if o == c) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((-1 if i is None else i), o, d, sums[o], sum(sums), digest[o]) for i, o, d in zip(ids, own, apart))


def listed(found):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, found.collect()))


@pytest.mark.parametrize("k, bits", [(8, 8), (3, 2), (20, 1)])
def test_clusters_of_odd_vectors(spark, k, bits):
    assert listed(va_file.clustered(odd(spark), k, rounds=3, dim=2, bits=bits)) == clusters(ODD, 2, 1024, k, 3)


def test_clusters_of_nothing(spark):
    assert va_file.clustered(odd(spark).limit(0)).count() == 0
    assert va_file.clustered(odd(spark)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_clusters_of_the_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert listed(queries.op13_va_file(spark, SF_DIR)) == clusters(rows, 64, 1024)


def test_fetches_are_a_part_and_move_no_full_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    kept = va_file.integers(table).withColumn("key", F.monotonically_increasing_id()).cache()
    cells = va_file.Cells(kept, 8)
    x = np.frombuffer(b"".join(r["x"] for r in kept.orderBy("key").select("x").collect()), np.int32).reshape(-1, 64)
    centroids = x[:8].astype(np.int64)
    state = kept.select("key", "x").toPandas()
    state["cells"] = [c.tobytes() for c in cells.of(np.frombuffer(b"".join(state["x"]), np.int32).reshape(-1, 64))]
    found = va_file._compared(spark.createDataFrame(state[["key", "cells"]]).withColumn("cluster", F.lit(-1)), cells, centroids).toPandas().sort_values("key")
    apart = ((x[:, None, :].astype(np.int64) - centroids) ** 2).sum(2)
    near = found["near"].to_numpy()
    # No interval that holds the nearest is left out, and most vectors need no fetch.
    assert ((near >> apart.argmin(1)) & 1).all()
    assert (near & (near - 1) != 0).mean() < 0.5
