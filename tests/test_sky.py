import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyfold.features.sky import with_galactic
from skyfold.functions import sphere
from skyfold.operators.xmatch import StoredCatalogue, nearest_one, nearest_with_ties, with_healpix, xmatch, xmatch_nearest


def places(spark, rows, key):
    return spark.createDataFrame(pd.DataFrame(rows, columns=[key, "ra", "dec"]))


def brute_force(a, b, radius):
    def unit(rows):
        ra, dec = np.radians(rows[:, 1]), np.radians(rows[:, 2])
        return np.stack([np.cos(dec) * np.cos(ra), np.cos(dec) * np.sin(ra), np.sin(dec)], axis=1)

    u, v = unit(a), unit(b)
    chord = np.linalg.norm(u[:, None, :] - v[None, :, :], axis=2)
    apart = np.degrees(2.0 * np.arcsin(np.minimum(chord / 2.0, 1.0)))
    close = np.argwhere(apart <= radius)
    edge = np.abs(apart - radius).min()
    return {(int(a[i, 0]), int(b[j, 0])) for i, j in close}, edge


def matched(spark, a, b, radius, **options):
    pairs = xmatch(places(spark, a, "objectid"), places(spark, b, "source_id"), radius, **options)
    found = [(int(r.objectid), int(r.source_id_2)) for r in pairs.select("objectid", "source_id_2").collect()]
    assert len(found) == len(set(found)), "a pair came twice"
    return set(found)


def crowded(rng, n, spread):
    """Points near both poles, across right ascension zero, and anywhere."""
    quarter = n // 4
    ra = np.concatenate(
        [rng.uniform(0, 360, 2 * quarter), rng.normal(0, spread, quarter) % 360, rng.uniform(0, 360, n - 3 * quarter)]
    )
    dec = np.concatenate(
        [
            90 - np.abs(rng.normal(0, spread, quarter)),
            -90 + np.abs(rng.normal(0, spread, quarter)),
            rng.normal(0, spread, quarter),
            rng.uniform(-90, 90, n - 3 * quarter),
        ]
    )
    special = np.array([[0, 90], [0, -90], [0, 0], [180, 90], [359.9999999, 0]])
    points = np.vstack([np.stack([ra, dec], axis=1), special])
    return np.hstack([np.arange(len(points))[:, None], points])


@pytest.mark.parametrize("radius,spread", [(1.5 / 3600, 2 / 3600), (2.0 / 3600, 2 / 3600), (0.05, 0.1), (1.0, 2.0)])
def test_match_equals_brute_force(spark, radius, spread):
    rng = np.random.default_rng(7)
    a, b = crowded(rng, 600, spread), crowded(rng, 500, spread)
    expected, edge = brute_force(a, b, radius)
    assert expected and edge > 1e-12
    assert matched(spark, a, b, radius) == expected


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), radius=st.floats(1e-4, 30.0), times=st.floats(1.0, 20.0))
def test_match_does_not_depend_on_the_cell(spark, seed, radius, times):
    rng = np.random.default_rng(seed)
    a, b = crowded(rng, 40, radius), crowded(rng, 40, radius)
    expected, edge = brute_force(a, b, radius)
    if edge > 1e-9:
        assert matched(spark, a, b, radius, cell=min(radius * times, 90.0)) == expected


def test_match_keeps_a_crowded_spot_whole(spark):
    a = np.column_stack([np.arange(600), np.full(600, 10.0), np.full(600, 20.0)])
    b = np.column_stack([np.arange(3), np.full(3, 10.0), 20.0 + np.array([0.0, 1e-4, 1.0])])
    assert len(matched(spark, a, b, 1.5 / 3600)) == 1200


def test_match_refuses_cells_smaller_than_the_radius(spark):
    point = places(spark, [(1, 0.0, 0.0)], "objectid")
    with pytest.raises(ValueError):
        xmatch(point, point, 1.0, cell=0.5)
    with pytest.raises(ValueError):
        xmatch(point, point, 0.0)


def test_match_is_an_equi_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        point = places(spark, [(1, 0.0, 0.0)], "objectid")
        plan = xmatch(point, point, 1.0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_rows_without_a_position_match_nothing(spark):
    some = spark.createDataFrame([(1, None, 0.0), (2, 0.0, 0.0)], "objectid long, ra double, dec double")
    assert matched_ids(xmatch(some, some.withColumnRenamed("objectid", "source_id"), 0.1)) == [(2, 2)]


def matched_ids(df):
    return sorted((r.objectid, r.source_id_2) for r in df.collect())


def test_nearest_is_one_row_with_a_fixed_tiebreak(spark):
    rows = [(1, 1, 2e-4, 30), (1, 1, 1e-4, 9), (1, 1, 1e-4 + 1e-10, 5), (2, 1, 0.1, 1)]
    table = spark.createDataFrame(rows, "objectid long, filterid int, distance double, source_id_2 long")
    for parts in (1, 4, 16):
        found = nearest_one(table.repartition(parts), tiebreak=("source_id_2",)).collect()
        assert sorted((r.objectid, r.source_id_2) for r in found) == [(1, 5), (2, 1)]


def test_nearest_with_ties_keeps_all_of_them(spark):
    rows = [(1, 1, 0.5, "a"), (1, 1, 0.5, "b"), (1, 1, 0.6, "c"), (1, 2, 0.9, "d"), (2, 1, None, "e")]
    table = spark.createDataFrame(rows, "objectid long, filterid int, distance double, name string")
    assert sorted(r.name for r in nearest_with_ties(table).collect()) == ["a", "b", "d", "e"]


def test_copies_in_the_catalogue_do_not_change_the_nearest(spark):
    objects = places(spark, [(i, 50.0 + i * 1e-5, 10.0) for i in range(20)], "objectid").withColumn("filterid", F.lit(1))
    single = [(7, 50.0001, 10.0), (90, 50.0, 10.0002)]
    copies = single + [(100 + i, 50.0001, 10.0) for i in range(300)]
    answers = []
    for catalogue in (single, copies):
        found = xmatch_nearest(objects, places(spark, catalogue, "source_id"), 2.0 / 3600, "source_id")
        answers.append(matched_ids(found))
    assert answers[0] == answers[1] and len(answers[0]) == 20


def test_searching_small_radii_first_changes_nothing(spark):
    rng = np.random.default_rng(2)
    disc = 1.0 / 3600 * np.sqrt(rng.uniform(size=(2, 400, 1))) * rng.normal(size=(2, 400, 2))
    sets = []
    for i, key in enumerate(("objectid", "source_id")):
        near = np.hstack([np.arange(400)[:, None], np.array([[40.0, 5.0]]) + disc[i]])
        spread = np.column_stack([np.arange(400, 500), np.full(100, 60.0) + np.arange(100) / 1000, rng.normal(0, 1e-4, 100)])
        sets.append(places(spark, np.vstack([near, spread]), key))
    objects = sets[0].withColumn("filterid", F.lit(1))
    plain = xmatch_nearest(objects, sets[1], 2 / 3600, "source_id")
    stepwise = xmatch_nearest(objects, sets[1], 2 / 3600, "source_id", first_radii=(0.05 / 3600, 0.4 / 3600))
    assert matched_ids(stepwise) == matched_ids(plain) and plain.count() > 400
    with pytest.raises(ValueError):
        xmatch_nearest(objects, sets[1], 2 / 3600, "source_id", first_radii=(3 / 3600,))


def test_distance_and_galactic_of_known_points(spark):
    row = (
        spark.range(1)
        .select(
            sphere.distance(F.lit(0.0), F.lit(0.0), F.lit(90.0), F.lit(0.0)).alias("quarter"),
            sphere.distance(F.lit(0.0), F.lit(90.0), F.lit(123.0), F.lit(90.0)).alias("pole"),
            F.lit(35.6168823242188).alias("objra"),
            F.lit(19.0562019348145).alias("objdec"),
        )
        .transform(with_galactic)
        .first()
    )
    assert row.quarter == pytest.approx(90.0) and row.pole == pytest.approx(0.0, abs=1e-9)
    assert row.gal_b == pytest.approx(-38.81819104042576, abs=1e-4)
    assert row.gal_l == pytest.approx(150.91923959702646, abs=1e-4)


@pytest.fixture(scope="module")
def uniform(spark):
    # Points spread evenly over the sphere by area.
    n = 60_000
    k = np.arange(n)
    dec = np.degrees(np.arcsin(1 - (2 * k + 1) / n))
    ra = (k * 137.50776405003785) % 360
    return spark.createDataFrame(pd.DataFrame({"k": k, "ra": ra, "dec": dec})).cache()


def test_pixels_have_equal_areas(spark, uniform):
    counts = with_healpix(uniform, 2).groupBy("ipix").count().toPandas()
    assert sorted(counts.ipix) == list(range(192))
    assert counts["count"].min() > 0.9 * 60_000 / 192 and counts["count"].max() < 1.1 * 60_000 / 192


def test_a_pixel_lies_inside_its_parent(spark, uniform):
    levels = [0, 1, 5, 12, 13, 29]
    table = uniform.select(*[sphere.healpix(F.col("ra"), F.col("dec"), v).alias(f"p{v}") for v in levels])
    for low, high in zip(levels, levels[1:]):
        strays = table.filter(F.shiftright(f"p{high}", 2 * (high - low)) != F.col(f"p{low}"))
        assert strays.count() == 0
    top = table.agg(*[F.max(f"p{v}").alias(f"p{v}") for v in levels]).first()
    assert all(top[f"p{v}"] < 12 * 4**v for v in levels)


@pytest.mark.parametrize(
    "ra,dec,base", [(0, 0, 4), (90, 0, 5), (180, 0, 6), (270, 0, 7), (45, 60, 0), (315, 60, 3), (45, -60, 8), (225, -89, 10)]
)
def test_base_pixels(spark, ra, dec, base):
    row = spark.range(1).select(sphere.healpix(F.lit(float(ra)), F.lit(float(dec)), 0).alias("p")).first()
    assert row.p == base


def test_neighbours_in_a_pixel_are_close(spark, uniform):
    # A pixel of level 6 is about 0.92 degrees wide; no two members are far apart.
    spread = (
        with_healpix(uniform, 6)
        .groupBy("ipix")
        .agg((F.max("dec") - F.min("dec")).alias("height"))
        .agg(F.max("height").alias("height"))
        .first()
    )
    assert spread.height < 1.4


BAD = [float("nan"), float("inf"), float("-inf"), -999.0, 999.0]


@pytest.mark.parametrize("spread", ["catalogue", "objects"])
def test_default_positions_make_no_rows(spark, spread):
    rows = [(i, 10.0, bad) for i, bad in enumerate(BAD)] + [(10 + i, bad, 5.0) for i, bad in enumerate(BAD[:3])] + [(20, 10.0, 5.0)]
    here = spark.createDataFrame(rows, "id long, ra double, dec double")
    found = xmatch(here, here, 2.0 / 3600.0, spread=spread)
    assert [(r.id, r.id_2) for r in found.collect()] == [(20, 20)]
    nearest = xmatch_nearest(here, here, 2.0 / 3600.0, "id", keys=("id",))
    assert [(r.id, r.id_2) for r in nearest.collect()] == [(20, 20)]


def test_either_side_may_be_spread(spark):
    rng = np.random.default_rng(31)
    a = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform((0, -90), (360, 90), (300, 2)))], "id long, ra double, dec double")
    pairs = [sorted((r.id, r.id_2) for r in xmatch(a, a, 5.0, spread=side).collect()) for side in ("catalogue", "objects")]
    assert pairs[0] == pairs[1] and len(pairs[0]) > 300


@pytest.mark.parametrize("parts", [1, 3])
def test_a_stored_catalogue_serves_many_matches(spark, parts):
    """Each radius gives the pairs of a match of its own, and only objects are sent; a third of them is in one place."""
    rng = np.random.default_rng(5)
    a = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform((359.99, 10), (360, 10.01), (60, 2)))] + [(100 + i, 359.995, 10.005) for i in range(30)]
    b = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform((359.99, 10), (360, 10.01), (90, 2)))] + [(200, 0.0001, 10.005), (201, None, 1.0), (202, 5.0, -999.0)]
    objects, catalogue = spark.createDataFrame(a, "a long, ra double, dec double"), spark.createDataFrame(b, "b long, ra double, dec double")
    stored = StoredCatalogue(catalogue, 0.002, 4, parts)
    for radius in (0.0005, 0.001, 0.002):
        found = stored.xmatch(objects, radius)
        want = xmatch(objects, catalogue, radius)
        assert found.columns == want.columns
        pairs = sorted((r.a, r.b_2, r.distance) for r in found.collect())
        assert pairs and pairs == sorted((r.a, r.b_2, r.distance) for r in want.collect())
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("Exchange ") == 1 and "SortMergeJoin" in plan
    with pytest.raises(ValueError):
        stored.xmatch(objects, 0.003)


def test_neither_side_of_a_match_is_sent_whole(spark):
    """Small tables too: the sizes that Spark goes by are those of packed files."""
    from skyfold.operators import joins
    from skyfold.operators.xmatch import xmatch, xmatch_nearest

    objects = spark.createDataFrame([(1, 1, 10.0, 10.0), (2, 1, 20.0, 20.0)], "objectid long, filterid long, ra double, dec double")
    catalogue = spark.createDataFrame([(7, 10.0, 10.0), (8, 20.0, 20.0001)], "source_id long, ra double, dec double")
    one = xmatch_nearest(objects, catalogue, 0.001, "source_id").drop("ra_2", "dec_2")
    other = one.withColumnRenamed("source_id_2", "obj_id_2")
    features = spark.createDataFrame([(1, 1, 3.0), (5, 2, 4.0)], "objectid long, filterid long, Mean double")
    table = joins.training_set(features, one, other)
    assert sorted((r.objectid, r.source_id, r.obj_id) for r in table.collect() if r.source_id) == [(1, 7, 7), (2, 8, 8)]
    assert table.count() == 3
    for df in (xmatch(objects, catalogue, 0.001), one, table):
        df.collect()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
