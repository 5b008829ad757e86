import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skyfold.operators import joins, layout


@pytest.fixture(scope="module")
def curves(spark):
    # Two thirds of the curves share one length.
    k = F.col("id")
    return spark.range(0, 3000, 1, 4).select(
        k.alias("objectid"),
        (k % 3 + 1).cast("byte").alias("filterid"),
        (k % 7).cast("short").alias("fieldid"),
        ((k * 137) % 360).cast("double").alias("objra"),
        ((k * 71) % 179 - 89).cast("double").alias("objdec"),
        F.when(k % 3 < 2, F.lit(25)).otherwise(k % 200).cast("long").alias("nepochs"),
    )


def files(path):
    return sorted(glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_split_by_band(spark, curves, tmp_path):
    path = str(tmp_path / "out")
    layout.split_by_band(curves, path, records=100)
    assert {f.split("/")[-2] for f in files(path)} == {"fid=1", "fid=2", "fid=3"}
    assert max(pq.read_metadata(f).num_rows for f in files(path)) <= 100
    back = spark.read.parquet(path)
    assert back.count() == 3000 and back.filter("fid != filterid").count() == 0


def test_split_by_epochs_spreads_a_common_length(spark, curves, tmp_path):
    path = str(tmp_path / "out")
    layout.split_by_epochs(curves, path, records=10_000, parts=6)
    assert spark.read.parquet(path).count() == 3000
    common = [f for f in files(path) if 25 in pq.read_table(f, columns=["nepochs"])["nepochs"].to_pylist()]
    assert len({f.split("part-")[1][:5] for f in common}) >= 3
    # Within a file the lengths are neighbours.
    spans = [
        max(v) - min(v) for f in files(path) for v in [pq.read_table(f, columns=["nepochs"])["nepochs"].to_pylist()]
    ]
    assert sorted(spans)[len(spans) // 2] < 60


def test_fixed_number_of_files(spark, curves, tmp_path):
    path = str(tmp_path / "out")
    layout.write_files(curves, path, 2)
    assert len(files(path)) == 2
    layout.write_files(curves.limit(10), path, 1)
    assert spark.read.parquet(path).count() == 10


def test_lookup_layout_separates_pixels(spark, curves, tmp_path):
    path = str(tmp_path / "out")
    layout.write_for_lookup(curves, path, level=4, parts=5)
    ranges = []
    for f in files(path):
        meta = pq.read_metadata(f)
        index = meta.schema.names.index("ipix")
        stats = [meta.row_group(g).column(index).statistics for g in range(meta.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    ranges.sort()
    assert len(ranges) == 5 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert spark.read.parquet(path).count() == 3000


def test_strip_suffix(spark):
    table = spark.createDataFrame([(1, 2, 3)], "objectid long, name_2 long, other long")
    assert joins.strip_suffix(table).columns == ["objectid", "name", "other"]
    with pytest.raises(ValueError, match="name"):
        joins.strip_suffix(table.withColumn("name", F.lit(1)))


def features(spark, *keys):
    return spark.createDataFrame([(o, f, 0.5) for o, f in keys], "objectid long, filterid int, Mean double")


def matches(spark, *rows):
    schema = "objectid long, filterid int, ra double, dec double, source_2 string, distance double"
    return spark.createDataFrame([(o, f, 0.0, 0.0, s, d) for o, f, s, d in rows], schema)


def test_outer_join_keeps_both_sides_and_their_keys(spark):
    left = features(spark, (1, 1), (2, 1), (None, 1))
    right = spark.createDataFrame([(1, 1, "a"), (3, 1, "b"), (3, 1, "c")], "objectid long, filterid int, name string")
    found = sorted(
        (r.objectid or 0, r.Mean or 0.0, r.name or "") for r in joins.join_outer(left, right).collect()
    )
    assert found == [(0, 0.5, ""), (1, 0.5, "a"), (2, 0.5, ""), (3, 0.0, "b"), (3, 0.0, "c")]


def test_training_set(spark):
    table = joins.training_set(
        features(spark, (1, 1), (2, 1)),
        matches(spark, (1, 1, "far", 0.2), (1, 1, "near", 0.1), (5, 1, "alone", 0.3), (6, 1, "too", 0.3)),
        matches(spark, (1, 1, "x", 0.1), (1, 1, "y", 0.1), (7, 2, "z", 0.4)).withColumnRenamed("source_2", "other_2"),
    )
    assert table.columns == ["objectid", "filterid", "Mean", "source", "other"]
    found = sorted((r.objectid, r.Mean or 0.0, r.source or "", r.other or "") for r in table.collect())
    assert found == [
        (1, 0.5, "near", "x"),
        (1, 0.5, "near", "y"),
        (2, 0.5, "", ""),
        (5, 0.0, "alone", ""),
        (6, 0.0, "too", ""),
        (7, 0.0, "", "z"),
    ]
