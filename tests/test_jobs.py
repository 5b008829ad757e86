import pytest
from pyspark.sql import functions as F

from skyfold.plans import jobs
from skyfold.schema import LIGHTCURVE_SCHEMA, conform
from skyfold.workspace import checkpointed, shared_folder


@pytest.fixture()
def curves(documented, tmp_path):
    path = str(tmp_path / "curves")
    conform(documented).write.parquet(path)
    return path


def test_feature_job(spark, curves, tmp_path):
    target = str(tmp_path / "features")
    jobs.feature_job(spark, curves, target, parts=2)
    table = spark.read.parquet(target)
    assert len(table.columns) == 72 and table.count() == 1
    assert jobs.publish_features_job(spark, target, str(tmp_path / "store")) == 1
    assert jobs.publish_features_job(spark, target, str(tmp_path / "store")) == 0


def test_publish_job(spark, curves, tmp_path):
    store = str(tmp_path / "store")
    assert jobs.publish_lightcurves_job(spark, curves, store) == 1
    assert jobs.publish_lightcurves_job(spark, curves, store) == 0
    assert jobs.publish_lightcurves_job(spark, curves, store, drop=True) == 1


def test_labelled_curves_job(spark, curves, tmp_path):
    (tmp_path / "curves" / "broken.parquet").write_bytes(b"broken")
    labels = spark.createDataFrame(
        [(1550215200000003, 2, "variable"), (1, 2, "other")], "objectid long, filterid byte, kind string"
    )
    target = str(tmp_path / "labelled")
    jobs.labelled_curves_job(spark, labels, curves, target, ignore_corrupt=True)
    row = spark.read.parquet(target).first()
    assert row.kind == "variable" and row.fid == 2 and len(row.mag) == 25


def test_positions(spark):
    found = jobs.positions(spark.createDataFrame([], LIGHTCURVE_SCHEMA), "nepochs")
    assert found.columns == ["objectid", "filterid", "nepochs", "ra", "dec"]


def test_match_and_training_jobs(spark, documented, tmp_path):
    objects = jobs.positions(conform(documented))
    ra, dec = 35.6168823242188, 19.0562019348145
    infrared = spark.createDataFrame([(1, ra, dec + 1e-4, 1.0, 2.0), (2, ra, dec + 2e-4, 3.0, 4.0)],
                                     "source_id long, ra double, dec double, w1mpro_pm double, w2mpro_pm double")
    optical = spark.createDataFrame([(5, ra, dec, 20.0)], "objid long, RAJ2000 double, DEJ2000 double, gmag double")
    labels = spark.createDataFrame([("a", ra, dec, "x"), ("b", ra, dec, "y")], "source_id string, ra double, dec double, col1 string")
    target = str(tmp_path / "matches")
    jobs.write_matches(jobs.match_infrared(objects, infrared), target)
    first, second = jobs.match_optical(objects, optical, "objid"), spark.read.parquet(target)
    assert second.first().source_id_2 == 1 and first.first().gmag_2 == 20.0
    kept = jobs.match_labels(objects, labels, drop=("col1",))
    assert kept.columns == ["objectid", "filterid", "objra", "objdec", "source_id", "distance"] and kept.count() == 2
    features = conform(documented).select("objectid", "filterid", "nepochs")
    jobs.training_set_job(features, first, second, str(tmp_path / "set"))
    row = spark.read.parquet(str(tmp_path / "set")).first()
    assert (row.objectid, row.nepochs, row.objid, row.source_id) == (1550215200000003, 25, 5, 1)


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(root) and shared_folder(spark, "x") != shared_folder(spark, "x")
    assert checkpointed(spark.range(3), "numbers").count() == 3


def test_feature_job_run_again_adds_nothing(spark, curves, tmp_path):
    target = str(tmp_path / "again")
    for _ in range(2):
        jobs.feature_job(spark, curves, target)
    assert spark.read.parquet(target).count() == 1


def test_a_resumed_job_opens_only_files_with_work_left(spark, tmp_path):
    from test_features import noise, table

    from skyfold.features.sky import galactic_family
    from skyfold.plans.jobs import feature_job
    from skyfold.schema import conform

    rows = table(spark, *[noise(30, k) for k in range(6)])
    extra = {"fieldid": F.lit(1), "rcid": F.lit(1), "clrcoeff": F.transform("mag", lambda _: F.lit(0.0)), "catflags": F.transform("mag", lambda _: F.lit(0))}
    curves = conform(rows.withColumns(extra))
    source, target = str(tmp_path / "curves"), str(tmp_path / "features")
    curves.where("objectid < 2").coalesce(1).write.parquet(source)
    feature_job(spark, source, target, families=[galactic_family()])
    names = lambda: {r[0] for r in spark.read.parquet(source).select("_metadata.file_path").distinct().collect()}
    before = names()
    curves.where("objectid >= 2").coalesce(1).write.mode("append").parquet(source)
    new = names() - before
    pruned = spark.read.parquet(source).where(F.col("_metadata.file_path").isin(list(new)))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    opened = pruned.select("_metadata.file_path").distinct().count()
    assert "file_path" in plan and opened == len(new) == 1
    for _ in range(2):
        feature_job(spark, source, target, families=[galactic_family()])
    found = spark.read.parquet(target)
    assert found.count() == 6 == found.select("objectid").distinct().count()
