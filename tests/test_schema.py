import pytest
from pyspark.sql import functions as F

from skyfold.schema import EPOCH_COLUMNS, LIGHTCURVE_SCHEMA, conform, require_columns
from skyfold.sources.lightcurves import explode_epochs, objects, read_lightcurves


def test_conform_gives_the_exact_schema(documented):
    assert conform(documented).schema == LIGHTCURVE_SCHEMA
    shuffled = documented.select(*reversed(documented.columns)).withColumn("extra", F.lit(1))
    assert conform(shuffled).columns == LIGHTCURVE_SCHEMA.fieldNames()


def test_strict_conformance_refuses_what_does_not_fit(documented):
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        conform(documented.withColumn("filterid", F.lit(300))).collect()
    with pytest.raises(Exception, match="fractional value"):
        conform(documented.withColumn("nepochs", F.lit(1.5))).collect()
    with pytest.raises(Exception, match="fractional value"):
        conform(documented.withColumn("catflags", F.array(F.lit(0.5)))).collect()
    with pytest.raises(TypeError):
        conform(documented.withColumn("mag", F.lit(1.0)))


def test_lenient_conformance_gives_null(documented):
    row = conform(documented.withColumn("filterid", F.lit(300)), strict=False).first()
    assert row.filterid is None and row.nepochs == 25


def test_missing_columns_are_named(documented):
    with pytest.raises(ValueError, match="missing columns: mag"):
        conform(documented.drop("mag"))
    require_columns(documented, ("objectid",))


def test_corrupt_files_are_skipped_on_request(spark, documented, tmp_path):
    path = str(tmp_path / "curves")
    conform(documented).write.parquet(path)
    (tmp_path / "curves" / "broken.parquet").write_bytes(b"not a parquet file")
    assert read_lightcurves(spark, path, ignore_corrupt=True).count() == 1
    with pytest.raises(Exception):
        read_lightcurves(spark, path).collect()


def test_object_table_reads_no_arrays(spark, documented, tmp_path):
    path = str(tmp_path / "curves")
    conform(documented).write.parquet(path)
    table = objects(read_lightcurves(spark, path))
    assert not set(EPOCH_COLUMNS) & set(table.columns)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "array" not in plan[plan.index("ReadSchema") :]


def test_explode_keeps_every_epoch_in_place(documented):
    rows = explode_epochs(documented).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(25))
    assert rows[0].mag == pytest.approx(16.624181747436523) and rows[-1].hmjd == 58748.37109375
