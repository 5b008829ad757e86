import math

import pytest
from pyspark.sql import types as T

from skyfold.operators.preprocess import Preprocessor
from skyfold.schema import LIGHTCURVE_SCHEMA, conform
from skyfold.sources.lightcurves import read_lightcurves


def curve(objectid, errors, flags=None, band=1, stored=None):
    n = len(errors)
    stamps = [58000.0 + i for i in range(n)]
    flags = [0] * n if flags is None else flags
    stored = n if stored is None else stored
    return (objectid, band, 1, 1, 10.0, 20.0, stored, stamps, [15.0 + i for i in range(n)], errors, [0.0] * n, flags)


def run(spark, rows, **options):
    table = Preprocessor(**options).run(spark.createDataFrame(rows, LIGHTCURVE_SCHEMA))
    return {row.objectid: row for row in table.collect()}


def test_bad_epochs_leave_all_five_arrays(spark):
    errors = [0.1, 1.0, 1.5, math.nan, None, 0.2]
    found = run(spark, [curve(1, errors, [0, 0, 0, 0, 0, 32768])], limit_epochs=1)[1]
    assert found.nepochs == 2
    assert found.mag == [15.0, 16.0] and found.hmjd == [58000.0, 58001.0]
    assert found.catflags == [0, 0] and len(found.clrcoeff) == 2 and found.magerr[1] == 1.0


def test_tolerance_is_compared_in_single_precision(spark):
    # 0.1 as a float is above 0.1 as a double, and must be kept all the same.
    assert run(spark, [curve(1, [0.1])], limit_epochs=1, mag_error_tolerance=0.1)[1].nepochs == 1


def test_stored_and_true_counts_are_both_tested(spark):
    rows = [
        curve(1, [0.1] * 5, stored=3),
        curve(2, [0.1] * 3, stored=5),
        curve(3, [0.1] * 5),
        curve(4, [2.0] * 5),
    ]
    assert set(run(spark, rows, limit_epochs=5)) == {3}


def test_band_limits_drop_other_bands(spark):
    rows = [curve(1, [0.1] * 5), curve(2, [0.1] * 4, band=2), curve(3, [0.1], band=3), curve(4, [0.1] * 9, band=4)]
    assert set(run(spark, rows, limit_epochs={1: 5, 2: 5, 3: 1})) == {1, 3}
    assert run(spark, rows, limit_epochs={}) == {}


def test_other_flag_value(spark):
    assert run(spark, [curve(1, [0.1, 0.1], [0, 4])], limit_epochs=1, catflags_filter=4)[1].mag == [16.0]


@pytest.mark.parametrize("limit", ["5", 5.0, None, True, [5]])
def test_limit_of_another_type_is_refused(limit):
    with pytest.raises(TypeError):
        Preprocessor(limit_epochs=limit)


def test_nothing_left_is_an_empty_table(spark):
    table = Preprocessor().run(spark.createDataFrame([curve(1, [0.1])], LIGHTCURVE_SCHEMA))
    assert table.count() == 0 and table.schema == T.StructType(LIGHTCURVE_SCHEMA.fields)


@pytest.mark.parametrize("limit", [20, {1: 5, 2: 7}])
def test_stored_count_reaches_the_scan(spark, documented, tmp_path, limit):
    path = str(tmp_path / "curves")
    conform(documented).write.parquet(path)
    plan = Preprocessor(limit_epochs=limit).run(read_lightcurves(spark, path))
    text = plan._jdf.queryExecution().executedPlan().toString()
    pushed = text[text.index("PushedFilters") :].split("]")[0]
    assert "nepochs" in pushed
    assert "Exchange" not in text
