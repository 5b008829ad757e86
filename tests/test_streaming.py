from skyfold.operators.preprocess import Preprocessor
from skyfold.schema import LIGHTCURVE_SCHEMA, conform
from skyfold.streaming.incremental import conform_new_files, preprocess_new_files


def rows(n, start=0):
    return [
        (start + i, 1, 1, 1, 10.0, 20.0, 2, [1.0, 2.0], [15.0, 16.0], [0.1, 2.0], [0.0, 0.0], [0, 0]) for i in range(n)
    ]


def test_each_file_is_processed_once(spark, tmp_path):
    source, target, log = (str(tmp_path / name) for name in ("in", "out", "log"))
    step = Preprocessor(limit_epochs=1)

    def run():
        preprocess_new_files(spark, source, target, log, step).awaitTermination()
        return spark.read.parquet(target)

    spark.createDataFrame(rows(5), LIGHTCURVE_SCHEMA).coalesce(1).write.parquet(f"{source}/field1")
    assert run().count() == 5
    spark.createDataFrame(rows(3, 5), LIGHTCURVE_SCHEMA).coalesce(1).write.parquet(f"{source}/field2")
    assert run().count() == 8
    assert run().count() == 8
    assert {r.nepochs for r in run().collect()} == {1}


def test_new_raw_files_get_the_exact_schema(spark, documented, tmp_path):
    source, target, log = (str(tmp_path / name) for name in ("raw", "out", "log"))
    documented.write.parquet(source)
    conform_new_files(spark, source, target, log, documented.schema).awaitTermination()
    back = spark.read.parquet(target)
    assert back.schema == conform(documented).schema and back.count() == 1
