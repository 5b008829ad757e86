import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from skyfold.shipping import ship
    from skyfold.workspace import local_session

    shared = tmp_path_factory.mktemp("shared")
    session = local_session(8, 8, **{"spark.checkpoint.dir": str(shared)})
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def documented(spark):
    """One real curve, as a wide row of single-precision arrays."""
    from tests_data import documented_curve
    from pyspark.sql import types as T

    singles = T.ArrayType(T.FloatType())
    schema = T.StructType(
        [
            T.StructField("objectid", T.LongType()),
            T.StructField("filterid", T.ByteType()),
            T.StructField("fieldid", T.ShortType()),
            T.StructField("rcid", T.ByteType()),
            T.StructField("objra", T.DoubleType()),
            T.StructField("objdec", T.DoubleType()),
            T.StructField("nepochs", T.LongType()),
            *[T.StructField(name, singles) for name in ("hmjd", "mag", "magerr", "clrcoeff")],
            T.StructField("catflags", T.ArrayType(T.IntegerType())),
        ]
    )
    return spark.createDataFrame([documented_curve()], schema)
