import base64
import json

import pytest
from pyspark.sql import functions as F
from tests_data import HMJD, MAG, MAGERR

from skyfold.operators import publish
from skyfold.schema import conform
from skyfold.sources import documents as store


def test_document_of_the_documented_curve(documented):
    row = publish.lightcurve_documents(documented, binary=True).first()
    assert row["_id"] == 1550215200000003 and row.nepochs == 25
    assert base64.b64encode(bytes(row.hmjd)).decode() == HMJD
    assert base64.b64encode(bytes(row.mag)).decode() == MAG
    assert base64.b64encode(bytes(row.magerr)).decode() == MAGERR
    assert row.loc.type == "Point"
    assert row.loc.coordinates == pytest.approx([-144.383117675781, 19.0562019348145], abs=1e-9)
    assert "catflags" not in row and "clrcoeff" not in row


def test_bytes_keep_the_width_of_the_arrays(documented):
    row = publish.lightcurve_documents(conform(documented), binary=True).first()
    assert len(row.hmjd) == 25 * 8 and len(row.mag) == 25 * 4


def test_binary_round_trip(spark):
    rows = spark.createDataFrame([([1.5, -2.25],), ([],), (None,)], "v array<double>").coalesce(1)
    packed = rows.withColumn("b", publish.to_binary("v", "<f8")).withColumn("back", publish.from_binary("b", "<f8"))
    assert [r.back for r in packed.collect()] == [[1.5, -2.25], [], None]


def documents(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "_id long, name string")


def test_store_takes_each_document_once(spark, tmp_path):
    path = str(tmp_path / "store")
    assert publish.append_new(documents(spark, 1, 2, 2), path) == 2
    assert publish.append_new(documents(spark, 2, 3, 4), path) == 2
    assert publish.append_new(documents(spark, 1, 2), path) == 0
    assert sorted(r._id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]
    assert publish.append_new(documents(spark, 9, 9), path, drop=True) == 1
    assert [r._id for r in spark.read.parquet(path).collect()] == [9]


def test_batches_reach_the_store(spark, tmp_path):
    folder = str(tmp_path)

    def connect():
        import uuid

        def insert(batch):
            with open(f"{folder}/{uuid.uuid4().hex}.json", "w") as out:
                json.dump([{"_id": int(d["_id"]), "name": d["name"]} for d in batch], out)

        return insert

    assert publish.insert_batches(documents(spark, *range(25)).repartition(2), connect, batch_size=4) == 25
    batches = [json.loads(f.read_text()) for f in tmp_path.iterdir()]
    assert max(len(b) for b in batches) == 4
    assert sorted(d["_id"] for b in batches for d in b) == list(range(25))
    assert publish.insert_batches(documents(spark, 1).filter("_id = 0"), connect) == 0


def test_feature_documents_use_the_object_as_key(spark):
    table = spark.createDataFrame([(7, 0.5)], "objectid long, Mean double")
    assert publish.feature_documents(table).columns == ["_id", "Mean"]


def test_band_limits_of_published_curves(documented):
    short = documented.withColumn("magerr", F.transform("magerr", lambda e, i: F.when(i < 4, e)))
    assert publish.lightcurve_documents(short).count() == 0
    assert publish.lightcurve_documents(short.withColumn("filterid", F.lit(3))).count() == 1


def test_a_store_shows_what_has_been_committed(spark, tmp_path):
    path = str(tmp_path / "store")
    store.register(spark)
    ids = lambda: sorted(r._id for r in store.read(spark, path, documents(spark).schema).collect())
    save = lambda df, mode="append": df.write.format("documents").mode(mode).option("batch_size", 4).save(path)
    assert ids() == []
    save(documents(spark, *range(25)).repartition(3))
    assert ids() == list(range(25)) and [one["rows"] for one in store.lists(path)] == [25]
    # A job that breaks after some rows have been staged leaves nothing.
    broken = documents(spark, *range(100, 140)).repartition(2).where("if(_id = 139, raise_error('lost'), true)")
    with pytest.raises(Exception):
        save(broken)
    assert ids() == list(range(25))
    save(documents(spark, 30))
    assert ids() == [*range(25), 30]
    save(documents(spark, 7, 8), "overwrite")
    save(documents(spark).where("false"))
    assert ids() == [7, 8] and len(store.lists(path)) == 2


def test_a_task_that_runs_twice_inserts_once(spark, tmp_path):
    """Two attempts of one task stage a file each; the one whose message arrives counts."""
    import pyarrow as pa

    path = str(tmp_path / "store")
    batches = [pa.record_batch({"_id": pa.array(range(n, n + 3), pa.int64())}) for n in (0, 3, 6)]
    writer = store.DocumentWriter(path, False, 4)
    lost, kept, other = writer.write(iter(batches[:1])), writer.write(iter(batches)), writer.write(iter([]))
    assert lost.rows == 3 and (other.file, other.rows) == (None, 0)
    writer.commit([kept, None, other])
    assert sorted(r._id for r in store.read(spark, path).collect()) == list(range(9))
    assert [pa.parquet.ParquetFile(f"{path}/{kept.file}").metadata.row_group(k).num_rows for k in range(3)] == [4, 4, 1]
    writer.abort([lost])
    assert sorted(r._id for r in store.read(spark, path).collect()) == list(range(9))
