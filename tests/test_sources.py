import hashlib

import pytest
from pyspark.sql import functions as F
from tests_data import LISTED, LISTED_SIZES, listing_page

from skyfold.functions import text
from skyfold.operators.incremental import new_rows, pending_by_name, pending_by_path
from skyfold.sources import listing, manifest

BASE = "https://data.example.org/release/"


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").coalesce(1)
    return [r.out for r in rows.select(expression(F.col("v")).alias("out")).collect()]


def test_sizes(spark):
    found = column(spark, ["313K  ", "10M", "1M", "-", "2.1M", "7B", "1.5G", "2T", "M", "", "3X", None], text.parse_size)
    assert found == [313_000, 10_000_000, 1_000_000, -1, 2_100_000, 7, 1_500_000_000, 2 * 10**12, -1, -1, -1, None]


def test_paths(spark):
    paths = ["s3://b/0/field0202/x.parquet", "x.parquet", "a/", "a/b"]
    assert column(spark, paths, text.basename) == ["x.parquet", "x.parquet", "", "b"]
    assert column(spark, paths, text.folder) == ["field0202", None, "a", "a"]
    assert column(spark, paths, text.last_two) == ["field0202/x.parquet", "x.parquet", "a/", "a/b"]
    assert column(spark, paths, text.is_folder) == [False, False, True, False]
    assert column(spark, ["a/field01/field0202/x", "a/x", "field7"], text.field_token) == ["field0202", None, "field7"]


def test_addresses(spark):
    assert column(spark, ["s3://bucket/a/b.parquet", "s3://bucket"], text.uri_bucket) == ["bucket", "bucket"]
    assert column(spark, ["s3://bucket/a/b.parquet", "s3://bucket/"], text.uri_path) == ["a/b.parquet", ""]
    for part in (text.uri_bucket, text.uri_path):
        with pytest.raises(Exception, match="s3 protocol"):
            column(spark, ["https://bucket/a"], part)


def test_listing_page(spark):
    address = "https://data.example.org/release/0/field0031/"
    pages = spark.createDataFrame([(address, listing_page()), (address, "<p>nothing</p>")], "url string, html string")
    rows = listing.listing_entries(pages).orderBy("date").collect()
    assert [(r.file, r.date, r["size"], r.folder) for r in rows] == [(address + n, d, x, n.endswith("/")) for n, d, x in sorted(LISTED, key=lambda e: e[1])]
    assert listing.page_links(pages).count() == len(LISTED) + 3


def test_size_by_field(spark):
    rows = [(f"https://x/release/0/{field}/{i}.parquet", size) for i, (field, size) in enumerate(LISTED_SIZES)]
    rows += [("https://x/release/0/field0031/", "-"), ("https://x/release/0/field0031/readme.txt", "9T")]
    found = listing.size_by_field(spark.createDataFrame(rows, "file string, size string")).collect()
    assert {r.field: (r.files, r.total_size) for r in found} == {"field0031": (3, 1_200_000 / 2**20), "field0044": (3, 3_002_500_500 / 2**20)}


def test_manifest(spark, tmp_path):
    path = tmp_path / "checksums.md5"
    path.write_text("aa  ./0/field0202/x.parquet\nbb\t./0/field01/field0203/y.parquet\n\ncc 1/z.parquet\n")
    rows = {r.checksum: r for r in manifest.read_manifest(spark, str(path), BASE).collect()}
    assert rows["aa"].file == BASE + "0/field0202/x.parquet" and rows["aa"].field == "field0202"
    assert rows["bb"].field == "field0203"
    assert rows["cc"].field is None and rows["cc"].file == BASE + "1/z.parquet"
    groups = manifest.manifest_by_field(manifest.read_manifest(spark, str(path), BASE)).collect()
    assert sorted((g.field, g.files) for g in groups) == [("field0202", 1), ("field0203", 1)]


@pytest.fixture()
def release(tmp_path):
    root = tmp_path / "release"
    for name, content in {"0/f1/x.parquet": b"one", "0/f1/y.parquet": b"two", "0/f2/w.parquet": b"four", "0/f2/empty.parquet": b"", "tmp/v.parquet": b"v"}.items():
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(content)
    return root


def test_list_files_skips_temporary_ones(spark, release):
    # The folder itself lies under one of that name.
    found = manifest.list_files(spark, f"file:{release}/")
    assert "tmp" in str(release)
    assert sorted((r.path.split("/")[-1], r.length) for r in found.collect()) == [
        ("w.parquet", 4),
        ("x.parquet", 3),
        ("y.parquet", 3),
    ]


def test_verification(spark, release):
    lines = [
        (hashlib.md5(b"one").hexdigest() + "  ./0/f1/x.parquet",),
        (hashlib.md5(b"other").hexdigest() + "  ./0/f1/y.parquet",),
        (hashlib.md5(b"four").hexdigest() + "  ./0/f2/w.parquet",),
        (hashlib.md5(b"gone").hexdigest() + "  ./0/f2/gone.parquet",),
    ]
    promised = manifest.parse_manifest(spark.createDataFrame(lines, "value string"), BASE)
    found = manifest.read_checksums(spark, str(release))
    status = {r.file.split("/")[-1]: r.status for r in manifest.verify(promised, found).collect()}
    assert status == {"x.parquet": "ok", "y.parquet": "mismatch", "w.parquet": "ok", "gone.parquet": "missing"}


def test_one_good_copy_is_enough(spark):
    promised = spark.createDataFrame([("aa", "x/1.p", "f")], "checksum string, file string, field string")
    copies = spark.createDataFrame([("a/1.p", "bb"), ("b/1.p", "aa"), ("c/1.p", "aa")], "path string, found string")
    assert [r.status for r in manifest.verify(promised, copies).collect()] == ["ok"]


def test_large_files_are_read_in_chunks(spark, release):
    whole, cut = ({r.path: r.found for r in manifest.read_checksums(spark, str(release), largest=n, chunk=2).collect()} for n in (100, 2))
    assert whole == cut and len(whole) == 4


def paths(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "path string")


def test_pending_by_name_and_by_path(spark):
    files = paths(spark, "s3://in/f1/a", "s3://in/f1/b", "s3://in/f2/b", "s3://in/f2/c")
    done = paths(spark, "s3://out/f1/b", "s3://out/f9/b", "s3://in/f2/c")
    assert sorted(r.path for r in pending_by_name(files, done).collect()) == ["s3://in/f1/a"]
    assert sorted(r.path for r in pending_by_path(files, done).collect()) == ["s3://in/f1/a", "s3://in/f1/b", "s3://in/f2/b"]
    doubled = files.union(paths(spark, "s3://in/f1/a"))
    assert pending_by_name(doubled, done).count() == 2


def test_new_rows_are_new_and_single(spark):
    batch = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (3, "d")], "_id long, name string")
    stored = spark.createDataFrame([(2, "old")], "_id long, name string")
    assert sorted((r._id, r.name) for r in new_rows(batch, stored, order=("name",)).collect()) == [(1, "a"), (3, "d")]
    assert sorted(r._id for r in new_rows(batch, stored).collect()) == [1, 3]


def test_pages_are_written_by_many_tasks(spark, tmp_path):
    import queries

    queries.write_pages(spark, "/root/testdata/sf0.001", str(tmp_path / "pages"))
    files = [f.name for f in (tmp_path / "pages").rglob("part-*")]
    assert len(files) == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert len({name.split("-")[1] for name in files}) > 1


def test_pages_share_folders(spark, tmp_path):
    """A folder for each task and not for each page, and the pages' bytes as they are, of pages that come twice together."""
    from skyfold.operators import layout

    rows = [(1, b"one"), (2, b"t\xff"), (3, None), (1, b"uno"), (None, b"x"), *[(n, b"%d" % n) for n in range(10, 60)]]
    texts = spark.createDataFrame(rows, "page_id long, raw binary").selectExpr("page_id", "cast(raw as string) as content")
    root = tmp_path / "pages"
    layout.write_texts(texts, str(root), "page_id", "content", 4)
    files = {f.name.split("page_id=")[1]: f.read_bytes() for f in root.rglob("part-*")}
    assert {files[f"{n}.txt"] for n in (2, 3, 10)} == {b"t\xff\n", b"\n", b"10\n"} and files["__HIVE_DEFAULT_PARTITION__.txt"] == b"x\n"
    assert sorted(files["1.txt"].split()) == [b"one", b"uno"] and len(files) == 54
    assert len([f for f in root.iterdir()]) <= 4 and not [f for f in root.rglob(".*")]
    with pytest.raises(FileExistsError):
        layout.write_texts(texts, str(root), "page_id", "content", 4)
    found = manifest.read_checksums(spark, str(root), largest=2, chunk=2)
    assert "binaryFile" not in found._jdf.queryExecution().toString() and "BinaryFile" not in found._jdf.queryExecution().toString()
    assert {r.path.split("page_id=")[1]: r.found for r in found.collect()} == {name: hashlib.md5(text).hexdigest() for name, text in files.items()}


def test_tasks_find_the_files_that_spark_finds(spark, tmp_path, monkeypatch):
    names = "a b c/d/e/f _h/i .j/k _l=1/m _metadata1/n _o .p q._COPYING_ r=1/_s t/u%20v".split()
    for i, name in enumerate([*names, "w x/y z", "c/empty"]):
        file = tmp_path / "in" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"" if name == "c/empty" else b"%d" % i * 5)
    ours = {(r.path, r.found) for r in manifest.read_checksums(spark, str(tmp_path / "in"), largest=5, chunk=3).collect()}
    monkeypatch.setattr(manifest, "local_folder", lambda *_: None)
    assert ours == {(r.path, r.found) for r in manifest.read_checksums(spark, str(tmp_path / "in")).collect()}
    assert len(ours) == 7
