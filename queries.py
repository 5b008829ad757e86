"""The registered queries: each reads the driver's tables and runs one operator over all of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import fixtures as fx
from skyfold.features import fits, period, statistics
from skyfold.features.registry import compute_features
from skyfold.features.sky import galactic_family, with_galactic
from skyfold.functions import curves, text
from skyfold.operators import incremental, joins, layout, publish
from skyfold.operators.preprocess import Preprocessor
from skyfold.operators.xmatch import StoredCatalogue, nearest_one, nearest_with_ties, with_healpix, xmatch, xmatch_nearest
from skyfold.plans import jobs
from skyfold.schema import LIGHTCURVE_SCHEMA, conform
from skyfold.sources import documents, listing, manifest
from skyfold.sources.lightcurves import explode_epochs, objects, read_lightcurves
from skyfold.streaming.incremental import conform_new_files, preprocess_new_files
from skyfold.workspace import checkpointed, shared_folder

BASE_URL = "https://data.example.org/release/"
LIMIT = 5
FEATURE_LIMIT = 20
BAND_LIMITS = {1: 5, 2: 10, 3: 20}
ARCSEC = 1.0 / 3600.0

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[function.__name__] = function
    return function


def r6(value: str | Column, places: int = 6) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    column = F.col(f"`{value}`") if isinstance(value, str) else value
    return F.round(column.cast("double"), places) + F.lit(0.0)


def rounded(df: DataFrame, keys: tuple[str, ...], values: tuple[str, ...], places: int = 6) -> DataFrame:
    return df.select(*keys, *[r6(v, places).alias(v) for v in values])


def kept(spark: SparkSession, sf_dir: str, limit: int = LIMIT) -> DataFrame:
    return Preprocessor(limit_epochs=limit).run(fx.lightcurves(spark, sf_dir))


def epochs_of(df: DataFrame) -> DataFrame:
    """Every epoch of every curve, for a whole comparison of the arrays."""
    rows = explode_epochs(df)
    return rows.select(
        F.col("objectid").cast("long").alias("objectid"),
        F.col("filterid").cast("long").alias("filterid"),
        F.col("nepochs").cast("long").alias("nepochs"),
        r6("hmjd").alias("hmjd"),
        r6("mag").alias("mag"),
        r6("magerr").alias("magerr"),
        r6("clrcoeff").alias("clrcoeff"),
        F.col("catflags").cast("long").alias("catflags"),
    )


# ------------------------------------------------------- scans, sources, sinks


@query
def scan_lightcurves(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "scan")
    conform(fx.lightcurves(spark, sf_dir)).write.parquet(path)
    return epochs_of(read_lightcurves(spark, path))


@query
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = conform(fx.lightcurves(spark, sf_dir))
    assert table.schema.simpleString() == LIGHTCURVE_SCHEMA.simpleString()
    return epochs_of(table)


@query
def conform_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "conform")
    raw = fx.lightcurves(spark, sf_dir)
    raw.write.parquet(f"{root}/raw")
    conform_new_files(spark, f"{root}/raw", f"{root}/out", f"{root}/log", raw.schema).awaitTermination()
    return epochs_of(read_lightcurves(spark, f"{root}/out"))


@query
def manifest_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.derived(spark, sf_dir, fx.manifest_sql(), "pages", "labels")
    return manifest.parse_manifest(lines, BASE_URL)


@query
def manifest_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest_by_field(manifest_parse(spark, sf_dir))


@query
def verify_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    promised = manifest_parse(spark, sf_dir)
    stored = fx.derived(spark, sf_dir, fx.files_sql(), "pages").join(
        spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic = 1").select(F.col("doc_id").alias("page_id")),
        "page_id",
        "left_anti",
    )
    found = manifest.with_checksum(stored.select("path", F.col("content").cast("binary").alias("content")))
    return manifest.verify(promised, found)


@query
def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions written to a folder per band; bands with their rows and whether files of theirs are listed."""
    path = shared_folder(spark, "listed")
    layout.split_by(fx.sky(spark, sf_dir).withColumn("fid", F.col("filterid")), path, "fid")
    found = manifest.list_files(spark, path).filter("length > 0")
    fid = F.regexp_extract("path", "fid=([0-9]+)/", 1).cast("long").alias("filterid")
    listed = found.select(fid).distinct().withColumn("listed", F.lit(True))
    rows = spark.read.parquet(path).groupBy(F.col("filterid").cast("long").alias("filterid")).agg(F.count("*").alias("objects"))
    return rows.join(listed, "filterid", "left").select("filterid", "objects", F.coalesce("listed", F.lit(False)).alias("listed"))


def write_pages(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A file for each page, written by as many tasks as shuffles have: a file costs far more than its bytes, which splits go by."""
    stored = fx.derived(spark, sf_dir, fx.files_sql(), "pages")
    layout.write_texts(stored, path, "page_id", "content", int(spark.conf.get("spark.sql.shuffle.partitions")))


@query
def file_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to files of their own and checked by reading them back, half of them in chunks."""
    path = shared_folder(spark, "pages")
    write_pages(spark, sf_dir, path)
    found = manifest.read_checksums(spark, path, largest=3000, chunk=1000)
    return found.select(F.regexp_extract("path", "page_id=([0-9]+)[/.]", 1).cast("long").alias("page_id"), "found")


@query
def listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return listing.page_links(pages).select(
        "page_id", "file", "folder"
    )


@query
def size_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = fx.derived(spark, sf_dir, fx.listing_sql(), "part")
    return rounded(listing.size_by_field(entries), ("field", "files"), ("total_size",))


@query
def split_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "bands")
    layout.split_by_band(fx.lightcurves(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    return stored.select("objectid", F.col("fid").cast("long").alias("fid"), "nepochs", mag_sum())


@query
def split_by_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "epochs")
    layout.split_by_epochs(fx.lightcurves(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    return stored.select("objectid", F.col("fid").cast("long").alias("fid"), "nepochs", mag_sum())


def mag_sum() -> Column:
    return r6(F.expr(curves.total("cast(mag as array<double>)"))).alias("mag_sum")


@query
def publish_lightcurves(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "documents")
    publish.append_new(publish.lightcurve_documents(fx.lightcurves(spark, sf_dir), binary=True), path)
    stored = spark.read.parquet(path)
    stored = stored.withColumns({c: publish.from_binary(c, "<f8") for c in publish.SERIES})
    sums = [r6(F.expr(curves.total(c))).alias(f"{c}_sum") for c in publish.SERIES]
    return stored.select(
        "_id",
        F.col("filterid").cast("long").alias("filterid"),
        "nepochs",
        F.col("loc.type").alias("loc_type"),
        r6(F.get("loc.coordinates", F.lit(0))).alias("lon"),
        r6(F.get("loc.coordinates", F.lit(1))).alias("lat"),
        *sums,
    )


def _comparable(features: DataFrame, key: str) -> DataFrame:
    """Features of the standard table, each rounded as in the query of its own."""
    groups = ("gal_b", "gal_l", *(c for g in STAT_GROUPS.values() for c in g), "Pvar", "Autocor_length", "AndersonDarling", "SF_ML_gamma")
    fitted = ("IAR_phi", "Multiband_period", "PPE", *period.POWER_RATES)
    return features.select(
        key, "nepochs", *(r6(c).alias(c) for c in (*groups, *fitted)), r6("MHPS_ratio", 4).alias("MHPS_ratio"),
        *(r6(c, 12).alias(c) for c in ("MHPS_low", "MHPS_high")), "MHPS_non_zero", "MHPS_PN_flag",
        r6(F.log10("SF_ML_amplitude")).alias("log_amplitude"), r6(F.ln("GP_DRW_sigma"), 3).alias("log_sigma"), r6(F.ln("GP_DRW_tau"), 3).alias("log_tau"),
    )


@query
def publish_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of every curve, published and read back."""
    path = shared_folder(spark, "feature-documents")
    table = compute_features(kept(spark, sf_dir, FEATURE_LIMIT))
    publish.append_new(publish.feature_documents(table), path)
    return _comparable(spark.read.parquet(path), "_id")


@query
def insert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents inserted in batches through the data source, half of them in each of two jobs, and read back."""
    path = shared_folder(spark, "document-store")
    documents.register(spark)
    table = publish.feature_documents(_kept_counts(fx.lightcurves(spark, sf_dir)))
    for mode, part in (("overwrite", "_id >= 0"), ("overwrite", "_id % 2 = 0"), ("append", "_id % 2 <> 0")):
        table.where(part).write.format("documents").mode(mode).option("batch_size", 1000).save(path)
    rows = sum(one["rows"] for one in documents.lists(path))
    return documents.read(spark, path).select("_id", "nepochs", F.lit(rows).cast("long").alias("inserted"))


@query
def publish_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a store holds after a part, the whole and the whole anew have been published to it, and the counts returned."""
    path = shared_folder(spark, "store")
    table = checkpointed(publish.feature_documents(_kept_counts(fx.lightcurves(spark, sf_dir))), "documents")
    first = publish.append_new(table.where("_id % 3 = 0"), path)
    second = publish.append_new(table, path)
    third = publish.append_new(table, path)
    fourth = publish.append_new(table, path, drop=True)
    counts = [F.lit(n).cast("long").alias(c) for n, c in ((first, "part"), (second, "rest"), (third, "again"), (fourth, "anew"))]
    return spark.read.parquet(path).select("_id", "nepochs", *counts)


@query
def features_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature job over a part of the curves, then twice over all of them."""
    root = shared_folder(spark, "feature-job")
    curves_ = checkpointed(fx.lightcurves(spark, sf_dir), "curves")
    conform(curves_.where("objectid % 2 = 0")).write.parquet(f"{root}/curves")
    jobs.feature_job(spark, f"{root}/curves", f"{root}/features")
    conform(curves_.where("objectid % 2 <> 0")).write.mode("append").parquet(f"{root}/curves")
    for _ in range(2):
        jobs.feature_job(spark, f"{root}/curves", f"{root}/features")
    # Stored curves and features have single precision.
    found = spark.read.parquet(f"{root}/features")
    return found.select("objectid", "nepochs", *(r6(c, 1).alias(c) for c in ("gal_b", "gal_l", "Mean", "Std", "Amplitude")))


@query
def fixed_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions written to seven files and read back."""
    path = shared_folder(spark, "files")
    layout.write_files(fx.sky(spark, sf_dir), path, 7)
    return spark.read.parquet(path).select("objectid", F.col("filterid").cast("long").alias("filterid"), r6("ra").alias("ra"), r6("dec").alias("dec"))


@query
def lookup_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curves laid out by sky pixel and read back by a range of pixels: both halves make the whole."""
    path = shared_folder(spark, "lookup")
    layout.write_for_lookup(checkpointed(fx.lightcurves(spark, sf_dir), "curves"), path)
    stored = spark.read.parquet(path)
    half = 6 * 4**6
    halves = stored.where(F.col("ipix") < half).unionByName(stored.where(F.col("ipix") >= half))
    return halves.select("objectid", F.col("filterid").cast("long").alias("filterid"), "nepochs", mag_sum())


# ------------------------------------------------------ projections and filters


def _kept_counts(df: DataFrame) -> DataFrame:
    return df.select("objectid", F.col("filterid").cast("long").alias("filterid"), "nepochs")


@query
def nepochs_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_counts(Preprocessor(limit_epochs=20).discard_by_nepochs(fx.lightcurves(spark, sf_dir)))


@query
def nepochs_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_counts(Preprocessor(limit_epochs=BAND_LIMITS).discard_by_nepochs(fx.lightcurves(spark, sf_dir)))


@query
def epoch_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epochs_of(Preprocessor().filter_epochs(fx.lightcurves(spark, sf_dir)))


@query
def preprocess_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epochs_of(Preprocessor(limit_epochs=10).run(fx.lightcurves(spark, sf_dir)))


@query
def preprocess_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epochs_of(Preprocessor(limit_epochs=BAND_LIMITS).run(fx.lightcurves(spark, sf_dir)))


@query
def preprocess_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "preprocess")
    raw = fx.lightcurves(spark, sf_dir)
    raw.write.parquet(f"{root}/in")
    preprocess_new_files(
        spark, f"{root}/in", f"{root}/out", f"{root}/log", Preprocessor(limit_epochs=10), raw.schema
    ).awaitTermination()
    return epochs_of(spark.read.schema(raw.schema).parquet(f"{root}/out"))


@query
def geo_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = publish.geo_point(F.col("ra"), F.col("dec"))
    table = fx.sky(spark, sf_dir).withColumn("loc", point)
    return table.select(
        "objectid",
        F.col("loc.type").alias("loc_type"),
        r6(F.get("loc.coordinates", F.lit(0))).alias("lon"),
        r6(F.get("loc.coordinates", F.lit(1))).alias("lat"),
    )


@query
def arrays_to_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = fx.lightcurves(spark, sf_dir).withColumn("blob", publish.to_binary("mag", "<f4"))
    table = packed.withColumn("back", publish.from_binary("blob", "<f4"))
    return table.select(
        "objectid",
        F.octet_length("blob").cast("long").alias("bytes"),
        r6(F.expr(curves.total("back"))).alias("mag_sum"),
    )


@query
def objects_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = objects(fx.lightcurves(spark, sf_dir))
    longs = [F.col(c).cast("long").alias(c) for c in ("objectid", "filterid", "fieldid", "rcid", "nepochs")]
    return table.select(*longs, r6("objra").alias("objra"), r6("objdec").alias("objdec"))


@query
def strip_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = xmatch(fx.sky(spark, sf_dir), fx.infrared(spark, sf_dir), 1.5 * ARCSEC)
    stripped = joins.strip_suffix(matches.drop("ra", "dec"))
    return rounded(stripped, ("objectid", "filterid", "source_id"), ("ra", "dec", "w1mpro_pm", "w2mpro_pm"))


# ---------------------------------------------------------------- sky matches


@query
def healpix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_healpix(fx.infrared(spark, sf_dir), 12).select("source_id", "ipix")


def _infrared_pairs(spark: SparkSession, sf_dir: str, radius: float) -> DataFrame:
    return xmatch(fx.sky(spark, sf_dir), fx.infrared(spark, sf_dir), radius)


@query
def xmatch_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _infrared_pairs(spark, sf_dir, 1.5 * ARCSEC)
    return pairs.select("objectid", "filterid", F.col("source_id_2"), r6("distance", 9).alias("distance"))


@query
def xmatch_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three matches, each of another radius, against one catalogue that is stored by cell."""
    stored = StoredCatalogue(fx.infrared(spark, sf_dir).select("source_id", "ra", "dec"), 2.0 * ARCSEC, buckets=16)
    objects_ = fx.sky(spark, sf_dir)
    found = [stored.xmatch(objects_, r * ARCSEC).withColumn("radius", F.lit(r)) for r in (1.0, 1.5, 2.0)]
    pairs = found[0].unionByName(found[1]).unionByName(found[2])
    return pairs.select("radius", "objectid", "filterid", "source_id_2", r6("distance", 9).alias("distance"))


@query
def xmatch_nearest_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = xmatch_nearest(fx.sky(spark, sf_dir), fx.infrared(spark, sf_dir), 1.5 * ARCSEC, "source_id")
    return matches.select("objectid", "filterid", "source_id_2", r6("distance", 9).alias("distance"))


@query
def xmatch_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects_ = fx.sky(spark, sf_dir)
    matches = jobs.match_labels(objects_, fx.label_positions(spark, sf_dir), drop=("source_period",))
    return rounded(
        matches,
        ("objectid", "filterid", "source_id", "source_cat", "source_class", "source_flag"),
        ("objra", "objdec"),
    )


@query
def xmatch_infrared(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = jobs.match_infrared(fx.sky(spark, sf_dir), fx.infrared(spark, sf_dir))
    return rounded(matches, ("objectid", "filterid", "source_id_2"), ("w1mpro_pm_2", "w2mpro_pm_2"))


@query
def xmatch_optical(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = jobs.match_optical(fx.sky(spark, sf_dir), fx.optical(spark, sf_dir), "obj_id")
    return matches.select("objectid", "filterid", "obj_id_2", "brand_2", r6("distance", 9).alias("distance"))


@query
def nearest_rank_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _infrared_pairs(spark, sf_dir, 2.0 * ARCSEC)
    steps = pairs.withColumn("distance", F.round(F.col("distance") * 3600.0, 2))
    return nearest_with_ties(steps).select("objectid", "filterid", "source_id_2", r6("distance").alias("distance"))


@query
def nearest_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _infrared_pairs(spark, sf_dir, 2.0 * ARCSEC)
    best = nearest_one(pairs, tiebreak=("source_id_2",))
    return best.select("objectid", "filterid", "source_id_2", r6("distance", 9).alias("distance"))


# ----------------------------------------------------------------------- joins


@query
def join_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joins.join_labels(fx.label_keys(spark, sf_dir), fx.lightcurves(spark, sf_dir))
    rows = explode_epochs(joined)
    return rounded(rows, ("objectid", "filterid", "source_class"), ("hmjd", "mag", "magerr"))


def _metadata_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored feature table, as the join needs it."""
    table = statistics.with_moments(kept(spark, sf_dir))
    named = table.select("objectid", F.col("filterid").cast("long").alias("filterid"), "nepochs", "Mean", "Std")
    return checkpointed(named, "features")


def _keyed_sky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.sky(spark, sf_dir).withColumn("filterid", F.col("filterid").cast("long"))


def _optical_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpointed(jobs.match_optical(_keyed_sky(spark, sf_dir), fx.optical(spark, sf_dir), "obj_id"), "optical")


def _infrared_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpointed(jobs.match_infrared(_keyed_sky(spark, sf_dir), fx.infrared(spark, sf_dir)), "infrared")


@query
def join_features_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    optical = _optical_matches(spark, sf_dir)
    joined = joins.join_outer(_metadata_features(spark, sf_dir), joins.strip_suffix(optical.drop("ra", "dec")))
    return joined.select("objectid", "filterid", "nepochs", r6("Mean").alias("Mean"), "obj_id", "brand")


@query
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    optical, infrared = _optical_matches(spark, sf_dir), _infrared_matches(spark, sf_dir)
    table = joins.training_set(_metadata_features(spark, sf_dir), optical, infrared)
    return table.select(
        "objectid",
        "filterid",
        "nepochs",
        r6("Mean").alias("Mean"),
        r6("Std").alias("Std"),
        "obj_id",
        "brand",
        "source_id",
        r6("w1mpro_pm").alias("w1mpro_pm"),
        r6("w2mpro_pm").alias("w2mpro_pm"),
    )


# ------------------------------------------------------------ incremental work


def _files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    files = fx.derived(spark, sf_dir, fx.files_sql(), "pages").select("page_id", "path")
    labelled = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("page_id"))
    return files, files.join(labelled, "page_id")


@query
def files_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, done = _files(spark, sf_dir)
    moved = done.select(F.concat(F.lit("s3://store/out/"), text.last_two(F.col("path"))).alias("path"))
    return incremental.pending_by_name(files, moved)


@query
def files_pending_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, done = _files(spark, sf_dir)
    return incremental.pending_by_path(files, done).select("page_id", "path")


@query
def insert_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = fx.sky(spark, sf_dir).select(
        (F.floor(F.col("objectid") % 1000000000000 / 10)).cast("long").alias("_id"),
        F.col("filterid").cast("long").alias("filterid"),
        "objectid",
    )
    stored = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("_id"))
    return incremental.new_rows(batch, stored, order=("filterid", "objectid"))


# ------------------------------------------------------------ scalar functions


@query
def parse_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = fx.derived(spark, sf_dir, fx.listing_sql(), "part")
    return entries.select("entry_id", text.parse_size(F.col("size")).alias("bytes"))


@query
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("url")
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id",
        text.basename(path).alias("base"),
        text.folder(path).alias("folder"),
        text.last_two(path).alias("last_two"),
        text.is_folder(path).alias("is_folder"),
    )


@query
def uri_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fx.derived(spark, sf_dir, fx.files_sql(), "pages")
    uri = F.concat(F.lit("s3://release-"), (F.col("page_id") % 7).cast("string"), F.expr("substring(path, 2)"))
    return files.select("page_id", text.uri_bucket(uri).alias("bucket"), text.uri_path(uri).alias("path"))


@query
def galactic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(with_galactic(fx.sky(spark, sf_dir), "ra", "dec"), ("objectid",), ("gal_b", "gal_l"))


@query
def mag_to_flux(spark: SparkSession, sf_dir: str) -> DataFrame:
    flux = curves.mag_to_flux(F.col("mag"))
    rows = explode_epochs(fx.lightcurves(spark, sf_dir)).withColumn("flux", flux)
    return rounded(rows, ("objectid",), ("hmjd", "flux"))


@query
def phase_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fx.lightcurves(spark, sf_dir).withColumn("trial", trial_period())
    table = table.withColumn("phase", curves.phase_fold("hmjd", "trial"))
    pairs = F.explode(F.arrays_zip("hmjd", "phase")).alias("_row")
    return rounded(table.select("objectid", pairs).select("objectid", "_row.*"), ("objectid",), ("hmjd", "phase"))


@query
def lc_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fx.lightcurves(spark, sf_dir).withColumns(
        {f"by_{how}": curves.center("mag", how) for how in ("min", "mean", "p5")}
    )
    parts = F.explode(F.arrays_zip("hmjd", "by_min", "by_mean", "by_p5")).alias("_row")
    rows = table.select("objectid", parts).select("objectid", "_row.*")
    return rounded(rows, ("objectid",), ("hmjd", "by_min", "by_mean", "by_p5"))


@query
def lc_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = curves.with_curve(fx.lightcurves(spark, sf_dir))
    table = curves.with_expressions(
        table,
        mean=curves.mean("_m"),
        _sorted="sort_array(_m)",
        std=f"sqrt({curves.bound('o', 'mean', curves.total('_m', '(x - o)*(x - o)'))}/_n)",
        low=curves.first("_sorted"),
        high=curves.last("_sorted"),
        p5=curves.percentile("_sorted", 0.05),
    )
    return rounded(table, ("objectid",), ("mean", "std", "low", "high", "p5"))


# -------------------------------------------------------------------- features


def trial_period() -> Column:
    """A period for each object, between 0.5 and about 2.4 days."""
    return (F.col("objectid") % 97).cast("double") / 50.0 + 0.5


STAT_GROUPS = {
    "moments": ("Mean", "Std", "Meanvariance", "Skew", "SmallKurtosis", "ExcessVar", "LinearTrend"),
    "quantiles": ("Amplitude", "Q31", "MedianAbsDev", "MedianBRP", "PercentAmplitude", "Gskew"),
    "weighted": ("Beyond1Std", "StetsonK"),
    "ordered": ("Con", "Eta_e", "MaxSlope", "PairSlopeTrend", "Rcs"),
}


@query
def lc_stats_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(statistics.with_moments(kept(spark, sf_dir)), ("objectid",), STAT_GROUPS["moments"])


@query
def lc_stats_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(statistics.with_quantiles(kept(spark, sf_dir)), ("objectid",), STAT_GROUPS["quantiles"])


@query
def lc_stats_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(statistics.with_weighted(kept(spark, sf_dir)), ("objectid",), STAT_GROUPS["weighted"])


@query
def lc_stats_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(statistics.with_ordered(kept(spark, sf_dir)), ("objectid",), STAT_GROUPS["ordered"])


@query
def pvar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(statistics.with_pvar(kept(spark, sf_dir)), ("objectid",), ("Pvar",))


@query
def autocor_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(statistics.with_autocorrelation(kept(spark, sf_dir)), ("objectid",), ("Autocor_length",))


@query
def anderson_darling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(statistics.with_anderson_darling(kept(spark, sf_dir)), ("objectid",), ("AndersonDarling",))


@query
def structure_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = statistics.with_structure_function(kept(spark, sf_dir))
    return table.select(
        "objectid", r6(F.log10("SF_ML_amplitude")).alias("log_amplitude"), r6("SF_ML_gamma").alias("SF_ML_gamma")
    )


@query
def iar_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = statistics.with_autoregression(kept(spark, sf_dir, FEATURE_LIMIT), rounds=0)
    return table.select("objectid", r6("_iar_score").alias("score"))


@query
def drw_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fits.with_random_walk(kept(spark, sf_dir, FEATURE_LIMIT), rounds=0)
    return table.select("objectid", r6("_walk_score").alias("score"))


@query
def iar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The likeliest correlation of each curve, searched to the end."""
    return rounded(statistics.with_autoregression(kept(spark, sf_dir, FEATURE_LIMIT)), ("objectid",), ("IAR_phi", "_iar_score")).withColumnRenamed("_iar_score", "score")


@query
def drw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The likeliest damped random walk of each curve, searched to the end."""
    table = fits.with_random_walk(kept(spark, sf_dir, FEATURE_LIMIT))
    return table.select(
        "objectid", r6(F.ln("GP_DRW_sigma"), 3).alias("log_sigma"), r6(F.ln("GP_DRW_tau"), 3).alias("log_tau"), r6("_walk_score", 5).alias("score")
    )


@query
def mhps(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fits.with_two_scale_power(kept(spark, sf_dir))
    return table.select(
        "objectid",
        r6("MHPS_ratio", 4).alias("MHPS_ratio"),
        r6("MHPS_low", 12).alias("MHPS_low"),
        r6("MHPS_high", 12).alias("MHPS_high"),
        "MHPS_non_zero",
        "MHPS_PN_flag",
    )


@query
def template_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fits.with_template_fit(kept(spark, sf_dir, FEATURE_LIMIT), rounds=0)
    return rounded(table, ("objectid",), ("SPM_chi",))


@query
def periodogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    # So many rows that rounding them in the plan would take much of the time.
    return period.periodogram(kept(spark, sf_dir, FEATURE_LIMIT), decimals=4)


@query
def topk_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = period.with_top_powers(kept(spark, sf_dir, FEATURE_LIMIT))
    top = F.posexplode("_top").alias("place", "power")
    rows = table.select("objectid", top)
    return rows.select("objectid", F.col("place").cast("long").alias("place"), r6("power").alias("power"))


@query
def period_and_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = period.with_period(kept(spark, sf_dir, FEATURE_LIMIT))
    return rounded(table, ("objectid",), ("Multiband_period", "PPE"))


@query
def power_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = period.with_period(kept(spark, sf_dir, FEATURE_LIMIT))
    return rounded(period.with_power_rates(table), ("objectid",), tuple(period.POWER_RATES))


@query
def folded_kim(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = kept(spark, sf_dir).withColumn("trial", trial_period())
    return rounded(period.with_folded(table, "trial"), ("objectid",), ("Psi_CS", "Psi_eta"))


@query
def harmonics(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = kept(spark, sf_dir).withColumn("trial", trial_period())
    return rounded(period.with_harmonics(table, "trial"), ("objectid",), period.harmonic_names())


@query
def harmonics_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = kept(spark, sf_dir).withColumn("trial", trial_period())
    return rounded(
        period.with_harmonics(table, "trial", count=1), ("objectid",), ("Harmonics_mag_1", "Harmonics_mse")
    )


@query
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compute_features(kept(spark, sf_dir, FEATURE_LIMIT))


# SURVEY names for the keys whose function name is taken by an import above.
for _name, _key in {
    "xmatch_nearest_pair": "xmatch_nearest",
    "xmatch_infrared": "xmatch_catwise",
    "xmatch_optical": "xmatch_ps1",
    "nearest_single": "nearest_one",
    "period_and_entropy": "period",
}.items():
    REGISTRY[_key] = REGISTRY.pop(_name)
