"""Whole jobs: read, transform, write.  Each is one lazy plan per output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.features.registry import FeatureFamily, compute_features
from skyfold.operators.joins import join_labels, strip_suffix, training_set
from skyfold.operators.layout import split_by, write_files
from skyfold.operators.preprocess import Preprocessor
from skyfold.operators.publish import append_new, feature_documents, lightcurve_documents
from skyfold.operators.xmatch import xmatch, xmatch_nearest
from skyfold.sources.lightcurves import read_lightcurves
from skyfold.schema import EPOCH_COLUMNS
from skyfold.workspace import checkpointed, read_if_there

ARCSEC = 1.0 / 3600.0


def feature_job(
    spark: SparkSession,
    source: str,
    target: str,
    preprocess: bool = True,
    parts: int | None = None,
    families: list[FeatureFamily] | None = None,
) -> None:
    """Curves to features, for curves that ``target`` does not hold yet: a run again, or after a loss, adds the rest.

    Keys are compared first, without the curves.  Files whose curves are all done are not read;
    in the others only the keys already done there are left out, which after a loss are few, so
    that Spark can send them to the curves and leave the curves where they are.
    ``parts`` spreads the curves over that many tasks; without it the file
    splits decide.  A failed write fails the job.
    """
    keys = ["objectid", "filterid"]
    curves = read_lightcurves(spark, source)
    listed = checkpointed(curves.select(*keys, F.col("_metadata.file_path").alias("file")), "curve-keys")
    done = read_if_there(spark, target, curves.select(*keys).schema).distinct()
    # As many names as there are files, which the driver lists for every scan anyway.
    files = [r["file"] for r in listed.join(done, keys, "left_anti").select("file").distinct().collect()]
    if not files:
        return
    here = listed.join(F.broadcast(spark.createDataFrame([(f,) for f in files], "file string")), "file").join(done, keys, "left_semi")
    # A condition on the file name is met before files are opened.
    curves = curves.where(F.col("_metadata.file_path").isin(files)).join(checkpointed(here.select(*keys).distinct(), "keys-done"), keys, "left_anti")
    if preprocess:
        curves = Preprocessor(limit_epochs=20, mag_error_tolerance=1.0, catflags_filter=0).run(curves)
    if parts:
        curves = curves.repartition(parts)
    compute_features(curves, families).write.mode("append").parquet(target)


def positions(curves: DataFrame, *extra: str) -> DataFrame:
    """Key and position of each curve, named as the matcher wants them."""
    return curves.select("objectid", "filterid", *extra, F.col("objra").alias("ra"), F.col("objdec").alias("dec"))


def match_infrared(objects: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Nearest infrared source within 2 arcsec."""
    payload = catalogue.select("source_id", "ra", "dec", "w1mpro_pm", "w2mpro_pm")
    return xmatch_nearest(objects, payload, 2.0 * ARCSEC, "source_id").drop("ra_2", "dec_2")


def match_optical(objects: DataFrame, catalogue: DataFrame, source: str) -> DataFrame:
    """Nearest optical source within 1.5 arcsec; the catalogue has its own position names."""
    renamed = catalogue.withColumnsRenamed({"RAJ2000": "ra", "DEJ2000": "dec"})
    return xmatch_nearest(objects, renamed, 1.5 * ARCSEC, source).drop("ra_2", "dec_2")


def match_labels(objects: DataFrame, labels: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """All labels within 1.5 arcsec, label columns under their own names."""
    matches = xmatch(objects, labels, 1.5 * ARCSEC)
    named = matches.drop("ra_2", "dec_2", *(f"{c}_2" for c in drop))
    return strip_suffix(named.withColumnsRenamed({"ra": "objra", "dec": "objdec"}))


def write_matches(matches: DataFrame, target: str, files: int = 50) -> None:
    write_files(matches, target, files)


def labelled_curves_job(
    spark: SparkSession, labels: DataFrame, source: str, target: str, ignore_corrupt: bool = False
) -> None:
    """Epochs of labelled objects, one folder per band."""
    curves = read_lightcurves(spark, source, ignore_corrupt=ignore_corrupt)
    joined = join_labels(labels, curves.select("objectid", "filterid", *EPOCH_COLUMNS))
    split_by(joined.withColumn("fid", F.col("filterid")), target, "fid")


def training_set_job(features: DataFrame, first: DataFrame, second: DataFrame, target: str) -> None:
    training_set(features, first, second).write.parquet(target)


def publish_lightcurves_job(spark: SparkSession, source: str, store: str, drop: bool = False) -> int:
    """Curves to documents with binary series; returns how many were new."""
    return append_new(lightcurve_documents(read_lightcurves(spark, source), binary=True), store, drop)


def publish_features_job(spark: SparkSession, source: str, store: str, drop: bool = False) -> int:
    return append_new(feature_documents(spark.read.parquet(source)), store, drop)
