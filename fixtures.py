"""Astronomical tables derived from the driver's tables, as SQL text.

The text runs in Spark and in DuckDB; only the conversion of a timestamp to a
Modified Julian Date differs.  See FIXTURES.md for what each table stands for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK_HMJD = "unix_micros(cast(ts as timestamp))/86400000000e0 + 40587e0"
DUCKDB_HMJD = "epoch_us(ts)/86400000000e0 + 40587e0"

BAND = "case event_type when 'click' then 1 when 'view' then 2 else 3 end"

# One curve holds the epochs of one user, band and calendar month, counted from the
# month in which the events begin.  What a curve holds depends on its own events alone.
FIRST_MONTH = "(2024*12 + 1)"
OBSERVED = f"""(
select event_id, ts, user_id, value, {BAND} as band, cast(year(ts)*12 + month(ts) - {FIRST_MONTH} as bigint) as part from events) o"""
OBJECT = "part*1000000000000 + user_id*10 + band"

# Positions: objects of one user share a place; places are spread over the sphere
# and include both poles and right ascension zero.
PLACE_RA = "cast(({n})*222492 % 360000 as double)/1000e0"
PLACE_DEC = "cast(({n})*7919 % 180001 as double)/1000e0 - 90e0"
STEP = "0.41e0/3600e0"


def place(n: str) -> tuple[str, str]:
    return PLACE_RA.format(n=n), PLACE_DEC.format(n=n)


def _near(n: str, east: str, north: str) -> tuple[str, str]:
    """A place moved by small whole steps, kept on the sphere."""
    ra, dec = place(n)
    moved_ra = f"({ra} + ({east})*{STEP} + 360e0) % 360e0"
    moved_dec = f"greatest(-90e0, least(90e0, {dec} + ({north})*{STEP}))"
    return moved_ra, moved_dec


def epochs_sql(hmjd: str) -> str:
    """One row per epoch."""
    ra, dec = place("user_id")
    return f"""
select {OBJECT} as objectid, band as filterid, part % 2048 as fieldid, user_id % 64 as rcid,
       {ra} as objra, {dec} as objdec, event_id,
       {hmjd} as hmjd, 15e0 + value/97e0 as mag, (event_id*7 % 150 + 1)/100e0 as magerr,
       (event_id*3 % 11)/10e0 as clrcoeff, case when event_id % 10 = 0 then 32768 else 0 end as catflags
from {OBSERVED}"""


def sky_sql() -> str:
    """One position per object."""
    ra, dec = place("user_id")
    return f"""
select distinct {OBJECT} as objectid, band as filterid, {ra} as ra, {dec} as dec from {OBSERVED}"""


def infrared_sql() -> str:
    """An infrared catalogue: fourteen sources around every place."""
    ra, dec = _near("cast(floor(p_partkey/14e0) as bigint)", "p_partkey*5 % 7 - 3", "p_partkey % 9 - 4")
    return f"""
select p_partkey as source_id, {ra} as ra, {dec} as dec,
       p_retailprice/100e0 as w1mpro_pm, cast(p_size as double) as w2mpro_pm from part"""


def optical_sql() -> str:
    """An optical catalogue with other column names and other offsets."""
    ra, dec = _near("cast(floor(p_partkey/14e0) as bigint)", "p_partkey*3 % 5 - 2", "p_partkey*2 % 7 - 3")
    return f"""
select p_partkey as obj_id, {ra} as RAJ2000, {dec} as DEJ2000, p_brand as brand from part"""


def label_positions_sql() -> str:
    """Labelled sources by position."""
    ra, dec = _near("doc_id", "doc_id % 5 - 2", "doc_id % 3 - 1")
    return f"""
select doc_id as source_id, {ra} as ra, {dec} as dec, 'set' as source_cat, quality as source_class,
       toxic as source_flag, doc_id*0.5e0 as source_period from labels"""


def label_keys_sql() -> str:
    """Labelled objects by key."""
    return "select doc_id*10 + 1 + toxic as objectid, 1 + toxic as filterid, quality as source_class from labels"


def files_sql() -> str:
    """Paths of released files with text content and a size as listings print it."""
    return """
select page_id, './' || cast(page_id % 3 as varchar(1)) || '/field' || substr(cast(10000 + page_id % 40 as varchar(5)), 2)
       || '/' || md5(url) || '.parquet' as path, html as content from pages"""


def manifest_sql() -> str:
    """Lines of a checksum file; sources dropped from the labels have an outdated checksum."""
    return f"""
select md5(case when l.quality = 0 then f.content || 'x' else f.content end) || '  ' || f.path as value
from ({files_sql()}) f left join labels l on l.doc_id = f.page_id"""


def listing_sql() -> str:
    """Directory pages: one page per part brand, one entry per part."""
    return """
select p_partkey as entry_id, 'https://data.example.org/release/0/field' || substr(cast(10000 + p_size as varchar(5)), 2)
       || '/' || case when p_partkey % 17 = 0 then p_name || '/' else 'part' || cast(p_partkey as varchar(20)) || '.parquet' end
       as file,
       cast(p_size as varchar(10)) || case when p_partkey % 2 = 0 then '.' || cast(p_partkey % 10 as varchar(1)) else '' end
       || case p_partkey % 5 when 0 then 'B' when 1 then 'K' when 2 then 'M' when 3 then 'G' else '' end || '  ' as size
from part"""


# ------------------------------------------------------------------ Spark side


def tables(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def derived(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    tables(spark, sf_dir, *names)
    return spark.sql(sql)


def epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, epochs_sql(SPARK_HMJD), "events")


def lightcurves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide curves: one row per object and band, epochs in parallel arrays in time order."""
    fields = ("hmjd", "event_id", "mag", "magerr", "clrcoeff", "catflags")
    keys = ("objectid", "filterid", "fieldid", "rcid", "objra", "objdec")
    # A curve costs far more work than bytes, so the number of partitions is kept.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = epochs(spark, sf_dir).repartition(parts, "objectid").groupBy("objectid").agg(
        *[F.first(k).alias(k) for k in keys[1:]], F.sort_array(F.collect_list(F.struct(*fields))).alias("epoch")
    )
    arrays = [F.col(f"epoch.{f}").alias(f) for f in fields if f != "event_id"]
    return packed.select(*keys, F.size("epoch").cast("long").alias("nepochs"), *arrays)


def sky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, sky_sql(), "events")


def infrared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, infrared_sql(), "part")


def optical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, optical_sql(), "part")


def label_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, label_positions_sql(), "labels")


def label_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, label_keys_sql(), "labels")
