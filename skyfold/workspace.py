"""Sessions, and the shared folder for data that a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skyfold")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    All folders of an application are in one that bears its id: lazy results read them
    as long as it runs, and whoever ran it can delete that one folder afterwards.
    Only a local session may do without the setting: it then gets a temporary
    folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="skyfold-")
    return f"{root.rstrip('/')}/skyfold-{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def local_folder(spark: SparkSession, path: str) -> str | None:
    """What the machine's own file system calls a folder that Spark finds there, None for one in another store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(place).toUri()
    return full.getPath() if full.getScheme() == "file" else None


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, empty where nothing has been written to ``path`` yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def checkpointed(df: DataFrame, purpose: str) -> DataFrame:
    """Cut the lineage by writing a table to the shared folder and reading it back."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int, purpose: str) -> DataFrame:
    """Cut the lineage with a table bucketed and sorted by ``key``: joins and groups by the key need no exchange of it.

    The table is in the shared folder; the session's catalogue has its name.
    """
    spark = df.sparkSession
    name = f"skyfold_{purpose.replace('-', '_')}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", shared_folder(spark, purpose)).saveAsTable(name)
    return spark.table(name)
