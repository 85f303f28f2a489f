"""Session settings the jobs rely on."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings that change results or protect against skew; a cluster may add more.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, name: str = "lapforge") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or on one machine the warehouse where that is unset."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("on a cluster spark.checkpoint.dir must name a folder that all executors share")
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return folder.rstrip("/")


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/lapforge/{spark.sparkContext.applicationId}/{name}"


def dropped(spark: SparkSession, name: str) -> None:
    """Remove a frame that :func:`written` has stored."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_path(spark, name))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts the lineage of a table that many queries read: they prune its
    columns and partitions instead of building it again, and a lost executor
    costs a file read.  Files are packed by zstd: keys made of hex digits take half the bytes that way.
    """
    spark = df.sparkSession
    path = _path(spark, name)
    rows = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def written_by(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Like :func:`written`, kept in buckets of ``keys``: what groups or joins by them reads the rows where they lie.

    The frame should come partitioned by ``keys`` into as many parts, which makes a file per bucket; others work, with a
    file per part and bucket.
    """
    spark = df.sparkSession
    table = "lapforge_" + re.sub(r"\W", "_", name)
    writer = df.write.mode("overwrite").format("parquet").option("compression", "zstd").option("path", _path(spark, name))
    writer.bucketBy(buckets, *keys).saveAsTable(table)
    return spark.table(table).select(*df.columns)
