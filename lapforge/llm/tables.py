"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as a regular expression: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scratch(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the warehouse where that is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return f"{folder.rstrip('/')}/lapforge-llm/{spark.sparkContext.applicationId}"


def parked(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = f"{scratch(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


class Rounds:
    """Frames that an iterative job writes under a few names: when a name is written anew, its former files go.

    So the disk that a job holds does not grow with its rounds.  A frame must not be used after its successor is written.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path, former = f"{scratch(self.spark)}/{name}-{uuid.uuid4().hex}", self.paths.get(name)
        df.write.parquet(path)
        self.paths[name] = path
        if former:
            removed(self.spark, former)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_bucketed(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """One row per key, stored by key: joins on the key move the other side only."""
        n, stored = int(self.spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}"
        self.paths[name] = f"{scratch(self.spark)}/{stored}"
        rows = df.repartition(n, key).dropDuplicates([key])
        rows.write.option("path", self.paths[name]).bucketBy(n, key).sortBy(key).format("parquet").saveAsTable(stored)
        return self.spark.table(stored)

    def free_shuffles(self) -> None:
        """Let Spark delete the shuffle files of frames that nothing refers to any more."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def clear(self, *kept: str) -> None:
        for name in [n for n in self.paths if n not in kept]:
            removed(self.spark, self.paths.pop(name))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bucket_of(doc_id, n: int):
    """crc32 of the id's decimal text, modulo n: the fold of a document (null ids: fold 0)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))
