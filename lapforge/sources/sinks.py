"""Writing tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.session import dropped, written

RACE = ("season", "round")


def create_empty(spark: SparkSession, schema: str, table: str, partition_by: Sequence[str] = RACE) -> None:
    """Create a table without rows unless it exists."""
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], schema).write.partitionBy(*partition_by).saveAsTable(table)


def spread_by(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a table partition together for writing.

    AQE merges small partitions and splits large ones to its target size, so a
    race that holds a third of all rows is written by many tasks.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def full_refresh(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table by ``df``."""
    if partition_by:
        df = spread_by(df, partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def replace_partitions(df: DataFrame, table: str, partition_by: Sequence[str] = RACE) -> None:
    """Replace exactly the (season, round) partitions that occur in ``df``.

    Running it twice gives the same table.  Columns are matched by name.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.limit(0).write.partitionBy(*partition_by).saveAsTable(table)
    rows = spread_by(df.select(*spark.table(table).columns), partition_by)
    # insertInto honours the dynamic mode only as a session setting: a session of its own keeps it away
    # from other writers, whatever their mode is and in whatever order they finish
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    view = f"replace_{uuid.uuid4().hex}"
    rows.createGlobalTempView(view)
    try:
        own.table(f"global_temp.{view}").write.insertInto(table, overwrite=True)
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(table)  # this session may have listed the files before


def replace_races(df: DataFrame, table: str, folder: str = "season", race: Sequence[str] = RACE) -> None:
    """Replace exactly the races that occur in ``df``, in a table whose folders are seasons.

    For tables of few rows a race, where a folder each would be mostly files.  Only the touched seasons are
    rewritten, from a staged copy, since a table cannot be overwritten while it is read.  One such job may run per season.
    """
    spark = df.sparkSession
    create_empty(spark, df.schema.simpleString()[7:-1], table, [folder])
    stored = spark.table(table)
    kept = stored.join(df.select(folder).distinct(), folder, "left_semi").join(df.select(*race).distinct(), list(race), "left_anti")
    name = f"replace/{uuid.uuid4().hex}"
    replace_partitions(written(kept.select(*stored.columns).unionByName(df), name), table, [folder])
    dropped(spark, name)


def store_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Store a table by the hash of its keys, sorted within: aggregates, windows and joins on the keys need no shuffle.

    Tables that are joined are stored with the same keys and number of buckets.  Every bucket is one file, so choose
    ``buckets`` for the size of the table: one that grows with it keeps the sort of a bucket in memory.  Rows that
    come dealt out by the keys into as many parts are not moved again.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("compression", "zstd")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
