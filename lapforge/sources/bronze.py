"""Raw Parquet: reading and landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.functions import load_stamp, ns_to_timestamp
from lapforge.schemas import RAW_TABLES
from lapforge.sources.sinks import spread_by

#: Raw columns that may be stored with nanosecond precision.
NANOSECOND_COLUMNS = {"telemetry": ["date"], "laps": ["lap_start_date"]}


def read_bronze(
    spark: SparkSession,
    root: str,
    table: str,
    season: int | None = None,
    round: int | None = None,
) -> DataFrame:
    """A raw table, or one season or round of it.

    The dataset is partitioned by season and round, so the filters prune folders.
    """
    df = spark.read.schema(RAW_TABLES[table]).parquet(f"{root.rstrip('/')}/{table}")
    if season is not None:
        df = df.where(F.col("season") == F.lit(season))
    if round is not None:
        df = df.where(F.col("round") == F.lit(round))
    return df


def read_files(spark: SparkSession, path: str, table: str | None = None, pattern: str | None = None) -> DataFrame:
    """One Parquet file, or all files of a folder whose names match ``pattern``."""
    reader = spark.read
    if table is not None:
        reader = reader.schema(RAW_TABLES[table])
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def read_nanosecond_files(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Raw files with nanosecond timestamps, which Spark reads only as integers.

    The session must have ``spark.sql.legacy.parquet.nanosAsLong`` set.
    """
    df = spark.read.parquet(path)
    wide = [c for c in NANOSECOND_COLUMNS.get(table, []) if dict(df.dtypes).get(c) == "bigint"]
    return df.withColumns({c: ns_to_timestamp(c) for c in wide})


def with_keys(df: DataFrame, season: int, round: int) -> DataFrame:
    return df.withColumns({"season": F.lit(season), "round": F.lit(round)})


def move_last(df: DataFrame, column: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c != column], column)


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({"source": F.lit(source), "ingested_at": load_stamp()})


def land_raw(df: DataFrame, source: str, root: str, table: str) -> None:
    """Add lineage and write to the landing zone, replacing only the races at hand."""
    (
        spread_by(with_lineage(df, source), ["season", "round"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("season", "round")
        .parquet(f"{root.rstrip('/')}/{table}")
    )
