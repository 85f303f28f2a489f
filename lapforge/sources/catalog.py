"""What is in the catalog, and previews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.schemas import RAW_TABLES

#: The logical sources all staging tables read from.
SILVER_SOURCES = {name: f"silver.{name}" for name in RAW_TABLES}


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Stored tables of a database (no temporary views)."""
    found = spark.sql(f"show tables in {database}")
    return found.where(~F.col("isTemporary")).select("namespace", "tableName")


def list_columns(df: DataFrame) -> DataFrame:
    """Name, type and place of every column (metadata only, no data is read)."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def source(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(SILVER_SOURCES[name])


def preview(df: DataFrame, order_cols: list[str], n: int = 5) -> DataFrame:
    """First rows in a given order (a distributed top-n)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols]).limit(n)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Frames stacked by column name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, distinct rounds and seasons of every table."""
    # counted per race first, so only those few rows are expanded for the distinct counts
    parts = [
        df.groupBy("season", "round")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count_distinct("round").alias("rounds"),
            F.count_distinct("season").alias("seasons"),
        )
        .select(F.lit(name).alias("table"), "rows", "rounds", "seasons")
        for name, df in tables.items()
    ]
    return union_all(parts)


def verify_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """Load report over catalog tables; a table that does not exist gets an error instead of counts."""
    there = {n: spark.table(n) for n in names if spark.catalog.tableExists(n)}
    missing = [(n, None, None, None, "table not found") for n in names if n not in there]
    schema = "table string, rows long, rounds long, seasons long, error string"
    absent = spark.createDataFrame(missing, schema)
    return union_all([load_report(there), absent]) if there else absent


def footer_counts(spark: SparkSession, path: str, by: Sequence[str] = ("season", "round")) -> DataFrame:
    """Rows of a Parquet dataset per folder column, from the footers of its files: no row is read.

    The aggregate is pushed into the reader, which a session of its own asks for.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def round_counts(df: DataFrame, season: int, round: int) -> DataFrame:
    """Rows of one race and of the whole table, in one pass."""
    here = (F.col("season") == F.lit(season)) & (F.col("round") == F.lit(round))
    return df.agg(F.count_if(here).alias("round_rows"), F.count(F.lit(1)).alias("total_rows"))
