"""A data profile that grows with its table: one small state per race, of which only new races are computed.

The state of a race holds row and null counts and a distinct-count sketch per column; states of races add up to those of
seasons and tables, so a profile of any part never reads the table again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RACE = ["season", "round"]
SCHEMA = "column string, rows long, nulls long, sketch binary, loaded string, season int, round int"


class Profile:
    """States in a folder of the shared file system, partitioned by season."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], stamp: str = "ingested_at"):
        self.spark, self.path, self.columns, self.stamp = spark, path.rstrip("/"), list(columns), stamp
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)

    def states(self) -> DataFrame:
        """One row per race and column; of several states of a race the one of the latest load."""
        stored = self.spark.read.schema(SCHEMA).parquet(self.path)
        last = stored.groupBy(*RACE, "column").agg(F.max_by(F.struct("rows", "nulls", "sketch", "loaded"), "loaded").alias("x"))
        return last.select(*RACE, "column", "x.*")

    def outdated(self, loads: DataFrame) -> DataFrame:
        """The races of ``loads`` (season, round, latest load stamp) whose state is missing or older."""
        known = self.states().groupBy(*RACE).agg(F.max("loaded").alias("known"))
        loaded = loads.groupBy(*RACE).agg(F.max(F.col(self.stamp).cast("string")).alias("loaded"))
        return loaded.join(known, RACE, "left").where("known is null or known < loaded").select(*RACE, "loaded")

    def update(self, df: DataFrame, loads: DataFrame | None = None) -> None:
        """Add the states of new and reloaded races; the rows of other races are not read where ``df`` is partitioned by season.

        ``loads`` is a small table of (season, round, load stamp), a ledger of loads for example; without it, the load stamps of
        ``df`` itself are read, one column of it.
        """
        new = self.outdated(df if loads is None else loads)
        each = df.join(new, RACE)
        state = each.groupBy(*RACE).agg(
            F.count(F.lit(1)).alias("rows"),
            F.max("loaded").alias("loaded"),
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.count_if(F.col(c).isNull()).alias("nulls"),
                        F.hll_sketch_agg(F.col(c).cast("string")).alias("sketch"),
                    )
                    for c in self.columns
                ]
            ).alias("columns"),
        )
        rows = state.select(*RACE, "rows", "loaded", F.inline("columns"))
        rows.select("column", "rows", "nulls", "sketch", "loaded", *RACE).write.mode("append").partitionBy("season").parquet(self.path)

    def report(self, by: Sequence[str] = ()) -> DataFrame:
        """Rows, nulls and distinct values per column, in all or by season or race, from the states alone.

        Distinct counts are exact for few values and within some two percent beyond.
        """
        return self.states().groupBy(*by, "column").agg(
            F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values")
        )
