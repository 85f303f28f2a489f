"""Live telemetry: file stream in, cleaned samples, minute figures and samples with their lap out (tables: ``merge.py``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.plans.marts import DRS_OPEN
from lapforge.plans.silver import typed_telemetry
from lapforge.schemas import SILVER_KEYS, TELEMETRY

RACE = ["season", "round"]
LAP = [*RACE, "abbreviation", "lap_number"]
CONTEXT = ["stint", "compound", "tyre_life", "fresh_tyre"]


def telemetry_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw telemetry files as they land, with the declared schema."""
    reader = spark.readStream.schema(TELEMETRY)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def clean_stream(raw: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Typed samples; of several with one key the first to arrive is kept.

    Only keys younger than the watermark are remembered, so the state stays bounded.
    """
    typed = typed_telemetry(raw).withWatermark("date", delay)
    return typed.dropDuplicatesWithinWatermark(SILVER_KEYS["telemetry"])


def window_figures(
    samples: DataFrame,
    width: str = "1 minute",
    delay: str | None = None,
    drs_open: Sequence[int] = DRS_OPEN,
    full_throttle: float = 99,
) -> DataFrame:
    """Speed, throttle, brake and DRS figures per driver and time window; later samples are left out."""

    def percent(condition: Column) -> Column:
        return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))) * F.lit(100.0)

    marked = samples.withWatermark("date", delay) if delay else samples
    figures = marked.groupBy(F.window("date", width), *RACE, "abbreviation").agg(
        F.count(F.lit(1)).alias("samples"),
        F.avg("speed").alias("avg_speed"),
        F.max("speed").alias("max_speed"),
        percent(F.col("throttle") >= full_throttle).alias("full_throttle_pct"),
        percent(F.col("brake")).alias("brake_pct"),
        percent(F.col("drs").isin(*drs_open)).alias("drs_open_pct"),
    )
    return figures.select(F.col("window.start").alias("window_start"), *[c for c in figures.columns if c != "window"])


def with_lap_context(samples: DataFrame, laps: DataFrame) -> DataFrame:
    """Stream joined with the stint and tyre of the lap (static side)."""
    return samples.join(laps.select(*LAP, *CONTEXT), LAP, "left")


def lap_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """Lap rows as they land; ``schema`` has the lap keys, the context columns and the time stamp of the lap."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def with_late_laps(
    samples: DataFrame, laps: DataFrame, delay: str = "10 minutes", lap_time: str = "lap_start_date", longest: str = "30 minutes"
) -> DataFrame:
    """Samples with the stint and tyre of their lap, where both arrive as streams and laps may come later.

    A sample waits for its lap's row until the watermark has passed the last moment at which that lap may have started;
    then it goes out without context.  A lap waits for its samples for ``longest``, and of several rows for a lap the first
    counts.  So the state holds what is younger than ``delay`` plus ``longest``, whatever the length of the session.
    """
    known = laps.select(*LAP, *CONTEXT, F.col(lap_time).alias("__lap_time")).withWatermark("__lap_time", delay)
    known = known.dropDuplicatesWithinWatermark(LAP)
    known = known.select(*[F.col(c).alias(f"__{c}") for c in LAP], *CONTEXT, "__lap_time")
    timed = samples.withWatermark("date", delay)
    same = F.lit(True)
    for c in LAP:
        same = same & (F.col(c) == F.col(f"__{c}"))
    # these two bounds tell Spark how long either side has to be kept
    while_running = (F.col("__lap_time") <= F.col("date")) & (F.col("__lap_time") >= F.col("date") - F.expr(f"interval {longest}"))
    return timed.join(known, same & while_running, "left_outer").drop("__lap_time", *[f"__{c}" for c in LAP])
