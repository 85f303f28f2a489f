"""Lap-time analyses.  Every result carries season and round, so one job covers all races."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapforge.functions import pair_label, rounded
from lapforge.operators.ordered import chunk_of, rolling_mean
from lapforge.operators.quantiles import box_statistics, median

RACE = ["season", "round"]


def racing_laps(laps: DataFrame) -> DataFrame:
    """Laps at racing speed: not the first lap, not out of the pits."""
    return laps.where((F.col("lap_number") > 1) & F.col("pit_out_time_seconds").isNull())


def driver_pace(laps: DataFrame, *described: str) -> DataFrame:
    """Median, spread and number of racing laps per driver and race.

    Lap times are whole milliseconds, so the exact median keeps few counters
    per group whatever its size, and both figures combine before the shuffle.
    """
    return (
        racing_laps(laps)
        .groupBy(*RACE, "abbreviation", *described)
        .agg(
            median("lap_time_seconds").alias("median_lap_s"),
            F.stddev_samp("lap_time_seconds").alias("std_lap_s"),
            F.count(F.lit(1)).alias("lap_count"),
        )
    )


def _with_gap(pace: DataFrame) -> DataFrame:
    # one row per driver here: a partition is the field of one race
    field = Window.partitionBy(*RACE)
    return pace.withColumn("delta_to_fastest_s", F.col("median_lap_s") - F.min("median_lap_s").over(field))


def pace_summary(lap_times: DataFrame, digits: int | None = 3) -> DataFrame:
    """Median pace, consistency and gap to the fastest driver of each race."""
    pace = _with_gap(driver_pace(lap_times, "team_id"))
    return pace.select(
        *RACE,
        "abbreviation",
        "team_id",
        rounded(F.col("median_lap_s"), digits).alias("median_lap_s"),
        rounded(F.col("std_lap_s"), digits).alias("std_lap_s"),
        "lap_count",
        rounded(F.col("delta_to_fastest_s"), digits).alias("delta_to_fastest_s"),
    )


def pace_vs_consistency(lap_times: DataFrame, digits: int | None = 3) -> DataFrame:
    return pace_summary(lap_times, digits).select(
        *RACE, "abbreviation", "team_id", "median_lap_s", "std_lap_s"
    )


def lap_distribution(lap_times: DataFrame) -> DataFrame:
    """Every timed racing lap with its driver's median of that race."""
    timed = (
        racing_laps(lap_times)
        .where(F.col("lap_time_seconds").isNotNull())
        .select(*RACE, "abbreviation", "team_id", "lap_number", "lap_time_seconds")
    )
    medians = timed.groupBy(*RACE, "abbreviation").agg(median("lap_time_seconds").alias("driver_median"))
    return timed.join(medians, [*RACE, "abbreviation"])


def lap_boxes(lap_times: DataFrame) -> DataFrame:
    """Box-plot figures of the racing laps, with the rank that orders drivers by median."""
    boxes = box_statistics(racing_laps(lap_times), [*RACE, "abbreviation"], "lap_time_seconds")
    # medians are whole halves of a nanosecond: equal ones must not be told apart by their last bit
    by_median = Window.partitionBy(*RACE).orderBy(F.round("median", 10), "abbreviation")
    return boxes.withColumn("order_idx", F.row_number().over(by_median))


def pace_evolution(
    lap_times: DataFrame,
    race_results: DataFrame,
    top: int = 10,
    rows: int = 3,
    chunk_laps: float = 4096,
) -> DataFrame:
    """Racing laps of the first ``top`` finishers with a rolling mean over ``rows`` laps."""
    finishers = race_results.where(F.col("finish_position") <= top).select(*RACE, "abbreviation")
    laps = (
        racing_laps(lap_times)
        .join(finishers, [*RACE, "abbreviation"], "left_semi")
        .select(*RACE, "abbreviation", "team_id", "lap_number", "lap_time_seconds")
    )
    return rolling_mean(
        laps,
        [*RACE, "abbreviation"],
        ["lap_number"],
        "lap_time_seconds",
        "rolling_avg",
        rows,
        chunk_of("lap_number", chunk_laps),
    )


def teammate_pace(lap_times: DataFrame, race_results: DataFrame, digits: int | None = 3) -> DataFrame:
    """Gap between the median paces of team-mates, one row per pair and race."""
    teams = race_results.select(*RACE, "abbreviation", "constructor").distinct()
    pace = driver_pace(lap_times).join(teams, [*RACE, "abbreviation"])
    side = [*RACE, "constructor"]
    a = pace.select(*side, F.col("abbreviation").alias("driver_a"), F.col("median_lap_s").alias("__a"))
    b = pace.select(*side, F.col("abbreviation").alias("driver_b"), F.col("median_lap_s").alias("__b"))
    pairs = a.join(b, side).where(F.col("driver_a") < F.col("driver_b"))
    return pairs.select(
        *side,
        "driver_a",
        "driver_b",
        pair_label("driver_a", "driver_b").alias("matchup"),
        rounded(F.col("__a"), digits).alias("pace_a"),
        rounded(F.col("__b"), digits).alias("pace_b"),
        rounded(F.abs(F.col("__a") - F.col("__b")), digits).alias("pace_delta_s"),
        F.when(F.col("__a") < F.col("__b"), F.col("driver_a")).otherwise(F.col("driver_b")).alias("faster_driver"),
    )


def season_pace(lap_times: DataFrame, digits: tuple[int, int] | None = (2, 3)) -> DataFrame:
    """Mean over the season of a driver's race medians, spreads and gaps."""
    two, three = digits or (None, None)
    races = _with_gap(driver_pace(lap_times))
    return races.groupBy("season", "abbreviation").agg(
        rounded(F.avg("median_lap_s"), two).alias("avg_median_pace_s"),
        rounded(F.avg("std_lap_s"), two).alias("avg_consistency_s"),
        rounded(F.avg("delta_to_fastest_s"), three).alias("avg_delta_to_fastest_s"),
    )
