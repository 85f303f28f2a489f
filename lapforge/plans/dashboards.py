"""Data sets behind the dashboard pages.

Every function covers all races at once; ``season`` and ``round`` narrow it to
one (the filter reaches the scan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapforge.functions import label_or
from lapforge.operators.quantiles import median
from lapforge.plans.marts import RACE
from lapforge.plans.pace import racing_laps

ENTRY = ["season", "round", "abbreviation"]

#: Compounds in display order with their labels.
COMPOUND_LABELS = {"SOFT": "S", "MEDIUM": "M", "HARD": "H", "INTER": "I", "WET": "W"}
CLASH_COLOUR = "#FFFFFF"


def for_race(df: DataFrame, season: int | None = None, round: int | None = None) -> DataFrame:
    """One race, one season, or everything."""
    if season is not None:
        df = df.where(F.col("season") == F.lit(season))
    if round is not None:
        df = df.where(F.col("round") == F.lit(round))
    return df


def get_seasons(race_results: DataFrame) -> DataFrame:
    """Seasons, newest first."""
    return race_results.select("season").distinct().orderBy(F.col("season").desc())


def get_rounds(race_results: DataFrame, season: int | None = None) -> DataFrame:
    """Rounds with their names, ascending."""
    return (
        for_race(race_results, season).select(*RACE, "race_name").distinct().orderBy("season", "round")
    )


def get_race_results(race_results: DataFrame, season: int | None = None, round: int | None = None) -> DataFrame:
    return for_race(race_results, season, round).select(*ENTRY, "finish_position", "team_name", "team_color")


def get_tyre_strategy(
    tyre_strategy: DataFrame,
    pit_stops: DataFrame,
    season: int | None = None,
    round: int | None = None,
) -> DataFrame:
    """Stint bars with the stop that ended them."""
    stints = for_race(tyre_strategy, season, round).select(
        *ENTRY,
        "stint",
        "compound",
        label_or("compound", COMPOUND_LABELS, F.coalesce(F.substring("compound", 1, 1), F.lit("?"))).alias("label"),
        F.col("stint_start_lap").alias("visual_start_lap"),
        (F.col("stint_end_lap") - F.col("stint_start_lap") + 1).alias("visual_length"),
    )
    stops = for_race(pit_stops, season, round).select(
        *RACE,
        F.col("driver_abbreviation").alias("abbreviation"),
        F.col("stint_ending").alias("stint"),
        "lap_pitted",
        "pit_stop_duration_seconds",
    )
    return stints.join(stops, [*ENTRY, "stint"], "left").drop("stint")


def get_race_pace(lap_times: DataFrame, season: int | None = None, round: int | None = None) -> DataFrame:
    """Timed racing laps under green flags."""
    green = racing_laps(for_race(lap_times, season, round)).where(F.col("track_status") == "1")
    return green.where(F.col("lap_time_seconds").isNotNull()).select(*ENTRY, "team_color", "lap_time_seconds")


def get_position_by_lap(lap_times: DataFrame, season: int | None = None, round: int | None = None) -> DataFrame:
    placed = for_race(lap_times, season, round).where(F.col("track_position").isNotNull())
    return placed.select(*ENTRY, "lap_number", "track_position", "team_color")


def get_weather(weather: DataFrame, season: int | None = None, round: int | None = None) -> DataFrame:
    return for_race(weather, season, round).select(
        *RACE, "session_elapsed_seconds", "air_temp", "track_temp", "humidity", "rainfall"
    )


def get_drivers_for_round(
    race_results: DataFrame, season: int | None = None, round: int | None = None, at_least: int = 2
) -> DataFrame:
    """Drivers of each race with at least two of them."""
    drivers = for_race(race_results, season, round).select(*ENTRY).distinct()
    enough = drivers.groupBy(*RACE).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= at_least)
    return drivers.join(enough, RACE, "left_semi")


def _chosen(df: DataFrame, drivers: DataFrame | None) -> DataFrame:
    return df if drivers is None else df.join(drivers.select(*ENTRY).distinct(), ENTRY, "left_semi")


def get_lap_times_for_drivers(lap_times: DataFrame, drivers: DataFrame | None = None) -> DataFrame:
    """Lap times of the (season, round, driver) rows asked for."""
    return _chosen(lap_times, drivers).select(*ENTRY, "lap_number", "lap_time_seconds", "compound")


def get_sector_averages(lap_times: DataFrame, drivers: DataFrame | None = None) -> DataFrame:
    return (
        _chosen(lap_times, drivers)
        .groupBy(*ENTRY)
        .agg(*[F.avg(f"sector{i}_time_seconds").alias(f"avg_s{i}") for i in (1, 2, 3)])
    )


def get_telemetry_metrics(telemetry_stints: DataFrame, drivers: DataFrame | None = None) -> DataFrame:
    """Stint figures combined to one row per driver, weighted by laps."""

    def weighted(c: str) -> Column:
        known = F.when(F.col(c).isNotNull(), F.col("stint_laps"))
        return F.try_divide(F.sum(F.col(c) * F.col("stint_laps")), F.sum(known)).alias(c)

    return (
        _chosen(telemetry_stints, drivers)
        .groupBy(*ENTRY)
        .agg(weighted("full_throttle_pct"), weighted("brake_pct"), F.max("max_speed").alias("max_speed"))
    )


def get_pit_stops_for_race(pit_stops: DataFrame, season: int | None = None, round: int | None = None) -> DataFrame:
    return for_race(pit_stops, season, round).select(
        *RACE, F.col("driver_abbreviation").alias("abbreviation"), "lap_pitted", "pit_stop_duration_seconds"
    )


def get_tyre_degradation_all(lap_times: DataFrame, season: int | None = None, round: int | None = None) -> DataFrame:
    timed = for_race(lap_times, season, round).where(F.col("lap_time_seconds").isNotNull())
    return timed.select(*ENTRY, "team_name", "stint", "compound", "tyre_life", "lap_number", "lap_time_seconds")


def race_pace(lap_times: DataFrame, race_results: DataFrame, pad: float = 0.15) -> DataFrame:
    """Median green-flag pace per driver with finish order and the axis range of the race, padded less on the fast side."""
    laps = get_race_pace(lap_times)
    medians = laps.groupBy(*ENTRY).agg(
        median("lap_time_seconds").alias("median_lap_s"), F.min("team_color").alias("team_color")
    )
    finish = race_results.select(*ENTRY, "finish_position")
    field = Window.partitionBy(*RACE)  # one row per driver of a race
    low, high = F.min("median_lap_s").over(field), F.max("median_lap_s").over(field)
    order = field.orderBy(F.col("finish_position").asc_nulls_last(), "abbreviation")
    return medians.join(finish, ENTRY, "left").select(
        *ENTRY,
        "team_color",
        "median_lap_s",
        "finish_position",
        F.row_number().over(order).alias("order_idx"),
        (low - F.lit(0.5) * ((high - low) * F.lit(pad))).alias("axis_min"),
        (high + (high - low) * F.lit(pad)).alias("axis_max"),
    )


def pair_colours(
    race_results: DataFrame, pairs: DataFrame, default_a: str = "#E8473F", default_b: str = "#4A9EE8"
) -> DataFrame:
    """Team colours of two drivers; B turns white where both are the same."""
    colour = race_results.select(*ENTRY, "team_color").distinct()
    a = colour.select(*RACE, F.col("abbreviation").alias("driver_a"), F.col("team_color").alias("color_a"))
    b = colour.select(*RACE, F.col("abbreviation").alias("driver_b"), F.col("team_color").alias("color_b"))
    joined = pairs.join(a, [*RACE, "driver_a"], "left").join(b, [*RACE, "driver_b"], "left")
    one, two = F.coalesce("color_a", F.lit(default_a)), F.coalesce("color_b", F.lit(default_b))
    return joined.select(
        *RACE,
        "driver_a",
        "driver_b",
        one.alias("color_a"),
        F.when(F.lower(one) == F.lower(two), F.lit(CLASH_COLOUR)).otherwise(two).alias("color_b"),
    )


def driver_delta(lap_times: DataFrame, pairs: DataFrame) -> DataFrame:
    """Median lap and mean sector deltas (A minus B) for (season, round, driver_a, driver_b) pairs."""
    per_driver = lap_times.groupBy(*ENTRY).agg(
        median("lap_time_seconds").alias("__lap"),
        *[F.avg(f"sector{i}_time_seconds").alias(f"__s{i}") for i in (1, 2, 3)],
    )
    figures = ["__lap", "__s1", "__s2", "__s3"]

    def side(s: str) -> DataFrame:
        return per_driver.select(
            *RACE, F.col("abbreviation").alias(f"driver_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in figures]
        )

    joined = pairs.join(side("a"), [*RACE, "driver_a"]).join(side("b"), [*RACE, "driver_b"])
    delta = F.col("__lap_a") - F.col("__lap_b")
    return joined.select(
        *RACE,
        "driver_a",
        "driver_b",
        delta.alias("median_delta_s"),
        F.when(delta > 0, F.lit("slower")).otherwise(F.lit("faster")).alias("a_is"),
        *[(F.col(f"__s{i}_a") - F.col(f"__s{i}_b")).alias(f"s{i}_delta") for i in (1, 2, 3)],
    )


def best_lap_card(lap_times: DataFrame) -> DataFrame:
    """Best lap (the first of equals) and spread of lap times per driver."""
    timed = lap_times.where(F.col("lap_time_seconds").isNotNull())
    card = timed.groupBy(*ENTRY).agg(
        F.min(F.struct("lap_time_seconds", "lap_number")).alias("__best"),
        F.stddev_samp("lap_time_seconds").alias("std_dev"),
    )
    return card.select(
        *ENTRY,
        F.col("__best.lap_time_seconds").alias("best_time"),
        F.col("__best.lap_number").alias("best_lap"),
        "std_dev",
    )


def degradation_deltas(lap_times: DataFrame) -> DataFrame:
    """Lap time minus the first timed lap of the stint."""
    laps = get_tyre_degradation_all(lap_times)
    # one row per lap of a driver's stint: laps move once
    stint = Window.partitionBy(*ENTRY, "stint").orderBy(F.col("lap_number").asc_nulls_last(), "lap_time_seconds")
    first = F.first("lap_time_seconds").over(stint.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return laps.withColumn("delta", F.col("lap_time_seconds") - first)


def degradation_curve(lap_times: DataFrame) -> DataFrame:
    """Median delta and number of laps per race, compound and tyre age.

    A group spans the whole field.  Lap times lie on the millisecond grid; their
    differences do so only after rounding, which the exact median needs to keep
    few counters however many laps there are.
    """
    deltas = degradation_deltas(lap_times).where(F.col("compound").isNotNull() & F.col("tyre_life").isNotNull())
    deltas = deltas.withColumn("delta", F.round("delta", 3))
    curve = deltas.groupBy(*RACE, "compound", "tyre_life").agg(
        median("delta").alias("median"), F.count("delta").alias("count")
    )
    return curve.where(F.col("count") >= 1)


def degradation_fit(curve: DataFrame, min_points: int = 2) -> DataFrame:
    """Least-squares line through the medians of each compound."""
    return (
        curve.groupBy(*RACE, "compound")
        .agg(
            F.regr_slope("median", "tyre_life").alias("slope"),
            F.regr_intercept("median", "tyre_life").alias("intercept"),
            F.min("tyre_life").alias("x_min"),
            F.max("tyre_life").alias("x_max"),
            F.count(F.lit(1)).alias("points"),
        )
        .where(F.col("points") >= min_points)
    )


def trend_line(fit: DataFrame, points: int = 50) -> DataFrame:
    """Points of the fitted line, evenly spaced over the tyre ages seen."""
    x = F.col("x_min") + F.col("i") * ((F.col("x_max") - F.col("x_min")) / F.lit(float(points - 1)))
    return (
        fit.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", x)
        .select(*RACE, "compound", "i", "x", (F.col("intercept") + F.col("slope") * F.col("x")).alias("y"))
    )


def weather_summary(weather: DataFrame) -> DataFrame:
    """Last reading, temperature ranges and a wet/dry label per session."""
    reading = F.struct("air_temp", "track_temp", "humidity", "rainfall")
    summary = weather.groupBy(*RACE).agg(
        F.max_by(reading, "session_elapsed_seconds").alias("__last"),
        F.min("air_temp").alias("air_min"),
        F.max("air_temp").alias("air_max"),
        F.min("track_temp").alias("track_min"),
        F.max("track_temp").alias("track_max"),
    )
    return summary.select(
        *RACE,
        F.col("__last.air_temp").alias("air_temp"),
        F.col("__last.track_temp").alias("track_temp"),
        F.col("__last.humidity").alias("humidity"),
        F.when(F.col("__last.rainfall"), F.lit("Wet")).otherwise(F.lit("Dry")).alias("surface"),
        "air_min",
        "air_max",
        "track_min",
        "track_max",
    )


def display_order(race_results: DataFrame) -> DataFrame:
    """Drivers grouped by team, teams by their best finisher, with a mark where the team changes.

    A window partition is the field of one race, one row per driver.
    """
    entries = race_results.where(F.col("team_name").isNotNull()).select(*ENTRY, "team_name", "finish_position")
    team_best = (
        entries.where(F.col("finish_position").isNotNull())
        .groupBy(*RACE, "team_name")
        .agg(F.min(F.struct("finish_position", "abbreviation")).alias("__best"))
    )
    field = Window.partitionBy(*RACE).orderBy(
        "__best", "team_name", F.col("finish_position").asc_nulls_last(), "abbreviation"
    )
    return entries.join(team_best, [*RACE, "team_name"]).select(
        *ENTRY,
        "team_name",
        "finish_position",
        F.row_number().over(field).alias("order_idx"),
        F.coalesce(F.lag("team_name").over(field) != F.col("team_name"), F.lit(False)).alias("team_boundary"),
    )


def strategy_order(strategy: DataFrame, race_results: DataFrame) -> DataFrame:
    """Drivers of the strategy chart: those without a result first, then by finish."""
    drivers = strategy.select(*ENTRY).distinct()
    finishers = race_results.where(F.col("finish_position").isNotNull()).select(*ENTRY, "finish_position")
    extra = drivers.join(finishers, ENTRY, "left_anti").withColumn("finish_position", F.lit(None).cast("bigint"))
    listed = finishers.unionByName(extra)
    field = Window.partitionBy(*RACE).orderBy(F.col("finish_position").asc_nulls_first(), "abbreviation")
    return listed.withColumn("order_idx", F.row_number().over(field))


def compound_order(strategy: DataFrame) -> DataFrame:
    """Compounds in use: the known ones in their fixed order, then the others by name."""
    known = {name: f"{i:03d}" for i, name in enumerate(COMPOUND_LABELS)}
    seen = strategy.where(F.col("compound").isNotNull()).select(*RACE, "compound").distinct()
    by = Window.partitionBy(*RACE).orderBy(label_or("compound", known, "999"), "compound")
    return seen.withColumn("order_idx", F.row_number().over(by))
