"""The eight analysis-ready marts, each a function of staging tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapforge.functions import rounded, surrogate_key
from lapforge.operators.ordered import chunk_of, shift

RACE = ["season", "round"]
ENTRY = ["season", "round", "abbreviation"]

#: DRS readings that mean "flap open".
DRS_OPEN = (10, 12, 14)


def driver_info(results: DataFrame) -> DataFrame:
    """Who drove for which team: one row per (season, round, driver)."""
    return results.select(
        *ENTRY, "driver_id", "full_name", "team_id", "team_name", "team_color"
    ).distinct()


def race_spine(results: DataFrame, race_results: DataFrame) -> DataFrame:
    """Timing-source results completed with points and race facts of the other source."""
    facts = race_results.select(
        *RACE,
        "driver_id",
        "race_name",
        "circuit",
        "race_date",
        "constructor",
        "points",
        "fastest_lap_rank",
        F.col("status").alias("__status"),
    )
    own = results.drop("points", "broadcast_name")
    joined = own.join(facts, [*RACE, "driver_id"], "left")
    return joined.withColumn("status", F.coalesce("status", "__status")).drop("__status")


def mart_race_results(results: DataFrame, race_results: DataFrame, schedule: DataFrame) -> DataFrame:
    sprint = schedule.select(*RACE, "is_sprint_weekend")
    return race_spine(results, race_results).join(sprint, RACE, "left").select(
        surrogate_key(*RACE, "driver_id").alias("result_id"),
        *RACE,
        "driver_id",
        "driver_number",
        "abbreviation",
        "full_name",
        "team_id",
        "team_name",
        "team_color",
        "constructor",
        "race_name",
        "circuit",
        "race_date",
        "is_sprint_weekend",
        "grid_position",
        "finish_position",
        "classified_position",
        "laps",
        "race_time_seconds",
        "points",
        "status",
        "fastest_lap_rank",
    )


def _standings(df: DataFrame, owner: str, described: Sequence[str]) -> DataFrame:
    # one row per round and owner, so a window partition holds one season's rounds
    rounds = Window.partitionBy("season", owner).orderBy(F.col("round").asc_nulls_last())
    gained = F.col("championship_points") - F.lag("championship_points").over(rounds)
    return df.select(
        surrogate_key(*RACE, owner).alias("standing_id"),
        *RACE,
        owner,
        *described,
        "championship_position",
        "championship_points",
        "wins",
        gained.alias("points_this_round"),
    )


def mart_driver_standings(standings: DataFrame) -> DataFrame:
    return _standings(
        standings,
        "driver_id",
        ["abbreviation", "driver_name", "driver_dob", "driver_country", "constructor", "constructor_country"],
    )


def mart_constructor_standings(standings: DataFrame) -> DataFrame:
    return _standings(standings, "constructor_id", ["constructor", "constructor_country"])


def mart_lap_times(laps: DataFrame, results: DataFrame) -> DataFrame:
    return laps.join(driver_info(results), ENTRY, "left").select(
        surrogate_key(*ENTRY, "lap_number").alias("lap_id"),
        *ENTRY,
        "driver_id",
        "full_name",
        "team_id",
        "team_name",
        "team_color",
        "lap_number",
        "stint",
        "lap_time_seconds",
        "sector1_time_seconds",
        "sector2_time_seconds",
        "sector3_time_seconds",
        "speed_i1",
        "speed_i2",
        "speed_fl",
        "speed_st",
        "compound",
        "tyre_life",
        "fresh_tyre",
        "is_accurate",
        "is_personal_best",
        "track_status",
        F.col("position").alias("track_position"),
        "pit_out_time_seconds",
        "pit_in_time_seconds",
    )


def pit_stops_enriched(
    pit_stops: DataFrame,
    laps: DataFrame,
    results: DataFrame,
    next_lap: bool = False,
    chunk_laps: float = 4096,
) -> DataFrame:
    """Pit stops with the lap they ended on.

    ``compound_starting`` is the compound of the driver's next *stop*, so the
    last stop has none; ``next_lap`` takes the compound of the lap after the
    stop instead.
    """
    drivers = results.select(
        *RACE, "driver_id", F.col("abbreviation").alias("driver_abbreviation")
    ).distinct()
    lap_facts = laps.select(
        *RACE,
        F.col("abbreviation").alias("driver_abbreviation"),
        F.col("lap_number").alias("lap_pitted"),
        F.col("stint").alias("stint_ending"),
        F.col("compound").alias("compound_ending"),
        F.col("tyre_life").alias("tyre_age_at_pit"),
        F.col("lap_time_seconds").alias("pit_lap_time_seconds"),
        F.col("is_accurate").alias("pit_lap_is_accurate"),
        F.lit(True).alias("__found"),
    )
    entry = [*RACE, "driver_abbreviation"]
    joined = pit_stops.join(drivers, [*RACE, "driver_id"], "left").join(
        lap_facts, [*entry, "lap_pitted"], "left"
    )
    if next_lap:
        following = laps.select(
            *RACE,
            F.col("abbreviation").alias("driver_abbreviation"),
            (F.col("lap_number") - 1).alias("lap_pitted"),
            F.col("compound").alias("compound_starting"),
        )
        return joined.join(following, [*entry, "lap_pitted"], "left").drop("__found")
    # A stop whose lap is unknown has no compound and comes after all others.  Such stops can pile
    # up on one key, so they are dealt out over many chunks; their order does not matter.
    placed = joined.withColumn("__lap", F.when(F.col("__found"), F.col("lap_pitted")))
    unplaced = F.lit(1 << 40) + F.pmod(F.xxhash64("driver_id", "pit_stop_number"), F.lit(4096))
    return shift(
        placed,
        entry,
        ["__lap", "pit_stop_number"],
        {"compound_starting": "compound_ending"},
        1,
        F.coalesce(chunk_of("__lap", chunk_laps), unplaced),
    ).drop("__found", "__lap")


def mart_pit_stops(
    pit_stops: DataFrame,
    laps: DataFrame,
    results: DataFrame,
    next_lap: bool = False,
    slow: float = 30.0,
) -> DataFrame:
    return pit_stops_enriched(pit_stops, laps, results, next_lap).select(
        surrogate_key(*RACE, "driver_id", "pit_stop_number").alias("pit_stop_id"),
        *RACE,
        "driver_id",
        "driver_abbreviation",
        "race_name",
        "circuit",
        "race_date",
        "pit_stop_number",
        "lap_pitted",
        "pit_in_time",
        "pit_stop_duration_seconds",
        "stint_ending",
        "compound_ending",
        "compound_starting",
        "tyre_age_at_pit",
        "pit_lap_time_seconds",
        "pit_lap_is_accurate",
        F.coalesce(F.col("pit_stop_duration_seconds") > slow, F.lit(False)).alias("is_slow_pit_stop"),
    )


STINT = [*ENTRY, "stint", "compound", "fresh_tyre"]


def exact_slope(seconds: str, x: str) -> Column:
    """Least-squares slope of times over a whole number, NULL unless that takes two values.

    Times are whole nanoseconds, so all sums are exact and a slope that lies on a limit stays on it; ``regr_slope`` may be
    off by the last bit.  Seconds and the rest are summed apart, which keeps the sums within 64 bits.
    """
    ns = F.rint(F.col(seconds) * F.lit(1e9)).try_cast("bigint")
    known = ns.isNotNull() & F.col(x).isNotNull()
    rest = ns % F.lit(1_000_000_000)
    whole = ((ns - rest) / F.lit(1e9)).cast("bigint")

    def total(value: Column) -> Column:
        return F.sum(F.when(known, value)).cast("decimal(38,0)")

    def time(weight: Column) -> Column:
        return total(weight * whole) * F.lit(1_000_000_000) + total(weight * rest)

    one, at = F.lit(1).cast("bigint"), F.col(x)
    n = total(one)
    spread = n * total(at * at) - total(at) * total(at)
    rise = n * time(at) - total(at) * time(one)
    return F.when(spread != 0, F.try_divide(rise, spread)).cast("double") / F.lit(1e9)


def tyre_stints(laps: DataFrame) -> DataFrame:
    """Length, pace (accurate laps) and degradation (all timed laps) of every stint."""
    accurate = F.when(F.col("is_accurate"), F.col("lap_time_seconds"))
    return (
        laps.where(F.col("lap_time_seconds").isNotNull())
        .groupBy(*STINT)
        .agg(
            F.min("lap_number").alias("stint_start_lap"),
            F.max("lap_number").alias("stint_end_lap"),
            F.count(F.lit(1)).alias("stint_length_laps"),
            F.max("tyre_life").alias("tyre_age_end"),
            F.avg(accurate).alias("avg_lap_time_seconds"),
            F.min(accurate).alias("fastest_lap_seconds"),
            exact_slope("lap_time_seconds", "tyre_life").alias("degradation_rate_seconds_per_lap"),
        )
    )


def _with_driver(stints: DataFrame, results: DataFrame, key_name: str) -> DataFrame:
    facts = [c for c in stints.columns if c not in ENTRY]
    return stints.join(driver_info(results), ENTRY, "left").select(
        surrogate_key(*ENTRY, "stint").alias(key_name),
        *ENTRY,
        "driver_id",
        "full_name",
        "team_id",
        "team_name",
        "team_color",
        *facts,
    )


def mart_tyre_strategy(laps: DataFrame, results: DataFrame) -> DataFrame:
    return _with_driver(tyre_stints(laps), results, "tyre_stint_id")


def telemetry_stints(
    telemetry: DataFrame,
    laps: DataFrame,
    drs_open: Sequence[int] = DRS_OPEN,
    full_throttle: float = 99,
    digits: int | None = 3,
) -> DataFrame:
    """Telemetry figures per stint.

    Samples are first reduced to one row of sums per lap, in place; only those
    rows meet the laps, so the join moves laps, not samples.
    """

    def share(condition: Column) -> Column:
        return F.sum(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))

    per_lap = telemetry.groupBy(*ENTRY, "lap_number").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(c).alias(f"__sum_{c}") for c in ("speed", "throttle", "n_gear")],
        *[F.count(c).alias(f"__n_{c}") for c in ("speed", "throttle", "n_gear")],
        F.max("speed").alias("__max_speed"),
        F.min(F.when(F.col("speed") > 0, F.col("speed"))).alias("__min_speed"),
        share(F.col("throttle") >= full_throttle).alias("__full"),
        share(F.col("brake")).alias("__brake"),
        share(F.col("drs").isin(*drs_open)).alias("__drs"),
        F.max("distance").alias("__distance"),
    )
    context = laps.where(F.col("stint").isNotNull()).select(
        *ENTRY, "lap_number", "stint", "compound", "tyre_life", "fresh_tyre"
    )

    def mean(c: str) -> Column:
        return rounded(F.try_divide(F.sum(f"__sum_{c}"), F.sum(f"__n_{c}")), digits)

    def percent(c: str) -> Column:
        return rounded(F.sum(c) / F.sum("__n") * F.lit(100.0), digits)

    return (
        per_lap.join(context, [*ENTRY, "lap_number"])
        .groupBy(*STINT)
        .agg(
            F.count_distinct("lap_number").alias("stint_laps"),
            F.min("tyre_life").alias("tyre_age_start"),
            F.max("tyre_life").alias("tyre_age_end"),
            mean("speed").alias("avg_speed"),
            F.max("__max_speed").alias("max_speed"),
            rounded(F.min("__min_speed"), digits).alias("min_speed_on_throttle"),
            mean("throttle").alias("avg_throttle"),
            percent("__full").alias("full_throttle_pct"),
            percent("__brake").alias("brake_pct"),
            percent("__drs").alias("drs_open_pct"),
            mean("n_gear").alias("avg_gear"),
            F.max("__distance").alias("max_distance_metres"),
        )
    )


def mart_telemetry_stints(
    telemetry: DataFrame,
    laps: DataFrame,
    results: DataFrame,
    drs_open: Sequence[int] = DRS_OPEN,
    full_throttle: float = 99,
    digits: int | None = 3,
) -> DataFrame:
    stints = telemetry_stints(telemetry, laps, drs_open, full_throttle, digits)
    return _with_driver(stints, results, "telemetry_stint_id")


def mart_weather(weather: DataFrame, schedule: DataFrame) -> DataFrame:
    race = schedule.select(*RACE, "race_name", "circuit", "race_datetime", "is_sprint_weekend")
    return weather.join(race, RACE, "left").select(
        surrogate_key(*RACE, F.col("session_elapsed_seconds").cast("string")).alias("weather_id"),
        *RACE,
        "race_name",
        "circuit",
        "race_datetime",
        "is_sprint_weekend",
        "session_elapsed_seconds",
        "air_temp",
        "track_temp",
        (F.col("track_temp") - F.col("air_temp")).alias("track_air_temp_delta"),
        "humidity",
        "pressure",
        "rainfall",
        "wind_speed",
        "wind_direction",
    )
