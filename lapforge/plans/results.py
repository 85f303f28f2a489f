"""Analyses of race results and championship standings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapforge.functions import rounded
from lapforge.plans.pace import RACE, season_pace


def loaded_rounds(df: DataFrame) -> DataFrame:
    """Seasons and rounds that are present."""
    return df.select(*RACE).distinct()


def race_names(race_results: DataFrame) -> DataFrame:
    return race_results.select(*RACE, "race_name").distinct()


def latest_round(df: DataFrame) -> DataFrame:
    """Last round of every season (one row per season)."""
    return df.groupBy("season").agg(F.max("round").alias("round"))


def at_latest_round(df: DataFrame, rounds_of: DataFrame) -> DataFrame:
    """Rows of the last round; one row per season travels, never a value through the driver."""
    return df.join(latest_round(rounds_of), RACE, "left_semi")


def latest_standings(standings: DataFrame, race_results: DataFrame) -> DataFrame:
    """Championship table after the last round that was raced."""
    return at_latest_round(standings, race_results).select(
        "season", "abbreviation", "constructor", "championship_points", "championship_position", "wins"
    )


def points_progression(standings: DataFrame, min_rounds: int = 2) -> DataFrame:
    """Points round by round, for seasons with at least ``min_rounds`` rounds."""
    enough = (
        standings.groupBy("season")
        .agg(F.count_distinct("round").alias("__rounds"))
        .where(F.col("__rounds") >= min_rounds)
        .select("season")
    )
    return standings.join(enough, "season", "left_semi").select(
        *RACE, "abbreviation", "constructor", "championship_points"
    )


def classified(race_results: DataFrame) -> DataFrame:
    """Results with both a grid and a finish position."""
    return race_results.where(F.col("grid_position").isNotNull() & F.col("finish_position").isNotNull())


def racecraft(race_results: DataFrame, digits: int | None = 2) -> DataFrame:
    """Places gained from grid to finish over a season."""
    return (
        classified(race_results)
        .groupBy("season", "abbreviation", "constructor")
        .agg(
            F.count(F.lit(1)).alias("races"),
            F.sum(F.col("grid_position") - F.col("finish_position")).alias("total_positions_gained"),
            rounded(F.avg("finish_position"), digits).alias("avg_finish"),
            rounded(F.avg("grid_position"), digits).alias("avg_grid"),
        )
    )


def grid_vs_finish(race_results: DataFrame) -> DataFrame:
    return classified(race_results).select(
        *RACE,
        "abbreviation",
        "constructor",
        "grid_position",
        "finish_position",
        (F.col("grid_position") - F.col("finish_position")).alias("positions_gained"),
    )


def head_to_head(race_results: DataFrame) -> DataFrame:
    """How often each of two team-mates finished ahead; a tie goes to the second of the pair.

    Pairs are formed within one team and race.  They are the result itself, so
    their number is that of the output before counting.
    """
    side = [*RACE, "constructor"]
    finished = race_results.where(F.col("finish_position").isNotNull())
    a = finished.select(*side, F.col("abbreviation").alias("driver_a"), F.col("finish_position").alias("__a"))
    b = finished.select(*side, F.col("abbreviation").alias("driver_b"), F.col("finish_position").alias("__b"))
    winner = F.when(F.col("__a") < F.col("__b"), F.col("driver_a")).otherwise(F.col("driver_b"))
    return (
        a.join(b, side)
        .where(F.col("driver_a") < F.col("driver_b"))
        .groupBy("season", "constructor", "driver_a", "driver_b", winner.alias("winner"))
        .agg(F.count(F.lit(1)).alias("rounds_ahead"))
    )


def scorecard(
    race_results: DataFrame,
    standings: DataFrame,
    lap_times: DataFrame,
    digits: tuple[int, int] | None = (2, 3),
) -> DataFrame:
    """Season summary per driver: results, championship points and pace."""
    two = digits[0] if digits else None
    finish, grid = F.col("finish_position"), F.col("grid_position")
    summary = (
        classified(race_results)
        .groupBy("season", "abbreviation", "constructor")
        .agg(
            F.count(F.lit(1)).alias("races"),
            F.count_if(finish == 1).alias("wins"),
            F.count_if(finish <= 3).alias("podiums"),
            rounded(F.avg(finish), two).alias("avg_finish"),
            rounded(F.avg(grid), two).alias("avg_grid"),
            F.sum(grid - finish).alias("net_positions_gained"),
        )
    )
    points = at_latest_round(standings, race_results).select(
        "season", "abbreviation", F.col("championship_points").alias("total_points")
    )
    who = ["season", "abbreviation"]
    return (
        summary.join(points, who, "left")
        .join(season_pace(lap_times, digits), who, "left")
        .select(
            *who,
            "constructor",
            "races",
            "total_points",
            "wins",
            "podiums",
            "avg_finish",
            "avg_grid",
            "net_positions_gained",
            "avg_median_pace_s",
            "avg_consistency_s",
            "avg_delta_to_fastest_s",
        )
    )


def ranked_scorecard(card: DataFrame) -> DataFrame:
    """Display order: most points first, drivers without points last."""
    return card.orderBy("season", F.col("total_points").desc_nulls_last(), F.col("avg_finish").asc_nulls_last())
