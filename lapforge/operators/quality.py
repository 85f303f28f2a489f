"""Data-quality checks; each returns the rows (or counts) that matter, never a verdict on the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Failing rows per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column", "failures")


def null_rows(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values (or value combinations) that occur more than once, NULLs aside."""
    known = df.dropna(subset=list(cols), how="any")
    return known.groupBy(*cols).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def out_of_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies outside [low, high]."""
    return df.where((F.col(col) < low) | (F.col(col) > high))


def implausible_pit_stops(pit_stops: DataFrame, low: float = 1.5, high: float = 1200.0) -> DataFrame:
    return out_of_range(pit_stops, "pit_stop_duration_seconds", low, high).select(
        "pit_stop_id", "season", "round", "driver_id", "pit_stop_number", "pit_stop_duration_seconds"
    )


def degradation_outliers(stints: DataFrame, low: float = -2.0, high: float = 5.0) -> DataFrame:
    return out_of_range(stints, "degradation_rate_seconds_per_lap", low, high).select(
        "season",
        "round",
        "abbreviation",
        "stint",
        "compound",
        "stint_length_laps",
        "degradation_rate_seconds_per_lap",
    )


def profile_nulls(df: DataFrame, cols: Sequence[str] | None = None, zero_is_missing: Sequence[str] = ()) -> DataFrame:
    """Row count and missing values per column, one row per column, one pass over the data."""
    cols = list(cols or df.columns)

    def missing(c: str):
        gone = F.col(c).isNull()
        return gone | (F.col(c) == 0) if c in zero_is_missing else gone

    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(missing(c)).alias(c) for c in cols])
    return wide.unpivot("__rows", cols, "column", "missing").select(
        "column", F.col("__rows").alias("rows"), "missing"
    )


def expected_rounds(tables: Mapping[str, tuple[DataFrame, str]], expected: Mapping[str, int]) -> DataFrame:
    """Per table and season: rows, rounds, NULLs in its key column, and whether all is as expected."""
    from lapforge.sources.catalog import union_all

    parts = []
    for name, (df, key) in tables.items():
        races = df.groupBy("season", "round").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("empty")
        )
        checked = races.groupBy("season").agg(
            F.sum("n").alias("rows"), F.count("round").alias("rounds"), F.sum("empty").alias("key_nulls")
        )
        passed = (F.col("rounds") == expected[name]) & (F.col("key_nulls") == 0)
        parts.append(
            checked.select(F.lit(name).alias("table"), "season", "rows", "rounds", "key_nulls", passed.alias("passed"))
        )
    return union_all(parts)


def lap_sanity(laps: DataFrame) -> DataFrame:
    """Accurate laps per race: how many, by how many drivers, fastest and slowest."""
    return (
        laps.where(F.col("is_accurate"))
        .groupBy("season", "round", "abbreviation")
        .agg(F.count(F.lit(1)).alias("n"), F.min("lap_time_seconds").alias("low"), F.max("lap_time_seconds").alias("high"))
        .groupBy("season", "round")
        .agg(
            F.sum("n").alias("total_laps"),
            F.count("abbreviation").alias("drivers"),
            F.min("low").alias("fastest_lap"),
            F.max("high").alias("slowest_lap"),
        )
    )


def telemetry_sanity(telemetry: DataFrame, required: Sequence[str] = ("speed", "throttle", "distance")) -> DataFrame:
    """Samples, drivers, laps and samples without any of the required channels per race."""
    empty = F.lit(True)
    for c in required:
        empty = empty & F.col(c).isNull()
    laps = telemetry.groupBy("season", "round", "abbreviation", "lap_number").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(empty).alias("empty")
    )
    return laps.groupBy("season", "round").agg(
        F.sum("n").alias("total_rows"),
        F.count_distinct("abbreviation").alias("drivers"),
        F.count_distinct("lap_number").alias("laps"),
        F.sum("empty").alias("empty_rows"),
    )


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def drop_report(name: str, before: DataFrame, after: DataFrame, alarm_pct: float = 10.0) -> DataFrame:
    """Rows before and after cleaning, share dropped, and whether that share is alarming."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = before.select(one.alias("b"), none.alias("s")).unionAll(after.select(none.alias("b"), one.alias("s")))
    counts = both.agg(
        F.coalesce(F.sum("b"), none).alias("bronze"), F.coalesce(F.sum("s"), none).alias("silver")
    )
    dropped = F.col("bronze") - F.col("silver")
    pct = F.coalesce(F.try_divide(dropped.cast("double") * F.lit(100.0), F.col("bronze")), F.lit(0.0))
    return counts.select(
        F.lit(name).alias("table"),
        "bronze",
        "silver",
        dropped.alias("dropped"),
        pct.alias("dropped_pct"),
        (pct > alarm_pct).alias("alarm"),
    )


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame itself plus an observation that counts its rows while a job runs over it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
