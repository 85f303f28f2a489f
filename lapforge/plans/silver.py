"""Cleaning jobs: raw table in, typed and de-duplicated table out.

``order_cols`` says what "last" means when a key occurs more than once; all
other columns break remaining ties.  ``losses`` counts what a job loses, by cause,
while it runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapforge import functions as fn
from lapforge.operators.losses import Losses
from lapforge.operators.ordered import chunk_of, forward_fill, keep_last
from lapforge.schemas import SILVER_KEYS

BY_LOAD = ("ingested_at",)

#: Lap columns that arrive in nanoseconds.
LAP_DURATIONS = (
    "time",
    "lap_time",
    "pit_out_time",
    "pit_in_time",
    "sector1_time",
    "sector2_time",
    "sector3_time",
    "sector1_session_time",
    "sector2_session_time",
    "sector3_session_time",
    "lap_start_time",
)

#: Weekend sessions of the schedule: output column <- date column, time column.
SESSIONS = {
    "race_datetime": ("race_date", "race_start_time"),
    "fp1_datetime": ("fp1_date", "fp1_time"),
    "fp2_datetime": ("fp2_date", "fp2_time"),
    "fp3_datetime": ("fp3_date", "fp3_time"),
    "sprint_qualy_datetime": ("sprint_qualy_date", "sprint_qualy_time"),
    "qualy_datetime": ("qualy_date", "qualy_time"),
}


def _loaded() -> Column:
    return fn.utc_timestamp("ingested_at", strict=True)


def _durations_to_seconds(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.withColumns({f"{c}_seconds": fn.ns_to_seconds(c) for c in present}).drop(*present)


def _watched(df: DataFrame, losses: Losses | None, read: dict[str, Column]) -> DataFrame:
    """Raw rows with columns read (each value once), and how many values are there but cannot be read."""
    if losses is None:
        return df.withColumns(read)
    there = df.withColumns({f"__{c}": value for c, value in read.items()})
    unreadable = {c: F.col(c).isNotNull() & F.col(f"__{c}").isNull() for c in read}
    seen = losses.watch(there, "rows_in", unreadable=unreadable)
    return seen.withColumns({c: F.col(f"__{c}") for c in read}).drop(*[f"__{c}" for c in read])


def _kept(
    typed: DataFrame, table: str, order_cols: Sequence[str], losses: Losses | None, required: Sequence[str] = ()
) -> DataFrame:
    """The last row of every key, without rows that lack a required value."""
    if losses is not None:
        typed = losses.watch(typed, missing={c: F.col(c).isNull() for c in required})
    kept = keep_last(typed.dropna(subset=list(required)) if required else typed, SILVER_KEYS[table], order_cols)
    return kept if losses is None else losses.watch(kept, "rows_out")


def clean_laps(df: DataFrame, order_cols: Sequence[str] = BY_LOAD, losses: Losses | None = None) -> DataFrame:
    whole = {c: fn.whole_number(c) for c in ("lap_number", "stint", "tyre_life", "position")}
    df = _watched(df, losses, {"lap_start_date": fn.utc_timestamp("lap_start_date"), **whole})
    typed = _durations_to_seconds(df, LAP_DURATIONS).withColumns(
        {
            "deleted": F.col("deleted").cast("boolean"),
            "ingested_at": _loaded(),
            "abbreviation": F.col("driver"),
            "team": fn.slugify("team"),
            "deleted_reason": fn.blank_to_null("deleted_reason"),
            "track_status": fn.blank_to_null("track_status"),
            "compound": F.coalesce("compound", F.lit("UNKNOWN")),
        }
    )
    return _kept(typed, "laps", order_cols, losses)


def clean_results(df: DataFrame, order_cols: Sequence[str] = BY_LOAD, losses: Losses | None = None) -> DataFrame:
    whole = {c: fn.whole_number(c) for c in ("position", "grid_position", "laps")}
    typed = _watched(df, losses, whole).withColumns(
        {
            "ingested_at": _loaded(),
            "time_seconds": fn.ns_to_seconds("time"),
            "driver_id": fn.slugify("driver_id"),
            "team_id": fn.slugify("team_id"),
        }
    ).na.fill(
        {
            "status": "Unknown",
            "classified_position": "Unknown",
            "first_name": "Unknown",
            "last_name": "Unknown",
            "full_name": "Unknown Driver",
        }
    )
    slim = typed.drop("headshot_url", "country_code", "q1", "q2", "q3", "time")
    return _kept(slim, "results", order_cols, losses)


def _telemetry_columns(df: DataFrame) -> DataFrame:
    """All but the date, which :func:`_watched` reads."""
    return df.withColumns(
        {
            "session_time_seconds": fn.ns_to_seconds("session_time"),
            "lap_time_seconds": fn.ns_to_seconds("time"),
            "ingested_at": _loaded(),
            "abbreviation": F.col("driver"),
            "team": fn.slugify("team"),
            "driver_ahead": fn.blank_to_null("driver_ahead"),
            "status": fn.blank_to_null("status"),
        }
    ).drop("session_time", "time")


def typed_telemetry(df: DataFrame) -> DataFrame:
    """The row-by-row part of telemetry cleaning; samples without a distance are dropped."""
    return _telemetry_columns(_watched(df, None, {"date": fn.utc_timestamp("date")})).dropna(subset=["distance"])


def clean_telemetry(df: DataFrame, order_cols: Sequence[str] = BY_LOAD, losses: Losses | None = None) -> DataFrame:
    typed = _telemetry_columns(_watched(df, losses, {"date": fn.utc_timestamp("date")}))
    return _kept(typed, "telemetry", order_cols, losses, ["distance"])


def clean_weather(
    df: DataFrame, order_cols: Sequence[str] = BY_LOAD, losses: Losses | None = None, chunk_seconds: float = 3600.0
) -> DataFrame:
    """Gaps of the two temperatures are filled forward within a session, then de-duplicated."""
    df = _watched(df, losses, {"time": fn.ns_to_seconds("time")})
    typed = df.withColumns({"time_seconds": F.col("time"), "ingested_at": _loaded()}).drop("time")
    # NaN is a gap as well
    typed = typed.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("air_temp", "track_temp")})
    key, temperatures = SILVER_KEYS["weather"], ["air_temp", "track_temp"]
    ties = [c for c in typed.columns if c not in order_cols and c not in key]
    order = F.struct(*order_cols, *ties)
    # Readings at one time become one before anything is ordered, so copies never pile up: the last
    # reading is kept, with the last temperature known by then.
    kept = [c for c in typed.columns if c not in key and c not in temperatures]
    readings = (
        typed.groupBy(*key)
        .agg(
            F.max_by(F.struct(*kept), order).alias("__last"),
            *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in temperatures],
        )
        .select(*key, *temperatures, "__last.*")
    )
    filled = forward_fill(
        readings, ["season", "round"], ["time_seconds"], temperatures, chunk_of("time_seconds", chunk_seconds)
    )
    filled = filled.select(*typed.columns)
    return filled if losses is None else losses.watch(filled, "rows_out", unfilled={c: F.col(c).isNull() for c in temperatures})


def clean_race_results(df: DataFrame, order_cols: Sequence[str] = BY_LOAD, losses: Losses | None = None) -> DataFrame:
    typed = _watched(df, losses, {}).withColumns(
        {
            "date": fn.date_strict("date"),
            "ingested_at": _loaded(),
            "fastest_lap_rank": F.col("fastest_lap_rank").cast("double").cast("bigint"),
            "driver_id": fn.slugify("driver_id"),
            "constructor": fn.slugify("constructor"),
            "abbreviation": F.coalesce("driver_code", F.lit("UNK")),
        }
    ).na.fill({"status": "Unknown", "driver_name": "Unknown Driver"})
    return _kept(typed, "race_results", order_cols, losses)


def clean_driver_standings(df: DataFrame, order_cols: Sequence[str] = BY_LOAD, losses: Losses | None = None) -> DataFrame:
    typed = _watched(df, losses, {}).withColumns(
        {
            "driver_dob": fn.date_strict("driver_dob"),
            "ingested_at": _loaded(),
            "driver_id": fn.slugify("driver_id"),
            "constructor": fn.slugify("constructor"),
            "abbreviation": F.coalesce("driver_code", F.lit("UNK")),
        }
    ).na.fill(
        {"driver_country": "Unknown", "constructor_country": "Unknown", "driver_name": "Unknown Driver"}
    )
    return _kept(typed, "driver_standings", order_cols, losses)


def clean_constructor_standings(df: DataFrame, order_cols: Sequence[str] = BY_LOAD, losses: Losses | None = None) -> DataFrame:
    typed = _watched(df, losses, {}).withColumns(
        {"ingested_at": _loaded(), "constructor_id": fn.slugify("constructor_id")}
    ).na.fill({"constructor_country": "Unknown", "constructor": "Unknown Constructor"})
    return _kept(typed, "constructor_standings", order_cols, losses)


def clean_pit_stops(df: DataFrame, order_cols: Sequence[str] = BY_LOAD, losses: Losses | None = None) -> DataFrame:
    """Stops whose duration cannot be read are dropped."""
    read = {
        "lap_pitted": fn.whole_number("lap_pitted"),
        "stop_num": fn.whole_number("stop_num"),
        "pit_in_time": fn.time_of_day("pit_in_time"),
        "pit_stop_duration": fn.duration_to_seconds("pit_stop_duration"),
    }
    typed = _watched(df, losses, read).withColumns(
        {"date": fn.date_strict("date"), "ingested_at": _loaded(), "driver_id": fn.slugify("driver_id")}
    )
    return _kept(typed, "pit_stops", order_cols, losses, ["pit_stop_duration"])


def clean_race_schedule(df: DataFrame, order_cols: Sequence[str] = BY_LOAD, losses: Losses | None = None) -> DataFrame:
    """Sessions without both source columns are left out."""
    pairs = {out: pair for out, pair in SESSIONS.items() if set(pair) <= set(df.columns)}
    read = {out: fn.date_time(*pair) for out, pair in pairs.items()}
    if losses is not None:
        there = {out: F.col(pair[0]).isNotNull() & F.col(pair[1]).isNotNull() for out, pair in pairs.items()}
        df = losses.watch(df, "rows_in", unreadable={out: there[out] & read[out].isNull() for out in pairs})
    typed = (
        df.withColumns(read)
        .drop(*[c for pair in pairs.values() for c in pair])
        .withColumn("ingested_at", _loaded())
        .na.fill({"race_name": "Unknown Race", "circuit": "Unknown Circuit"})
    )
    return _kept(typed, "race_schedule", order_cols, losses)


CLEANERS = {
    "race_results": clean_race_results,
    "driver_standings": clean_driver_standings,
    "constructor_standings": clean_constructor_standings,
    "pit_stops": clean_pit_stops,
    "race_schedule": clean_race_schedule,
    "results": clean_results,
    "laps": clean_laps,
    "telemetry": clean_telemetry,
    "weather": clean_weather,
}
