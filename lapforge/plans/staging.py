"""Staging projections: which silver columns are published, and under what name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Per table: published columns in order.  ``"new<-old"`` renames.
PROJECTIONS = {
    "laps": """
        season round abbreviation driver_number team lap_number stint
        lap_time_seconds sector1_time_seconds sector2_time_seconds sector3_time_seconds
        session_elapsed_seconds<-time_seconds lap_start_time_seconds pit_out_time_seconds pit_in_time_seconds
        sector1_session_time_seconds sector2_session_time_seconds sector3_session_time_seconds
        speed_i1 speed_i2 speed_fl speed_st compound tyre_life fresh_tyre
        is_personal_best is_accurate fast_f1_generated track_status position
    """,
    "results": """
        season round driver_id driver_number broadcast_name abbreviation first_name last_name full_name
        team_id team_name team_color grid_position finish_position<-position classified_position
        laps status points race_time_seconds<-time_seconds
    """,
    "telemetry": """
        season round abbreviation team lap_number telemetry_timestamp<-date
        session_elapsed_seconds<-session_time_seconds lap_time_seconds
        rpm speed n_gear throttle brake drs distance relative_distance x y z
        driver_ahead distance_to_driver_ahead track_status<-status
    """,
    "weather": """
        season round session_elapsed_seconds<-time_seconds air_temp track_temp
        humidity pressure rainfall wind_direction wind_speed
    """,
    "constructor_standings": """
        season round constructor_id constructor constructor_country
        championship_position<-position championship_points<-points wins
    """,
    "driver_standings": """
        season round driver_id abbreviation driver_name driver_dob driver_country
        constructor constructor_country championship_position<-position championship_points<-points wins
    """,
    "pit_stops": """
        season round driver_id race_name circuit race_date<-date pit_stop_number<-stop_num
        lap_pitted pit_in_time pit_stop_duration_seconds<-pit_stop_duration
    """,
    "race_results": """
        season round driver_id abbreviation driver_name constructor race_name circuit race_date<-date
        grid_position<-grid finish_position<-position points status fastest_lap_rank
    """,
    "race_schedule": """
        season round race_name circuit race_datetime fp1_datetime fp2_datetime fp3_datetime
        sprint_qualy_datetime qualy_datetime
    """,
}


def staged(df: DataFrame, table: str) -> DataFrame:
    """The published projection of one silver table."""
    columns = []
    for item in PROJECTIONS[table].split():
        new, _, old = item.partition("<-")
        columns.append(F.col(old or new).alias(new))
    out = df.select(*columns)
    if table == "race_schedule":
        out = out.withColumn("is_sprint_weekend", F.col("sprint_qualy_datetime").isNotNull())
    return out


def staged_view(df: DataFrame, table: str) -> DataFrame:
    """Register the projection as temporary view ``stg_<table>`` and return it."""
    out = staged(df, table)
    out.createOrReplaceTempView(f"stg_{table}")
    return out
