"""Declared schemas (DDL text) of the raw inputs and the list of silver sources."""

from __future__ import annotations

_LINEAGE = "source string, ingested_at string"


def _schema(ddl: str) -> str:
    return f"{ddl}, {_LINEAGE}"


RACE_RESULTS = _schema(
    "season int, round int, race_name string, circuit string, date string, driver_id string, "
    "driver_code string, driver_name string, constructor string, grid int, position int, "
    "points double, status string, fastest_lap_rank double"
)
DRIVER_STANDINGS = _schema(
    "season int, round int, driver_id string, driver_code string, driver_name string, driver_dob string, "
    "driver_country string, constructor string, constructor_country string, position int, points double, wins int"
)
CONSTRUCTOR_STANDINGS = _schema(
    "season int, round int, constructor_id string, constructor string, constructor_country string, "
    "position int, points double, wins int"
)
PIT_STOPS = _schema(
    "season int, round int, race_name string, circuit string, date string, driver_id string, "
    "lap_pitted string, stop_num string, pit_in_time string, pit_stop_duration string"
)
RACE_SCHEDULE = _schema(
    "season int, round int, race_name string, circuit string, race_date string, race_start_time string, "
    "fp1_date string, fp1_time string, fp2_date string, fp2_time string, fp3_date string, fp3_time string, "
    "sprint_qualy_date string, sprint_qualy_time string, qualy_date string, qualy_time string"
)
RESULTS = _schema(
    "driver_number string, broadcast_name string, abbreviation string, driver_id string, team_name string, "
    "team_color string, team_id string, first_name string, last_name string, full_name string, "
    "headshot_url string, country_code string, position double, classified_position string, "
    "grid_position double, q1 bigint, q2 bigint, q3 bigint, time bigint, status string, points double, "
    "laps double, season int, round int"
)
LAPS = _schema(
    "time bigint, driver string, driver_number string, lap_time bigint, lap_number double, stint double, "
    "pit_out_time bigint, pit_in_time bigint, sector1_time bigint, sector2_time bigint, sector3_time bigint, "
    "sector1_session_time bigint, sector2_session_time bigint, sector3_session_time bigint, "
    "speed_i1 double, speed_i2 double, speed_fl double, speed_st double, is_personal_best boolean, "
    "compound string, tyre_life double, fresh_tyre boolean, team string, lap_start_time bigint, "
    "lap_start_date timestamp, track_status string, position double, deleted boolean, deleted_reason string, "
    "fast_f1_generated boolean, is_accurate boolean, season int, round int"
)
TELEMETRY = _schema(
    "date timestamp, session_time bigint, driver_ahead string, distance_to_driver_ahead double, time bigint, "
    "rpm double, speed double, n_gear int, throttle double, brake boolean, drs int, distance double, "
    "relative_distance double, status string, x double, y double, z double, season int, round int, "
    "driver string, team string, lap_number bigint"
)
WEATHER = _schema(
    "time bigint, air_temp double, humidity double, pressure double, rainfall boolean, track_temp double, "
    "wind_direction int, wind_speed double, season int, round int"
)

#: The nine raw tables.
RAW_TABLES = {
    "race_results": RACE_RESULTS,
    "driver_standings": DRIVER_STANDINGS,
    "constructor_standings": CONSTRUCTOR_STANDINGS,
    "pit_stops": PIT_STOPS,
    "race_schedule": RACE_SCHEDULE,
    "results": RESULTS,
    "laps": LAPS,
    "telemetry": TELEMETRY,
    "weather": WEATHER,
}

#: Grain of every silver table.
SILVER_KEYS = {
    "race_results": ["season", "round", "driver_id"],
    "driver_standings": ["season", "round", "driver_id"],
    "constructor_standings": ["season", "round", "constructor_id"],
    "pit_stops": ["season", "round", "driver_id", "stop_num"],
    "race_schedule": ["season", "round"],
    "results": ["season", "round", "driver_id"],
    "laps": ["season", "round", "driver", "lap_number"],
    "telemetry": ["season", "round", "driver", "lap_number", "date"],
    "weather": ["season", "round", "time_seconds"],
}
