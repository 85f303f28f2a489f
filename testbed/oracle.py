"""The same tables written as plain SQL for DuckDB, independent of the library.

``sql(body)`` puts every table the body mentions in front of it as a CTE.
"""

from __future__ import annotations

import re

from testbed.bindings import STATEMENTS


def _key(*cols: str) -> str:
    parts = [f"coalesce(cast({c} as varchar), '_dbt_utils_surrogate_key_null_')" for c in cols]
    return "md5(concat(" + ", '-', ".join(parts) + "))"


def _secs(*cols: str) -> str:
    return ", ".join(f"cast({c} as double) / 1e9 as {c}_seconds" for c in cols)


def _slug(c: str) -> str:
    return f"replace(lower(trim({c})), ' ', '_')"


def _last(keys: str, order: str) -> str:
    desc = ", ".join(f"{c} desc nulls last" for c in order.split(", "))
    return f"row_number() over (partition by {keys} order by {desc})"


_NUM = "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$'"


def _number(c: str) -> str:
    return f"case when regexp_matches(trim({c}), {_NUM}) then cast(trim({c}) as double) end"


def _stamp(d: str, t: str) -> str:
    return f"try_cast(replace(concat_ws(' ', trim({d}), trim({t})), 'Z', '') as timestamp)"


CTES = {name: text.replace("{", "").replace("}", "") for name, text in STATEMENTS.items()}

CTES.update(
    {
        # --- silver -----------------------------------------------------------------------
        "silver_laps": f"""
            select * exclude (rn) from (
              select {_secs('time', 'lap_time', 'pit_out_time', 'pit_in_time', 'sector1_time', 'sector2_time',
                            'sector3_time', 'sector1_session_time', 'sector2_session_time',
                            'sector3_session_time', 'lap_start_time')},
                driver, driver_number, cast(lap_number as bigint) lap_number, cast(stint as bigint) stint,
                speed_i1, speed_i2, speed_fl, speed_st, is_personal_best, coalesce(compound, 'UNKNOWN') compound,
                cast(tyre_life as bigint) tyre_life, fresh_tyre, {_slug('team')} team, lap_start_date,
                nullif(track_status, '') track_status, cast(position as bigint) as position, deleted,
                nullif(deleted_reason, '') deleted_reason, fast_f1_generated, is_accurate, season, round,
                source, ingested_at, driver as abbreviation,
                {_last('season, round, driver, lap_number',
                       "ingested_at, time, sector1_session_time, sector2_session_time, speed_i1, speed_i2, "
                       "speed_fl, speed_st, nullif(track_status, ''), is_accurate, lap_time").replace(
                           "nullif(track_status desc nulls last, '') desc nulls last",
                           "nullif(track_status, '') desc nulls last")} rn
              from raw_laps) where rn = 1
        """,
        "silver_results": f"""
            select * exclude (rn) from (
              select driver_number, broadcast_name, abbreviation, {_slug('driver_id')} driver_id, team_name, team_color,
                {_slug('team_id')} team_id, coalesce(first_name, 'Unknown') first_name,
                coalesce(last_name, 'Unknown') last_name, coalesce(full_name, 'Unknown Driver') full_name,
                cast(position as bigint) as position, coalesce(classified_position, 'Unknown') classified_position,
                cast(grid_position as bigint) grid_position, coalesce(status, 'Unknown') status, points,
                cast(laps as bigint) laps, season, round, source, ingested_at, cast(time as double) / 1e9 time_seconds,
                {_last('season, round, driver_id', 'ingested_at')} rn
              from raw_results) where rn = 1
        """,
        "silver_telemetry": f"""
            select * exclude (rn) from (
              select cast(date as timestamp) date, nullif(driver_ahead, '') driver_ahead, distance_to_driver_ahead,
                rpm, speed, n_gear, throttle, brake, drs, distance, relative_distance, nullif(status, '') status,
                x, y, z, season, round, driver, {_slug('team')} team, lap_number, source, ingested_at,
                cast(session_time as double) / 1e9 session_time_seconds, cast(time as double) / 1e9 lap_time_seconds,
                driver as abbreviation,
                {_last('season, round, driver, lap_number, date', 'ingested_at, relative_distance')} rn
              from raw_telemetry where distance is not null) where rn = 1
        """,
        "silver_weather": f"""
            select * exclude (rn) from (
              select *, {_last('season, round, time_seconds', 'ingested_at, pressure')} rn from (
                select last_value(air_temp ignore nulls) over w air_temp, humidity, pressure, rainfall,
                  last_value(track_temp ignore nulls) over w track_temp, wind_direction, wind_speed,
                  season, round, source, ingested_at, cast(time as double) / 1e9 time_seconds
                from raw_weather
                window w as (partition by season, round order by time, ingested_at, pressure
                             rows between unbounded preceding and current row))) where rn = 1
        """,
        "silver_race_results": f"""
            select * exclude (rn) from (
              select season, round, race_name, circuit, cast(date as date) date, {_slug('driver_id')} driver_id,
                driver_code, coalesce(driver_name, 'Unknown Driver') driver_name, {_slug('constructor')} constructor,
                grid, position, points, coalesce(status, 'Unknown') status,
                cast(fastest_lap_rank as bigint) fastest_lap_rank, source, ingested_at,
                coalesce(driver_code, 'UNK') abbreviation,
                {_last('season, round, driver_id', 'ingested_at')} rn
              from raw_race_results) where rn = 1
        """,
        "silver_driver_standings": f"""
            select * exclude (rn) from (
              select season, round, {_slug('driver_id')} driver_id, driver_code,
                coalesce(driver_name, 'Unknown Driver') driver_name, cast(driver_dob as date) driver_dob,
                coalesce(driver_country, 'Unknown') driver_country, {_slug('constructor')} constructor,
                coalesce(constructor_country, 'Unknown') constructor_country, position, points, wins, source,
                ingested_at, coalesce(driver_code, 'UNK') abbreviation,
                {_last('season, round, driver_id', 'ingested_at')} rn
              from raw_driver_standings) where rn = 1
        """,
        "silver_constructor_standings": f"""
            select * exclude (rn) from (
              select season, round, {_slug('constructor_id')} constructor_id,
                coalesce(constructor, 'Unknown Constructor') constructor,
                coalesce(constructor_country, 'Unknown') constructor_country, position, points, wins, source,
                ingested_at, {_last('season, round, constructor_id', 'ingested_at')} rn
              from raw_constructor_standings) where rn = 1
        """,
        "silver_pit_stops": f"""
            select * exclude (rn) from (
              select *, {_last('season, round, driver_id, stop_num',
                               'ingested_at, pit_in_time, pit_stop_duration, lap_pitted')} rn from (
                select season, round, race_name, circuit, cast(date as date) date, {_slug('driver_id')} driver_id,
                  cast(lap_pitted as bigint) lap_pitted, cast(stop_num as bigint) stop_num,
                  case when cast(split_part(pit_in_time, ':', 1) as int) < 24 then pit_in_time end pit_in_time,
                  case when contains(pit_stop_duration, ':')
                       then {_number("split_part(pit_stop_duration, ':', 1)")} * 60
                            + {_number("split_part(pit_stop_duration, ':', 2)")}
                       else {_number('pit_stop_duration')} end pit_stop_duration, source, ingested_at
                from raw_pit_stops) where pit_stop_duration is not null) where rn = 1
        """,
        "silver_race_schedule": f"""
            select * exclude (rn) from (
              select season, round, coalesce(race_name, 'Unknown Race') race_name,
                coalesce(circuit, 'Unknown Circuit') circuit, source, ingested_at,
                {_stamp('race_date', 'race_start_time')} race_datetime, {_stamp('fp1_date', 'fp1_time')} fp1_datetime,
                {_stamp('fp2_date', 'fp2_time')} fp2_datetime, {_stamp('fp3_date', 'fp3_time')} fp3_datetime,
                {_stamp('sprint_qualy_date', 'sprint_qualy_time')} sprint_qualy_datetime,
                {_stamp('qualy_date', 'qualy_time')} qualy_datetime,
                {_last('season, round', 'ingested_at')} rn
              from raw_race_schedule) where rn = 1
        """,
        # --- marts ------------------------------------------------------------------------
        "driver_info": """
            select distinct season, round, driver_id, abbreviation, full_name, team_id, team_name, team_color
            from silver_results
        """,
        "mart_race_results": f"""
            select {_key('b.season', 'b.round', 'b.driver_id')} result_id, b.season, b.round, b.driver_id,
              b.driver_number, b.abbreviation, b.full_name, b.team_id, b.team_name, b.team_color, a.constructor,
              a.race_name, a.circuit, a.date race_date, s.sprint_qualy_datetime is not null is_sprint_weekend,
              b.grid_position, b.position finish_position, b.classified_position, b.laps,
              b.time_seconds race_time_seconds, a.points, coalesce(b.status, a.status) status, a.fastest_lap_rank
            from silver_results b
            left join silver_race_results a using (season, round, driver_id)
            left join silver_race_schedule s using (season, round)
        """,
        "mart_driver_standings": f"""
            select {_key('season', 'round', 'driver_id')} standing_id, season, round, driver_id, abbreviation,
              driver_name, driver_dob, driver_country, constructor, constructor_country,
              position championship_position, points championship_points, wins,
              points - lag(points) over (partition by season, driver_id order by round) points_this_round
            from silver_driver_standings
        """,
        "mart_constructor_standings": f"""
            select {_key('season', 'round', 'constructor_id')} standing_id, season, round, constructor_id, constructor,
              constructor_country, position championship_position, points championship_points, wins,
              points - lag(points) over (partition by season, constructor_id order by round) points_this_round
            from silver_constructor_standings
        """,
        "mart_lap_times": f"""
            select {_key('l.season', 'l.round', 'l.abbreviation', 'l.lap_number')} lap_id, l.season, l.round,
              l.abbreviation, d.driver_id, d.full_name, d.team_id, d.team_name, d.team_color, l.lap_number, l.stint,
              l.lap_time_seconds, l.sector1_time_seconds, l.sector2_time_seconds, l.sector3_time_seconds,
              l.speed_i1, l.speed_i2, l.speed_fl, l.speed_st, l.compound, l.tyre_life, l.fresh_tyre, l.is_accurate,
              l.is_personal_best, l.track_status, l.position track_position, l.pit_out_time_seconds,
              l.pit_in_time_seconds
            from silver_laps l left join driver_info d using (season, round, abbreviation)
        """,
        "mart_pit_stops": f"""
            select {_key('p.season', 'p.round', 'p.driver_id', 'p.stop_num')} pit_stop_id, p.season, p.round,
              p.driver_id, d.abbreviation driver_abbreviation, p.race_name, p.circuit, p.date race_date,
              p.stop_num pit_stop_number, p.lap_pitted, p.pit_in_time, p.pit_stop_duration pit_stop_duration_seconds,
              l.stint stint_ending, l.compound compound_ending, l.tyre_life tyre_age_at_pit,
              l.lap_time_seconds pit_lap_time_seconds, l.is_accurate pit_lap_is_accurate,
              lead(l.compound) over (partition by l.season, l.round, l.abbreviation
                                     order by l.lap_number, p.stop_num) compound_starting,
              case when p.pit_stop_duration > 30 then true else false end is_slow_pit_stop
            from silver_pit_stops p
            left join (select distinct season, round, driver_id, abbreviation from silver_results) d
              on p.season = d.season and p.round = d.round and p.driver_id = d.driver_id
            left join silver_laps l on p.season = l.season and p.round = l.round
              and d.abbreviation = l.abbreviation and p.lap_pitted = l.lap_number
        """,
        "tyre_stints": """
            select season, round, abbreviation, stint, compound, fresh_tyre, min(lap_number) stint_start_lap,
              max(lap_number) stint_end_lap, count(*) stint_length_laps, max(tyre_life) tyre_age_end,
              avg(case when is_accurate then lap_time_seconds end) avg_lap_time_seconds,
              min(case when is_accurate then lap_time_seconds end) fastest_lap_seconds,
              case when count(distinct tyre_life) > 1 then regr_slope(lap_time_seconds, tyre_life) end
                degradation_rate_seconds_per_lap
            from silver_laps where lap_time_seconds is not null
            group by season, round, abbreviation, stint, compound, fresh_tyre
        """,
        "mart_tyre_strategy": f"""
            select {_key('s.season', 's.round', 's.abbreviation', 's.stint')} tyre_stint_id, s.*,
              d.driver_id, d.full_name, d.team_id, d.team_name, d.team_color
            from tyre_stints s left join driver_info d using (season, round, abbreviation)
        """,
        "mart_telemetry_stints": f"""
            select {_key('season', 'round', 'abbreviation', 'stint')} telemetry_stint_id, s.*,
              d.driver_id, d.full_name, d.team_id, d.team_name, d.team_color
            from (
              select t.season, t.round, t.abbreviation, l.stint, l.compound, l.fresh_tyre,
                count(distinct t.lap_number) stint_laps, max(l.tyre_life) tyre_age_end, min(l.tyre_life) tyre_age_start,
                avg(speed) avg_speed, max(speed) max_speed,
                min(case when speed > 0 then speed end) min_speed_on_throttle, avg(throttle) avg_throttle,
                avg(case when throttle >= 99 then 1e0 else 0e0 end) * 100 full_throttle_pct,
                avg(case when brake then 1e0 else 0e0 end) * 100 brake_pct,
                avg(case when drs in (10, 12, 14) then 1e0 else 0e0 end) * 100 drs_open_pct,
                avg(n_gear) avg_gear, max(distance) max_distance_metres
              from silver_telemetry t
              left join silver_laps l on t.season = l.season and t.round = l.round
                and t.abbreviation = l.abbreviation and t.lap_number = l.lap_number
              where l.stint is not null
              group by t.season, t.round, t.abbreviation, l.stint, l.compound, l.fresh_tyre) s
            left join driver_info d using (season, round, abbreviation)
        """,
        "mart_weather": f"""
            select {_key('w.season', 'w.round', 'w.time_seconds')} weather_id, w.season, w.round,
              s.race_name, s.circuit, s.race_datetime, s.sprint_qualy_datetime is not null is_sprint_weekend,
              w.time_seconds session_elapsed_seconds, w.air_temp, w.track_temp,
              w.track_temp - w.air_temp track_air_temp_delta, w.humidity, w.pressure, w.rainfall, w.wind_speed,
              w.wind_direction
            from silver_weather w left join silver_race_schedule s using (season, round)
        """,
        # --- pace -------------------------------------------------------------------------
        "racing": "select * from mart_lap_times where lap_number > 1 and pit_out_time_seconds is null",
        "pace": """
            select season, round, abbreviation, team_id, median(lap_time_seconds) median_lap_s,
              stddev(lap_time_seconds) std_lap_s, count(*) lap_count,
              median(lap_time_seconds) - min(median(lap_time_seconds)) over (partition by season, round)
                delta_to_fastest_s
            from racing group by season, round, abbreviation, team_id
        """,
        "last_round": "select season, max(round) as round from mart_race_results group by season",
        "mates": """
            select a.season, a.round, a.abbreviation driver_a, b.abbreviation driver_b
            from mart_race_results a join mart_race_results b
              on a.season = b.season and a.round = b.round and a.team_id = b.team_id and a.abbreviation < b.abbreviation
        """,
        # --- telemetry --------------------------------------------------------------------
        "lap_pairs": """
            with best as (
              select season, round, team, abbreviation, lap_number from (
                select *, row_number() over (partition by season, round, abbreviation order by lap_time, lap_number) rn from (
                  select season, round, abbreviation, team, lap_number, min(lap_time_seconds) lap_time from silver_telemetry
                  where lap_time_seconds > 0 and lap_number is not null group by all)) where rn = 1)
            select a.season, a.round, a.abbreviation driver_a, a.lap_number lap_a, b.abbreviation driver_b, b.lap_number lap_b
            from best a join best b on a.season = b.season and a.round = b.round and a.team = b.team
              and a.abbreviation < b.abbreviation
        """,
        "pair_sides": """
            select *, 'a' side, driver_a drv, lap_a lap from lap_pairs
            union all select *, 'b', driver_b, lap_b from lap_pairs
        """,
        "pair_span": """
            select season, round, driver_a, lap_a, driver_b, lap_b, max(lo) glo, min(hi) ghi
            from (select p.*, (select min(distance) from silver_telemetry t where t.season = p.season
                     and t.round = p.round and t.abbreviation = p.drv and t.lap_number = p.lap) lo,
                  (select max(distance) from silver_telemetry t where t.season = p.season
                     and t.round = p.round and t.abbreviation = p.drv and t.lap_number = p.lap) hi
                  from pair_sides p)
            group by all having max(lo) <= min(hi)
        """,
    }
)


def _mentioned(text: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", text))
    return [name for name in CTES if name in words]


def sql(body: str) -> str:
    """``body`` with all the tables it needs in front of it."""
    needed: set[str] = set()
    todo = _mentioned(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [n for n in _mentioned(CTES[name]) if n != name]
    ctes = [f"{name} as ({text})" for name, text in CTES.items() if name in needed]
    return (f"with {', '.join(ctes)} " if ctes else "") + f"select * from ({body})"
