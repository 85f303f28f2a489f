"""Every registered query: how Spark builds it, and the same in SQL.

``floats`` and ``texts`` name the floating-point and the date/time columns;
both engines round the former to 8 digits and print the latter, so that a
comparison by value is fair.  ``ints`` are 32-bit in Spark and 64-bit in DuckDB.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge import functions as fn
from lapforge.operators import quality
from lapforge.operators.profile import Profile
from lapforge.operators.ranking import with_order
from lapforge.operators.losses import loss_report
from lapforge.operators.quantiles import spread_percentiles
from lapforge.plans import dashboards, marts, pace, results, staging, telemetry
from lapforge.session import shared_folder
from lapforge.sources import bronze, catalog, pages, sinks
from testbed import oracle, streams
from testbed.bindings import Tables

DIGITS = 8
#: Added before rounding, so that a value that is exactly half a unit does not depend on the
#: last bit; adding zero afterwards turns a negative zero into zero.
OFF_TIE = 3e-10
RACE = ["season", "round"]


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None = None
    floats: str = ""
    texts: str = ""
    ints: str = ""
    digits: int = DIGITS
    #: Units per whole in which values of moderate size are compared instead, by a floor: millions of rows are rounded faster.
    quick: int = 0

    def frame(self, t: Tables) -> DataFrame:
        df = self.build(t)
        fixed = {}
        for field in df.schema.fields:
            if isinstance(field.dataType, T.DoubleType) and self.quick:
                fixed[field.name] = F.floor((F.col(field.name) + F.lit(OFF_TIE)) * F.lit(float(self.quick)) + F.lit(0.5)) / F.lit(float(self.quick))
            elif isinstance(field.dataType, T.DoubleType):
                fixed[field.name] = F.round(F.col(field.name) + F.lit(OFF_TIE), self.digits) + F.lit(0.0)
            elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                fixed[field.name] = F.col(field.name).cast("string")
        return df.withColumns(fixed) if fixed else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if self.quick:
            fixed = [f"floor(({c} + {OFF_TIE}) * {self.quick}e0 + 0.5e0) / {self.quick}e0 as {c}" for c in self.floats.split()]
        else:
            fixed = [f"round({c} + {OFF_TIE}, {self.digits}) + 0e0 as {c}" for c in self.floats.split()]
        fixed += [f"cast({c} as varchar) as {c}" for c in self.texts.split()]
        fixed += [f"cast({c} as int) as {c}" for c in self.ints.split()]
        if not fixed:
            return oracle.sql(self.sql)
        return oracle.sql(f"select * replace ({', '.join(fixed)}) from ({self.sql})")


QUERIES: dict[str, Query] = {}

LOADED = "replace(replace(ingested_at, 'T', ' '), '+00:00', '') as ingested_at"

# --- cleaning ---------------------------------------------------------------------------------
_SILVER_FLOATS = {
    "laps": "time_seconds lap_time_seconds pit_out_time_seconds pit_in_time_seconds sector1_time_seconds "
    "sector2_time_seconds sector3_time_seconds sector1_session_time_seconds sector2_session_time_seconds "
    "sector3_session_time_seconds lap_start_time_seconds speed_i1 speed_i2 speed_fl speed_st",
    "results": "points time_seconds",
    "telemetry": "distance_to_driver_ahead rpm speed throttle distance relative_distance x y z "
    "session_time_seconds lap_time_seconds",
    "weather": "air_temp humidity pressure track_temp wind_speed time_seconds",
    "race_results": "points",
    "driver_standings": "points",
    "constructor_standings": "points",
    "pit_stops": "pit_stop_duration",
    "race_schedule": "",
}
_SILVER_TEXTS = {
    "laps": "lap_start_date",
    "telemetry": "date",
    "race_results": "date",
    "driver_standings": "driver_dob",
    "pit_stops": "date",
    "race_schedule": "race_datetime fp1_datetime fp2_datetime fp3_datetime sprint_qualy_datetime qualy_datetime",
}
for _name, _floats in _SILVER_FLOATS.items():
    QUERIES[f"clean_{_name}"] = Query(
        lambda t, n=_name: t.cleaned(n),
        f"select * replace ({LOADED}) from silver_{_name}",
        _floats,
        _SILVER_TEXTS.get(_name, ""),
    )

# --- staging ----------------------------------------------------------------------------------
_STAGED_SQL = {
    "laps": "select season, round, abbreviation, driver_number, team, lap_number, stint, lap_time_seconds, "
    "sector1_time_seconds, sector2_time_seconds, sector3_time_seconds, time_seconds as session_elapsed_seconds, "
    "lap_start_time_seconds, pit_out_time_seconds, pit_in_time_seconds, sector1_session_time_seconds, "
    "sector2_session_time_seconds, sector3_session_time_seconds, speed_i1, speed_i2, speed_fl, speed_st, compound, "
    "tyre_life, fresh_tyre, is_personal_best, is_accurate, fast_f1_generated, track_status, position from silver_laps",
    "results": "select season, round, driver_id, driver_number, broadcast_name, abbreviation, first_name, last_name, "
    "full_name, team_id, team_name, team_color, grid_position, position as finish_position, classified_position, laps, "
    "status, points, time_seconds as race_time_seconds from silver_results",
    "telemetry": "select season, round, abbreviation, team, lap_number, date as telemetry_timestamp, "
    "session_time_seconds as session_elapsed_seconds, lap_time_seconds, rpm, speed, n_gear, throttle, brake, drs, "
    "distance, relative_distance, x, y, z, driver_ahead, distance_to_driver_ahead, status as track_status "
    "from silver_telemetry",
    "weather": "select season, round, time_seconds as session_elapsed_seconds, air_temp, track_temp, humidity, pressure, "
    "rainfall, wind_direction, wind_speed from silver_weather",
    "constructor_standings": "select season, round, constructor_id, constructor, constructor_country, "
    "position as championship_position, points as championship_points, wins from silver_constructor_standings",
    "driver_standings": "select season, round, driver_id, abbreviation, driver_name, driver_dob, driver_country, "
    "constructor, constructor_country, position as championship_position, points as championship_points, wins "
    "from silver_driver_standings",
    "pit_stops": "select season, round, driver_id, race_name, circuit, date as race_date, stop_num as pit_stop_number, "
    "lap_pitted, pit_in_time, pit_stop_duration as pit_stop_duration_seconds from silver_pit_stops",
    "race_results": "select season, round, driver_id, abbreviation, driver_name, constructor, race_name, circuit, "
    "date as race_date, grid as grid_position, position as finish_position, points, status, fastest_lap_rank "
    "from silver_race_results",
    "race_schedule": "select season, round, race_name, circuit, race_datetime, fp1_datetime, fp2_datetime, fp3_datetime, "
    "sprint_qualy_datetime, qualy_datetime, sprint_qualy_datetime is not null as is_sprint_weekend "
    "from silver_race_schedule",
}
_STAGED_FLOATS = {
    "laps": _SILVER_FLOATS["laps"].replace("time_seconds ", "session_elapsed_seconds ", 1),
    "results": "points race_time_seconds",
    "telemetry": _SILVER_FLOATS["telemetry"].replace("session_time_seconds", "session_elapsed_seconds"),
    "weather": _SILVER_FLOATS["weather"].replace("time_seconds", "session_elapsed_seconds"),
    "constructor_standings": "championship_points",
    "driver_standings": "championship_points",
    "pit_stops": "pit_stop_duration_seconds",
    "race_results": "points",
    "race_schedule": "",
}
_STAGED_TEXTS = {
    "telemetry": "telemetry_timestamp",
    "driver_standings": "driver_dob",
    "pit_stops": "race_date",
    "race_results": "race_date",
    "race_schedule": _SILVER_TEXTS["race_schedule"],
}
for _name, _sql in _STAGED_SQL.items():
    QUERIES[f"staging_{_name}"] = Query(
        lambda t, n=_name: t.staged(n), _sql, _STAGED_FLOATS[_name], _STAGED_TEXTS.get(_name, "")
    )

# --- marts ------------------------------------------------------------------------------------
QUERIES["mart_race_results"] = Query(
    lambda t: t.mart("race_results"), "select * from mart_race_results", "race_time_seconds points", "race_date"
)
QUERIES["mart_driver_standings"] = Query(
    lambda t: t.mart("driver_standings"),
    "select * from mart_driver_standings",
    "championship_points points_this_round",
    "driver_dob",
)
QUERIES["mart_constructor_standings"] = Query(
    lambda t: t.mart("constructor_standings"),
    "select * from mart_constructor_standings",
    "championship_points points_this_round",
)
_LAP_FLOATS = (
    "lap_time_seconds sector1_time_seconds sector2_time_seconds sector3_time_seconds speed_i1 speed_i2 "
    "speed_fl speed_st pit_out_time_seconds pit_in_time_seconds"
)
QUERIES["mart_lap_times"] = Query(lambda t: t.mart("lap_times"), "select * from mart_lap_times", _LAP_FLOATS)
QUERIES["mart_pit_stops"] = Query(
    lambda t: t.mart("pit_stops"),
    "select * from mart_pit_stops",
    "pit_stop_duration_seconds pit_lap_time_seconds",
    "race_date",
)
QUERIES["mart_tyre_strategy"] = Query(
    lambda t: t.mart("tyre_strategy"),
    "select * from mart_tyre_strategy",
    "avg_lap_time_seconds fastest_lap_seconds degradation_rate_seconds_per_lap",
)
QUERIES["mart_telemetry_stints"] = Query(
    lambda t: t.mart("telemetry_stints"),
    "select * from mart_telemetry_stints",
    "avg_speed max_speed min_speed_on_throttle avg_throttle full_throttle_pct brake_pct drs_open_pct avg_gear "
    "max_distance_metres",
)
QUERIES["mart_weather"] = Query(
    lambda t: t.mart("weather"),
    "select * from mart_weather",
    "session_elapsed_seconds air_temp track_temp track_air_temp_delta humidity pressure wind_speed",
    "race_datetime",
)

# --- results and standings --------------------------------------------------------------------
QUERIES["loaded_rounds"] = Query(
    lambda t: results.loaded_rounds(t.gold("race_results")), "select distinct season, round from mart_race_results"
)
QUERIES["latest_standings"] = Query(
    lambda t: results.latest_standings(t.gold("driver_standings"), t.gold("race_results")),
    "select season, abbreviation, constructor, championship_points, championship_position, wins "
    "from mart_driver_standings join last_round using (season, round)",
    "championship_points",
)
QUERIES["points_progression"] = Query(
    lambda t: results.points_progression(t.gold("driver_standings")),
    "select season, round, abbreviation, constructor, championship_points from mart_driver_standings "
    "where season in (select season from mart_driver_standings group by season having count(distinct round) >= 2)",
    "championship_points",
)
QUERIES["racecraft"] = Query(
    lambda t: results.racecraft(t.gold("race_results"), None),
    "select season, abbreviation, constructor, count(*) as races, "
    "cast(sum(grid_position - finish_position) as bigint) as total_positions_gained, "
    "avg(finish_position) as avg_finish, avg(grid_position) as avg_grid from mart_race_results "
    "where grid_position is not null and finish_position is not null group by season, abbreviation, constructor",
    "avg_finish avg_grid",
)
QUERIES["grid_vs_finish"] = Query(
    lambda t: results.grid_vs_finish(t.gold("race_results")),
    "select season, round, abbreviation, constructor, grid_position, finish_position, "
    "grid_position - finish_position as positions_gained from mart_race_results "
    "where grid_position is not null and finish_position is not null",
)
QUERIES["head_to_head"] = Query(
    lambda t: results.head_to_head(t.gold("race_results")),
    "select season, constructor, driver_a, driver_b, winner, count(*) as rounds_ahead from ("
    "select a.season, a.constructor, a.abbreviation as driver_a, b.abbreviation as driver_b, "
    "case when a.finish_position < b.finish_position then a.abbreviation else b.abbreviation end as winner "
    "from mart_race_results a join mart_race_results b on a.season = b.season and a.round = b.round "
    "and a.constructor = b.constructor and a.abbreviation < b.abbreviation "
    "where a.finish_position is not null and b.finish_position is not null) group by all",
)
QUERIES["scorecard"] = Query(
    lambda t: results.scorecard(t.gold("race_results"), t.gold("driver_standings"), t.gold("lap_times"), None),
    """
    with race_summary as (
      select season, abbreviation, constructor, count(*) as races,
        cast(sum(case when finish_position = 1 then 1 else 0 end) as bigint) as wins,
        cast(sum(case when finish_position <= 3 then 1 else 0 end) as bigint) as podiums,
        avg(finish_position) as avg_finish, avg(grid_position) as avg_grid,
        cast(sum(grid_position - finish_position) as bigint) as net_positions_gained
      from mart_race_results where finish_position is not null and grid_position is not null
      group by season, abbreviation, constructor),
    pts as (select season, abbreviation, championship_points as total_points
      from mart_driver_standings join last_round using (season, round)),
    summary as (select season, abbreviation, avg(m) as avg_median_pace_s, avg(s) as avg_consistency_s,
        avg(gap) as avg_delta_to_fastest_s
      from (select season, round, abbreviation, median(lap_time_seconds) as m, stddev(lap_time_seconds) as s,
              median(lap_time_seconds) - min(median(lap_time_seconds)) over (partition by season, round) as gap
            from racing group by season, round, abbreviation) group by season, abbreviation)
    select * from race_summary left join pts using (season, abbreviation)
      left join summary using (season, abbreviation)
    """,
    "total_points avg_finish avg_grid avg_median_pace_s avg_consistency_s avg_delta_to_fastest_s",
)

# --- pace -------------------------------------------------------------------------------------
QUERIES["pace_summary"] = Query(
    lambda t: pace.pace_summary(t.gold("lap_times"), None),
    "select * from pace",
    "median_lap_s std_lap_s delta_to_fastest_s",
)
QUERIES["pace_vs_consistency"] = Query(
    lambda t: pace.pace_vs_consistency(t.gold("lap_times"), None),
    "select season, round, abbreviation, team_id, median_lap_s, std_lap_s from pace",
    "median_lap_s std_lap_s",
)
QUERIES["lap_distribution"] = Query(
    lambda t: pace.lap_distribution(t.gold("lap_times")),
    "select season, round, abbreviation, team_id, lap_number, lap_time_seconds, "
    "median(lap_time_seconds) over (partition by season, round, abbreviation) as driver_median "
    "from racing where lap_time_seconds is not null",
    "lap_time_seconds driver_median",
)
QUERIES["lap_boxes"] = Query(
    lambda t: pace.lap_boxes(t.gold("lap_times")),
    """
    with timed as (select * from racing where lap_time_seconds is not null),
    quart as (select season, round, abbreviation, quantile_cont(lap_time_seconds, 0.25) as q1,
        quantile_cont(lap_time_seconds, 0.5) as med, quantile_cont(lap_time_seconds, 0.75) as q3
      from timed group by all),
    boxes as (select season, round, abbreviation, q1, med as median, q3,
        min(lap_time_seconds) filter (lap_time_seconds between q1 - (q3 - q1) * 1.5e0 and q3 + (q3 - q1) * 1.5e0)
          as whisker_low,
        max(lap_time_seconds) filter (lap_time_seconds between q1 - (q3 - q1) * 1.5e0 and q3 + (q3 - q1) * 1.5e0)
          as whisker_high,
        count(*) filter (not lap_time_seconds between q1 - (q3 - q1) * 1.5e0 and q3 + (q3 - q1) * 1.5e0) as outliers
      from timed join quart using (season, round, abbreviation) group by all)
    select *, row_number() over (partition by season, round order by median, abbreviation) as order_idx from boxes
    """,
    "q1 median q3 whisker_low whisker_high",
    ints="order_idx",
)
QUERIES["pace_evolution"] = Query(
    lambda t: pace.pace_evolution(t.gold("lap_times"), t.gold("race_results"), chunk_laps=16),
    """
    select l.season, l.round, l.abbreviation, l.team_id, l.lap_number, l.lap_time_seconds,
      avg(l.lap_time_seconds) over (partition by l.season, l.round, l.abbreviation order by l.lap_number
                                    rows between 2 preceding and current row) as rolling_avg
    from racing l where exists (select 1 from mart_race_results r where r.season = l.season and r.round = l.round
      and r.abbreviation = l.abbreviation and r.finish_position <= 10)
    """,
    "lap_time_seconds rolling_avg",
)
QUERIES["teammate_pace"] = Query(
    lambda t: pace.teammate_pace(t.gold("lap_times"), t.gold("race_results"), None),
    """
    with team as (select distinct season, round, abbreviation, constructor from mart_race_results),
    p as (select l.season, l.round, l.abbreviation, c.constructor, median(l.lap_time_seconds) as m
      from racing l join team c using (season, round, abbreviation)
      group by l.season, l.round, l.abbreviation, c.constructor)
    select a.season, a.round, a.constructor, a.abbreviation as driver_a, b.abbreviation as driver_b,
      concat(a.abbreviation, ' vs ', b.abbreviation) as matchup, a.m as pace_a, b.m as pace_b,
      abs(a.m - b.m) as pace_delta_s,
      case when a.m < b.m then a.abbreviation else b.abbreviation end as faster_driver
    from p a join p b on a.season = b.season and a.round = b.round and a.constructor = b.constructor
      and a.abbreviation < b.abbreviation
    """,
    "pace_a pace_b pace_delta_s",
)

# --- telemetry --------------------------------------------------------------------------------
_TEL = "silver_telemetry"
TEST_CHUNK = 9600.0  # the test laps are 28.8 km long
QUERIES["assign_lap"] = Query(
    lambda t: telemetry.assign_lap(
        t.silver("telemetry").select(
            *RACE, "driver", "relative_distance", "session_time_seconds", F.col("lap_number").alias("known_lap")
        ),
        t.shaped("lap_starts"),
        chunk_seconds=7200,
    ),
    f"""
    select e.season, e.round, e.driver, e.relative_distance, e.session_time_seconds, e.lap_number as known_lap,
      s.lap_number from {_TEL} e asof left join (select * from lap_starts where lap_start_time_seconds is not null) s
      on e.season = s.season and e.round = s.round and e.driver = s.driver
      and e.session_time_seconds >= s.lap_start_time_seconds
    where (e.season, e.round, e.driver) in (
      select (season, round, driver) from lap_starts where lap_start_time_seconds is not null)
    """,
    "relative_distance session_time_seconds",
)
QUERIES["driver_inventory"] = Query(
    lambda t: telemetry.driver_inventory(t.staged("telemetry")),
    f"select season, round, abbreviation, team, count(*) as rows from {_TEL} group by all",
)
QUERIES["best_lap"] = Query(
    lambda t: telemetry.best_lap(t.staged("telemetry")),
    f"""
    select season, round, abbreviation, lap_number, lap_time from (
      select *, row_number() over (partition by season, round, abbreviation order by lap_time, lap_number) rn from (
        select season, round, abbreviation, lap_number, min(lap_time_seconds) lap_time from {_TEL}
        where lap_time_seconds > 0 and lap_number is not null group by all)) where rn = 1
    """,
    "lap_time",
)
QUERIES["fastest_lap"] = Query(
    lambda t: telemetry.fastest_lap(t.gold("lap_times")),
    """
    select season, round, abbreviation, lap_number, lap_time_seconds as lap_time from (
      select *, row_number() over (partition by season, round, abbreviation
                                   order by lap_time_seconds, lap_number) rn
      from mart_lap_times where lap_time_seconds is not null) where rn = 1
    """,
    "lap_time",
)
QUERIES["lap_trace"] = Query(
    lambda t: telemetry.lap_trace(t.staged("telemetry"), telemetry.best_lap(t.staged("telemetry"))),
    f"""
    select season, round, abbreviation, team, lap_number, distance, speed, throttle, brake, drs, rpm, n_gear, x, y, z,
      driver_ahead, distance_to_driver_ahead, status as track_status from {_TEL} t
    where lap_number = (select arg_min(b.lap_number, b.lap_time_seconds) from {_TEL} b where b.season = t.season
      and b.round = t.round and b.abbreviation = t.abbreviation and b.lap_time_seconds = (
        select min(c.lap_time_seconds) from {_TEL} c where c.season = t.season and c.round = t.round
          and c.abbreviation = t.abbreviation and c.lap_time_seconds > 0))
    """,
    "distance speed throttle rpm x y z distance_to_driver_ahead",
)
N_GRID = 700
_PAIR = "season, round, driver_a, lap_a, driver_b, lap_b"


def _interpolated(c: str) -> str:
    """Piecewise linear value of channel ``c`` at distance g from the nearest samples around it."""
    return (
        f"case when p.d is null then q.{c} when q.d is null or p.d = g.g then p.{c} "
        f"else p.{c} + (q.{c} - p.{c}) * (g.g - p.d) / (q.d - p.d) end"
    )


_GRID_SQL = f"""
    with span as (select * from pair_span),
    grid as (select s.*, i, case when i = {N_GRID - 1} then ghi else glo + i * ((ghi - glo) / {N_GRID - 1}) end as g
             from span s, range(0, {N_GRID}) r(i)),
    tr as (select p.{_PAIR.replace(', ', ', p.')}, p.side, t.distance as d, t.date as ts, t.speed, t.throttle, t.rpm,
             cast(t.n_gear as double) as n_gear, t.distance_to_driver_ahead, t.x, t.y, t.z,
             case when t.brake then 1e0 else 0e0 end as brake, t.drs
           from pair_sides p join silver_telemetry t on t.season = p.season and t.round = p.round
             and t.abbreviation = p.drv and t.lap_number = p.lap),
    firsts as (select * from (select *, row_number() over (partition by {_PAIR}, side, d order by ts) rn from tr) where rn = 1),
    lasts as (select * from (select *, row_number() over (partition by {_PAIR}, side, d order by ts desc) rn from tr) where rn = 1),
    both_sides as (select g.*, s.side from grid g, (values ('a'), ('b')) s(side)),
    near as (select g.*, b.d as pd, a.d as qd from both_sides g
             asof left join lasts b on b.season = g.season and b.round = g.round and b.driver_a = g.driver_a and b.lap_a = g.lap_a
               and b.driver_b = g.driver_b and b.lap_b = g.lap_b and b.side = g.side and g.g >= b.d
             asof left join firsts a on a.season = g.season and a.round = g.round and a.driver_a = g.driver_a and a.lap_a = g.lap_a
               and a.driver_b = g.driver_b and a.lap_b = g.lap_b and a.side = g.side and g.g <= a.d),
    vals as (
      select g.{_PAIR.replace(', ', ', g.')}, g.side, g.i as grid_idx, g.g as distance,
        {', '.join(_interpolated(c) + ' as ' + c for c in ('speed', 'throttle', 'rpm', 'n_gear',
                                                            'distance_to_driver_ahead', 'x', 'y', 'z'))},
        ({_interpolated('brake')}) >= 0.5 as brake, coalesce(q.drs, p.drs) as drs
      from near g
      left join lasts p on {' and '.join(f'p.{k} = g.{k}' for k in [*_PAIR.split(', '), 'side'])} and p.d = g.pd
      left join firsts q on {' and '.join(f'q.{k} = g.{k}' for k in [*_PAIR.split(', '), 'side'])} and q.d = g.qd),
    timed as (select *, sum(step / greatest(speed / 3.6e0, 1e0)) over (partition by {_PAIR}, side order by grid_idx
                rows between unbounded preceding and current row) as elapsed_s from (
                select *, coalesce(distance - lag(distance) over (partition by {_PAIR}, side order by grid_idx), 0) as step
                from vals))
"""
_CHANNELS = [
    "speed", "throttle", "rpm", "n_gear", "distance_to_driver_ahead", "x", "y", "z", "brake", "drs", "elapsed_s",
]
QUERIES["compare_laps"] = Query(
    lambda t: telemetry.compare_laps(t.staged("telemetry"), t.lap_pairs, N_GRID),
    _GRID_SQL
    + f"select {_PAIR}, grid_idx, a.distance, "
    + ", ".join(f"a.{c} as {c}_a, b.{c} as {c}_b" for c in _CHANNELS)
    + ", a.speed - b.speed as speed_delta, a.elapsed_s - b.elapsed_s as time_delta "
    + f"from (select * from timed where side = 'a') a join (select * from timed where side = 'b') b using ({_PAIR}, grid_idx)",
    "distance speed_delta time_delta "
    + " ".join(f"{c}_a {c}_b" for c in _CHANNELS if c not in ("brake", "drs")),
    ints="grid_idx",
    quick=10_000,  # sums of 700 steps
)
QUERIES["delta_range"] = Query(
    lambda t: telemetry.delta_range(
        telemetry.compare_laps(t.staged("telemetry"), t.lap_pairs, N_GRID, channels=("speed",))
    ),
    _GRID_SQL
    + f"select {_PAIR}, quantile_cont(abs(a.speed - b.speed), 0.95) as abs_max from "
    + f"(select * from timed where side = 'a') a join (select * from timed where side = 'b') b using ({_PAIR}, grid_idx) "
    + "group by all",
    "abs_max",
)
QUERIES["track_segments"] = Query(
    lambda t: telemetry.track_segments(t.staged("telemetry"), chunk_metres=TEST_CHUNK),
    f"""
    with seg as (select season, round, abbreviation, lap_number, distance, x, y, lead(x) over w as next_x,
        lead(y) over w as next_y, lead(distance) over w as nd, speed as value
      from {_TEL} window w as (partition by season, round, abbreviation, lap_number order by distance, date)),
    span as (select season, round, abbreviation, lap_number, quantile_cont(speed, 0.02) as value_low,
        quantile_cont(speed, 0.98) as value_high from {_TEL} group by all)
    select seg.* exclude (nd), value_low, value_high from seg join span using (season, round, abbreviation, lap_number)
    where nd is not null
    """,
    "distance x y next_x next_y value value_low value_high",
)
QUERIES["braking_zones"] = Query(
    lambda t: telemetry.braking_zones(t.staged("telemetry")),
    f"select season, round, abbreviation, lap_number, distance, x, y from {_TEL} where brake",
    "distance x y",
)
QUERIES["gap_trace"] = Query(
    lambda t: telemetry.gap_trace(t.staged("telemetry")),
    f"select season, round, abbreviation, lap_number, distance, distance_to_driver_ahead from {_TEL} "
    "where distance_to_driver_ahead > 0 and distance_to_driver_ahead is not null",
    "distance distance_to_driver_ahead",
)
QUERIES["range_share"] = Query(
    lambda t: telemetry.range_share(t.staged("telemetry"), digits=None),
    "select season, round, abbreviation, lap_number, 1e2 * sum(case when distance_to_driver_ahead > 0 "
    "and distance_to_driver_ahead <= 1.0 then 1 else 0 end) / count(*) as pct_within_drs_range "
    f"from {_TEL} group by all",
    "pct_within_drs_range",
)
QUERIES["speed_by_gear"] = Query(
    lambda t: telemetry.speed_by_gear(t.staged("telemetry"), None),
    "select season, round, abbreviation, n_gear, avg(speed) as avg_speed, max(speed) as max_speed, count(*) as samples "
    f"from {_TEL} where n_gear > 0 and speed > 0 group by all",
    "avg_speed max_speed",
)
QUERIES["throttle_bands"] = Query(
    lambda t: telemetry.throttle_bands(t.staged("telemetry"), digits=None),
    f"""
    with wide as (select season, round, abbreviation,
        1e2 * sum(case when throttle >= 98 then 1 else 0 end) / count(*) as a,
        1e2 * sum(case when throttle >= 20 and throttle < 98 then 1 else 0 end) / count(*) as b,
        1e2 * sum(case when throttle < 20 then 1 else 0 end) / count(*) as c from {_TEL} group by all)
    select season, round, abbreviation, 'full throttle' as band, a as pct from wide
    union all select season, round, abbreviation, 'partial throttle', b from wide
    union all select season, round, abbreviation, 'lift', c from wide
    """,
    "pct",
)

# --- dashboards -------------------------------------------------------------------------------
QUERIES["get_seasons"] = Query(
    lambda t: dashboards.get_seasons(t.gold("race_results")), "select distinct season from mart_race_results"
)
QUERIES["get_rounds"] = Query(
    lambda t: dashboards.get_rounds(t.gold("race_results")), "select distinct season, round, race_name from mart_race_results"
)
QUERIES["get_race_results"] = Query(
    lambda t: dashboards.get_race_results(t.gold("race_results")),
    "select season, round, abbreviation, finish_position, team_name, team_color from mart_race_results",
)
_STRATEGY = """
    select t.season, t.round, t.abbreviation, t.compound,
      case t.compound when 'SOFT' then 'S' when 'MEDIUM' then 'M' when 'HARD' then 'H' when 'INTER' then 'I'
        when 'WET' then 'W' else coalesce(substr(t.compound, 1, 1), '?') end as label,
      t.stint_start_lap as visual_start_lap, t.stint_end_lap - t.stint_start_lap + 1 as visual_length,
      p.lap_pitted, p.pit_stop_duration_seconds
    from mart_tyre_strategy t left join mart_pit_stops p on p.season = t.season and p.round = t.round
      and p.driver_abbreviation = t.abbreviation and p.stint_ending = t.stint
"""
QUERIES["get_tyre_strategy"] = Query(
    lambda t: dashboards.get_tyre_strategy(t.gold("tyre_strategy"), t.gold("pit_stops")), _STRATEGY, "pit_stop_duration_seconds"
)
_GREEN = "select * from racing where track_status = '1' and lap_time_seconds is not null"
QUERIES["get_race_pace"] = Query(
    lambda t: dashboards.get_race_pace(t.gold("lap_times")),
    f"select season, round, abbreviation, team_color, lap_time_seconds from ({_GREEN})",
    "lap_time_seconds",
)
QUERIES["get_position_by_lap"] = Query(
    lambda t: dashboards.get_position_by_lap(t.gold("lap_times")),
    "select season, round, abbreviation, lap_number, track_position, team_color from mart_lap_times "
    "where track_position is not null",
)
QUERIES["get_weather"] = Query(
    lambda t: dashboards.get_weather(t.gold("weather")),
    "select season, round, session_elapsed_seconds, air_temp, track_temp, humidity, rainfall from mart_weather",
    "session_elapsed_seconds air_temp track_temp humidity",
)
QUERIES["get_drivers_for_round"] = Query(
    lambda t: dashboards.get_drivers_for_round(t.gold("race_results")),
    "select distinct season, round, abbreviation from mart_race_results where (season, round) in ("
    "select (season, round) from mart_race_results group by season, round having count(distinct abbreviation) >= 2)",
)


def _mates_as_drivers(t: Tables) -> DataFrame:
    return t.teammates.select(*RACE, F.explode(F.array("driver_a", "driver_b")).alias("abbreviation"))


_IN_MATES = (
    "(season, round, abbreviation) in (select (season, round, driver_a) from mates "
    "union all select (season, round, driver_b) from mates)"
)
QUERIES["get_lap_times_for_drivers"] = Query(
    lambda t: dashboards.get_lap_times_for_drivers(t.gold("lap_times"), _mates_as_drivers(t)),
    "select season, round, abbreviation, lap_number, lap_time_seconds, compound from mart_lap_times "
    f"where {_IN_MATES}",
    "lap_time_seconds",
)
QUERIES["get_sector_averages"] = Query(
    lambda t: dashboards.get_sector_averages(t.gold("lap_times"), _mates_as_drivers(t)),
    "select season, round, abbreviation, avg(sector1_time_seconds) as avg_s1, avg(sector2_time_seconds) as avg_s2, "
    f"avg(sector3_time_seconds) as avg_s3 from mart_lap_times where {_IN_MATES} group by all",
    "avg_s1 avg_s2 avg_s3",
)
QUERIES["get_telemetry_metrics"] = Query(
    lambda t: dashboards.get_telemetry_metrics(t.gold("telemetry_stints")),
    "select season, round, abbreviation, sum(full_throttle_pct * stint_laps) / sum(stint_laps) as full_throttle_pct, "
    "sum(brake_pct * stint_laps) / sum(stint_laps) as brake_pct, max(max_speed) as max_speed "
    "from mart_telemetry_stints group by all",
    "full_throttle_pct brake_pct max_speed",
)
QUERIES["get_pit_stops_for_race"] = Query(
    lambda t: dashboards.get_pit_stops_for_race(t.gold("pit_stops")),
    "select season, round, driver_abbreviation as abbreviation, lap_pitted, pit_stop_duration_seconds from mart_pit_stops",
    "pit_stop_duration_seconds",
)
QUERIES["get_tyre_degradation_all"] = Query(
    lambda t: dashboards.get_tyre_degradation_all(t.gold("lap_times")),
    "select season, round, abbreviation, team_name, stint, compound, tyre_life, lap_number, lap_time_seconds "
    "from mart_lap_times where lap_time_seconds is not null",
    "lap_time_seconds",
)
QUERIES["race_pace"] = Query(
    lambda t: dashboards.race_pace(t.gold("lap_times"), t.gold("race_results")),
    f"""
    with m as (select season, round, abbreviation, min(team_color) as team_color,
        median(lap_time_seconds) as median_lap_s from ({_GREEN}) group by season, round, abbreviation)
    select m.*, r.finish_position,
      row_number() over (partition by season, round order by r.finish_position nulls last, abbreviation) as order_idx,
      min(median_lap_s) over f - 0.5e0 * ((max(median_lap_s) over f - min(median_lap_s) over f) * 0.15e0) as axis_min,
      max(median_lap_s) over f + (max(median_lap_s) over f - min(median_lap_s) over f) * 0.15e0 as axis_max
    from m left join mart_race_results r using (season, round, abbreviation)
    window f as (partition by season, round)
    """,
    "median_lap_s axis_min axis_max",
    ints="order_idx",
)
QUERIES["pair_colours"] = Query(
    lambda t: dashboards.pair_colours(t.gold("race_results"), t.teammates),
    """
    select m.season, m.round, m.driver_a, m.driver_b, a.team_color as color_a,
      case when lower(a.team_color) = lower(b.team_color) then '#FFFFFF' else b.team_color end as color_b
    from mates m
    left join (select distinct season, round, abbreviation, team_color from mart_race_results) a
      on a.season = m.season and a.round = m.round and a.abbreviation = m.driver_a
    left join (select distinct season, round, abbreviation, team_color from mart_race_results) b
      on b.season = m.season and b.round = m.round and b.abbreviation = m.driver_b
    """,
)
QUERIES["driver_delta"] = Query(
    lambda t: dashboards.driver_delta(t.gold("lap_times"), t.teammates),
    """
    with d as (select season, round, abbreviation, median(lap_time_seconds) as m, avg(sector1_time_seconds) as s1,
        avg(sector2_time_seconds) as s2, avg(sector3_time_seconds) as s3 from mart_lap_times group by all)
    select p.season, p.round, p.driver_a, p.driver_b, a.m - b.m as median_delta_s,
      case when a.m - b.m > 0 then 'slower' else 'faster' end as a_is,
      a.s1 - b.s1 as s1_delta, a.s2 - b.s2 as s2_delta, a.s3 - b.s3 as s3_delta
    from mates p
    join d a on a.season = p.season and a.round = p.round and a.abbreviation = p.driver_a
    join d b on b.season = p.season and b.round = p.round and b.abbreviation = p.driver_b
    """,
    "median_delta_s s1_delta s2_delta s3_delta",
)
QUERIES["best_lap_card"] = Query(
    lambda t: dashboards.best_lap_card(t.gold("lap_times")),
    """
    with s as (select season, round, abbreviation, stddev(lap_time_seconds) as std_dev from mart_lap_times
               where lap_time_seconds is not null group by all),
    b as (select season, round, abbreviation, lap_time_seconds as best_time, lap_number as best_lap,
            row_number() over (partition by season, round, abbreviation order by lap_time_seconds, lap_number) as rn
          from mart_lap_times where lap_time_seconds is not null)
    select season, round, abbreviation, best_time, best_lap, std_dev
    from b join s using (season, round, abbreviation) where rn = 1
    """,
    "best_time std_dev",
)
_DELTAS = """
    deltas as (select season, round, abbreviation, team_name, stint, compound, tyre_life, lap_number, lap_time_seconds,
        lap_time_seconds - first_value(lap_time_seconds) over (partition by season, round, abbreviation, stint
          order by lap_number rows between unbounded preceding and unbounded following) as delta
      from mart_lap_times where lap_time_seconds is not null)
"""
_CURVE = (
    _DELTAS
    + """,
    curve as (select season, round, compound, tyre_life, median(delta) as median, count(delta) as count
              from deltas where compound is not null and tyre_life is not null
              group by season, round, compound, tyre_life)
"""
)
_FIT = (
    _CURVE
    + """,
    fit as (select season, round, compound, regr_slope(median, tyre_life) as slope,
        regr_intercept(median, tyre_life) as intercept, min(tyre_life) as x_min, max(tyre_life) as x_max,
        count(*) as points from curve group by season, round, compound having count(*) >= 2)
"""
)
QUERIES["degradation_deltas"] = Query(
    lambda t: dashboards.degradation_deltas(t.gold("lap_times")),
    f"with {_DELTAS} select * from deltas",
    "lap_time_seconds delta",
)
QUERIES["degradation_curve"] = Query(
    lambda t: dashboards.degradation_curve(t.gold("lap_times")), f"with {_CURVE} select * from curve", "median"
)
QUERIES["degradation_fit"] = Query(
    lambda t: dashboards.degradation_fit(dashboards.degradation_curve(t.gold("lap_times"))),
    f"with {_FIT} select * from fit",
    "slope intercept",
)
QUERIES["trend_line"] = Query(
    lambda t: dashboards.trend_line(dashboards.degradation_fit(dashboards.degradation_curve(t.gold("lap_times")))),
    f"with {_FIT} select season, round, compound, i, x_min + i * ((x_max - x_min) / 49e0) as x, "
    "intercept + slope * (x_min + i * ((x_max - x_min) / 49e0)) as y from fit, range(0, 50) r(i)",
    "x y",
    ints="i",
)
QUERIES["weather_summary"] = Query(
    lambda t: dashboards.weather_summary(t.gold("weather")),
    """
    with r as (select *, row_number() over (partition by season, round order by session_elapsed_seconds desc) as rn
               from mart_weather),
    s as (select season, round, min(air_temp) as air_min, max(air_temp) as air_max, min(track_temp) as track_min,
            max(track_temp) as track_max from mart_weather group by all)
    select season, round, air_temp, track_temp, humidity, case when rainfall then 'Wet' else 'Dry' end as surface,
      air_min, air_max, track_min, track_max from r join s using (season, round) where rn = 1
    """,
    "air_temp track_temp humidity air_min air_max track_min track_max",
)
QUERIES["display_order"] = Query(
    lambda t: dashboards.display_order(t.gold("race_results")),
    """
    with best as (select season, round, team_name, min(finish_position) as p,
        arg_min(abbreviation, (finish_position, abbreviation)) as who
      from mart_race_results where finish_position is not null group by season, round, team_name),
    listed as (select r.season, r.round, r.abbreviation, r.team_name, r.finish_position,
        row_number() over w as order_idx, lag(r.team_name) over w as before
      from mart_race_results r join best b using (season, round, team_name)
      window w as (partition by r.season, r.round order by b.p, b.who, r.team_name, r.finish_position nulls last,
                   r.abbreviation))
    select season, round, abbreviation, team_name, finish_position, order_idx,
      coalesce(before <> team_name, false) as team_boundary from listed
    """,
    ints="order_idx",
)
QUERIES["strategy_order"] = Query(
    lambda t: dashboards.strategy_order(t.gold("tyre_strategy"), t.gold("race_results")),
    """
    with extra as (select distinct s.season, s.round, s.abbreviation from mart_tyre_strategy s
        where not exists (select 1 from mart_race_results r where r.season = s.season and r.round = s.round
          and r.abbreviation = s.abbreviation and r.finish_position is not null)),
    listed as (select season, round, abbreviation, finish_position from mart_race_results
               where finish_position is not null
               union all select season, round, abbreviation, null from extra)
    select *, row_number() over (partition by season, round order by finish_position nulls first, abbreviation)
      as order_idx from listed
    """,
    ints="order_idx",
)
QUERIES["compound_order"] = Query(
    lambda t: dashboards.compound_order(t.gold("tyre_strategy")),
    """
    select season, round, compound, row_number() over (partition by season, round order by
      case compound when 'SOFT' then 0 when 'MEDIUM' then 1 when 'HARD' then 2 when 'INTER' then 3 when 'WET' then 4
        else 9 end, compound) as order_idx
    from (select distinct season, round, compound from mart_tyre_strategy where compound is not null)
    """,
    ints="order_idx",
)

# --- quality and reports ----------------------------------------------------------------------
_MART_KEYS = {
    "race_results": ["result_id", "season", "round", "driver_id", "race_name", "points"],
    "driver_standings": ["standing_id", "season", "round", "driver_id", "championship_points", "points_this_round"],
    "constructor_standings": ["standing_id", "season", "round", "constructor_id", "points_this_round"],
    "lap_times": ["lap_id", "season", "round", "abbreviation", "lap_number", "lap_time_seconds"],
    "pit_stops": ["pit_stop_id", "driver_id", "pit_stop_number", "driver_abbreviation", "compound_starting"],
    "tyre_strategy": ["tyre_stint_id", "stint", "avg_lap_time_seconds", "degradation_rate_seconds_per_lap"],
    "telemetry_stints": ["telemetry_stint_id", "stint", "driver_id"],
    "weather": ["weather_id", "air_temp", "track_temp", "race_datetime"],
}


# The columns of the staging tables that must not be empty.
_STAGED_KEYS = {
    "race_results": "season round driver_id abbreviation constructor",
    "driver_standings": "season round driver_id constructor championship_position championship_points wins",
    "constructor_standings": "season round constructor_id constructor championship_position championship_points wins",
    "pit_stops": "season round driver_id pit_stop_number lap_pitted pit_stop_duration_seconds",
    "race_schedule": "season round race_name circuit race_datetime is_sprint_weekend",
    "results": "season round driver_id team_id",
    "laps": "season round abbreviation lap_number",
    "weather": "season round session_elapsed_seconds",
    "telemetry": "season round abbreviation lap_number telemetry_timestamp",
}


def _staged_not_null(t: Tables) -> DataFrame:
    return catalog.union_all(
        [
            quality.not_null(t.staged(m), cols.split()).select(F.lit(f"staging_{m}").alias("model"), "column", "failures")
            for m, cols in _STAGED_KEYS.items()
        ]
    )


QUERIES["dq_staging_not_null"] = Query(
    _staged_not_null,
    " union all ".join(
        f"select 'staging_{m}' as model, '{c}' as \"column\", count(*) filter (where {c} is null) as failures from ({_STAGED_SQL[m]})"
        for m, cols in _STAGED_KEYS.items()
        for c in cols.split()
    ),
)


def _not_null_all(t: Tables) -> DataFrame:
    return catalog.union_all(
        [
            quality.not_null(t.gold(m), cols).select(F.lit(f"mart_{m}").alias("model"), "column", "failures")
            for m, cols in _MART_KEYS.items()
        ]
    )


_UNIQUE = {m: [cols[:1]] for m, cols in _MART_KEYS.items()}
# combinations that do repeat
_UNIQUE["lap_times"].append(["season", "round", "abbreviation", "stint"])
_UNIQUE["race_results"].append(["season", "round", "finish_position"])


def _unique_all(t: Tables) -> DataFrame:
    parts = []
    for m, checks in _UNIQUE.items():
        for cols in checks:
            value = F.concat_ws("-", *[F.col(c).cast("string") for c in cols])
            doubled = quality.unique(t.gold(m), cols)
            parts.append(doubled.select(F.lit(f"mart_{m}").alias("model"), value.alias("value"), "count"))
    return catalog.union_all(parts)


QUERIES["dq_not_null"] = Query(
    _not_null_all,
    " union all ".join(
        f"select 'mart_{m}' as model, '{c}' as \"column\", count(*) as failures from mart_{m} where {c} is null"
        for m, cols in _MART_KEYS.items()
        for c in cols
    ),
)
QUERIES["dq_unique"] = Query(
    _unique_all,
    " union all ".join(
        f"select 'mart_{m}' as model, concat_ws('-', {', '.join(cols)}) as value, count(*) as count from mart_{m} "
        f"where {' and '.join(c + ' is not null' for c in cols)} group by {', '.join(cols)} having count(*) > 1"
        for m, checks in _UNIQUE.items()
        for cols in checks
    ),
)
QUERIES["dq_pit_stop_range"] = Query(
    lambda t: quality.implausible_pit_stops(t.gold("pit_stops")),
    "select pit_stop_id, season, round, driver_id, pit_stop_number, pit_stop_duration_seconds from mart_pit_stops "
    "where pit_stop_duration_seconds < 1.5 or pit_stop_duration_seconds > 1200",
    "pit_stop_duration_seconds",
)
QUERIES["dq_degradation_outliers"] = Query(
    lambda t: quality.degradation_outliers(t.gold("tyre_strategy")),
    "select season, round, abbreviation, stint, compound, stint_length_laps, degradation_rate_seconds_per_lap "
    "from mart_tyre_strategy where degradation_rate_seconds_per_lap is not null "
    "and (degradation_rate_seconds_per_lap < -2 or degradation_rate_seconds_per_lap > 5)",
    "degradation_rate_seconds_per_lap",
)
_CHECKS = {
    "race_results": ("position", 12),
    "driver_standings": ("points", 12),
    "constructor_standings": ("points", 12),
    "race_schedule": ("race_date", 12),
}
QUERIES["dq_expected_rounds"] = Query(
    lambda t: quality.expected_rounds(
        {n: (t.raw(n), key) for n, (key, _) in _CHECKS.items()}, {n: rounds for n, (_, rounds) in _CHECKS.items()}
    ),
    " union all ".join(
        f"select '{n}' as \"table\", season, count(*) as rows, count(distinct round) as rounds, "
        f"count(*) - count({key}) as key_nulls, count(distinct round) = {rounds} and count({key}) = count(*) as passed "
        f"from raw_{n} group by season"
        for n, (key, rounds) in _CHECKS.items()
    ),
)
_PROFILED = ["driver_ahead", "distance_to_driver_ahead", "x", "drs", "track_status"]
QUERIES["dq_null_profile"] = Query(
    lambda t: quality.profile_nulls(t.staged("telemetry"), _PROFILED, ["distance_to_driver_ahead"]),
    " union all ".join(
        f"select '{c}' as \"column\", count(*) as rows, count(*) filter ({'status' if c == 'track_status' else c} is null"
        f"{' or distance_to_driver_ahead = 0' if c == 'distance_to_driver_ahead' else ''}) as missing "
        "from silver_telemetry"
        for c in _PROFILED
    ),
)
QUERIES["dq_lap_sanity"] = Query(
    lambda t: quality.lap_sanity(t.staged("laps")),
    "select season, round, count(*) as total_laps, count(distinct abbreviation) as drivers, "
    "min(lap_time_seconds) as fastest_lap, max(lap_time_seconds) as slowest_lap from silver_laps "
    "where is_accurate = true group by all",
    "fastest_lap slowest_lap",
)
QUERIES["dq_telemetry_sanity"] = Query(
    lambda t: quality.telemetry_sanity(t.staged("telemetry")),
    "select season, round, count(*) as total_rows, count(distinct abbreviation) as drivers, "
    "count(distinct lap_number) as laps, count(*) filter (speed is null and throttle is null and distance is null) "
    "as empty_rows from silver_telemetry group by all",
)
_TABLES = list(_SILVER_FLOATS)
QUERIES["load_report"] = Query(
    lambda t: catalog.load_report({n: t.silver(n) for n in _TABLES}),
    " union all ".join(
        f"select '{n}' as \"table\", count(*) as rows, count(distinct round) as rounds, "
        f"count(distinct season) as seasons from silver_{n}"
        for n in _TABLES
    ),
)
QUERIES["drop_report"] = Query(
    lambda t: catalog.union_all([quality.drop_report(n, t.raw(n), t.silver(n)) for n in _TABLES]),
    "select *, bronze - silver as dropped, (bronze - silver) * 1e2 / bronze as dropped_pct, "
    "(bronze - silver) * 1e2 / bronze > 10 as alarm from ("
    + " union all ".join(
        f"select '{n}' as \"table\", (select count(*) from raw_{n}) as bronze, "
        f"(select count(*) from silver_{n}) as silver"
        for n in _TABLES
    )
    + ")",
    "dropped_pct",
)



def _losses(t: Tables) -> DataFrame:
    for name in _TABLES:
        t.silver(name)
    return loss_report(t.spark, [t.losses[name] for name in _TABLES])


def _loss_sql() -> str:
    """Every count of the report from the raw and the cleaned rows."""
    whole = "{0} is not null and ({0} <> floor({0}))"
    number = oracle._number
    unreadable = {
        "laps": {c: whole.format(c) for c in ("lap_number", "stint", "tyre_life", "position")} | {"lap_start_date": "false"},
        "results": {c: whole.format(c) for c in ("position", "grid_position", "laps")},
        "telemetry": {"date": "false"},
        "weather": {"time": "false"},
        "pit_stops": {
            "lap_pitted": "false", "stop_num": "false",
            "pit_in_time": "cast(split_part(pit_in_time, ':', 1) as int) >= 24",
            "pit_stop_duration": "not contains(pit_stop_duration, ':') and "
            f"({number('pit_stop_duration')}) is null and pit_stop_duration is not null",
        },
        "race_schedule": {
            f"{s}_datetime": f"{d} is not null and {h} is not null and {oracle._stamp(d, h)} is null"
            for s, (d, h) in {"race": ("race_date", "race_start_time")}.items() | {
                s: (f"{s}_date", f"{s}_time") for s in ("fp1", "fp2", "fp3", "sprint_qualy", "qualy")
            }.items()
        },
    }
    missing = {"telemetry": ("distance", "distance is null"), "pit_stops": ("pit_stop_duration", unreadable["pit_stops"]["pit_stop_duration"])}
    parts = []
    for n in _TABLES:
        rows = f"(select count(*) from raw_{n})"
        found = [("rows_in", "", rows), ("rows_out", "", f"(select count(*) from silver_{n})")]
        found += [("unreadable", c, f"(select count(*) from raw_{n} where {hit})") for c, hit in unreadable.get(n, {}).items()]
        dropped = "0"
        if n in missing:
            column, hit = missing[n]
            dropped = f"(select count(*) from raw_{n} where {hit})"
            found.append(("missing", column, dropped))
        found.append(("duplicate", "", f"{rows} - {dropped} - (select count(*) from silver_{n})"))
        if n == "weather":
            found += [("unfilled", c, f"(select count(*) from silver_weather where {c} is null)") for c in ("air_temp", "track_temp")]
        parts += [f"select '{n}' as \"table\", '{k}' as cause, '{c}' as \"column\", {v} as rows, ({v}) / cast({rows} as double) as share" for k, c, v in found]
    return " union all ".join(parts)


QUERIES["loss_report"] = Query(_losses, _loss_sql(), "share")

# --- nested pages -----------------------------------------------------------------------------
PAGE_ROWS = 5  # drivers per page, with at most three raw rows each; a race spans several pages


def _paged(t: Tables, raw: str, keys: list[str], item: F.Column, outer, table: str, group: str) -> DataFrame:
    """Raw rows as JSON text, a few rows to a page, the way an API delivers them."""
    number = F.floor(F.regexp_extract("driver_id", r"(\d+)", 1).cast("int") / PAGE_ROWS)
    rows = t.raw(raw).groupBy(*keys, number.alias("page_no")).agg(F.collect_list(item).alias("items"))
    page = F.struct(
        F.struct(
            F.lit("100").alias("limit"), F.struct(F.array(outer).alias(group)).alias(table)
        ).alias("MRData")
    )
    return rows.select(F.to_json(page).alias("page"))


def _result_pages(t: Tables) -> DataFrame:
    item = F.struct(
        F.col("grid").cast("string").alias("grid"),
        F.coalesce(F.col("position").cast("string"), F.lit("R")).alias("position"),
        F.col("points").cast("string").alias("points"),
        F.coalesce("status", F.lit("?")).alias("status"),
        F.struct(
            F.col("driver_id").alias("driverId"),
            F.col("driver_code").alias("code"),
            F.lit("Given").alias("givenName"),
            F.coalesce("driver_name", F.lit("Family")).alias("familyName"),
        ).alias("Driver"),
        F.struct(F.col("constructor").alias("name")).alias("Constructor"),
        F.when(
            F.col("fastest_lap_rank").isNotNull(),
            F.struct(F.col("fastest_lap_rank").cast("int").cast("string").alias("rank")),
        ).alias("FastestLap"),
    )
    race = F.struct(
        F.col("season").cast("string").alias("season"),
        F.col("round").cast("string").alias("round"),
        F.col("race_name").alias("raceName"),
        F.col("date").alias("date"),
        F.struct(F.col("circuit").alias("circuitName")).alias("Circuit"),
        F.col("items").alias("Results"),
    )
    return _paged(t, "race_results", [*RACE, "race_name", "circuit", "date"], item, race, "RaceTable", "Races")


def _stop_pages(t: Tables) -> DataFrame:
    item = F.struct(
        F.col("driver_id").alias("driverId"),
        F.col("lap_pitted").alias("lap"),
        F.col("stop_num").alias("stop"),
        F.col("pit_in_time").alias("time"),
        F.col("pit_stop_duration").alias("duration"),
    )
    race = F.struct(
        F.col("season").cast("string").alias("season"),
        F.col("round").cast("string").alias("round"),
        F.col("race_name").alias("raceName"),
        F.col("date").alias("date"),
        F.struct(F.col("circuit").alias("circuitName")).alias("Circuit"),
        F.col("items").alias("PitStops"),
    )
    # a page holds the stops of one driver in one race, which are few
    page = F.struct(F.struct(F.struct(F.array(race).alias("Races")).alias("RaceTable")).alias("MRData"))
    keys = [*RACE, "race_name", "circuit", "date", "driver_id"]
    return t.raw("pit_stops").groupBy(*keys).agg(F.collect_list(item).alias("items")).select(F.to_json(page).alias("page"))


def _schedule_pages(t: Tables) -> DataFrame:
    def session(short: str, name: str):
        day = F.col(f"{short}_date")
        return F.when(
            day.isNotNull(), F.struct(day.alias("date"), F.col(f"{short}_time").alias("time"))
        ).alias(name)

    race = F.struct(
        F.col("season").cast("string").alias("season"),
        F.col("round").cast("string").alias("round"),
        F.coalesce("race_name", F.lit("?")).alias("raceName"),
        F.col("race_date").alias("date"),
        F.col("race_start_time").alias("time"),
        F.struct(F.coalesce("circuit", F.lit("?")).alias("circuitName")).alias("Circuit"),
        session("fp1", "FirstPractice"),
        session("fp2", "SecondPractice"),
        session("fp3", "ThirdPractice"),
        session("sprint_qualy", "SprintQualifying"),
        session("qualy", "Qualifying"),
    )
    page = F.struct(F.struct(F.struct(F.array(race).alias("Races")).alias("RaceTable")).alias("MRData"))
    return t.raw("race_schedule").select(F.to_json(page).alias("page"))


def _driver_standing_pages(t: Tables) -> DataFrame:
    def team(suffix: str):
        return F.struct(
            F.concat("constructor", F.lit(suffix)).alias("name"),
            F.coalesce("constructor_country", F.lit("?")).alias("nationality"),
        )

    item = F.struct(
        F.when(F.col("position") > 15, F.lit("-")).otherwise(F.col("position").cast("string")).alias("position"),
        F.col("points").cast("string").alias("points"),
        F.col("wins").cast("string").alias("wins"),
        F.struct(
            F.col("driver_id").alias("driverId"),
            F.col("driver_code").alias("code"),
            F.lit("Given").alias("givenName"),
            F.coalesce("driver_name", F.lit("Family")).alias("familyName"),
            F.col("driver_dob").alias("dateOfBirth"),
            F.coalesce("driver_country", F.lit("?")).alias("nationality"),
        ).alias("Driver"),
        F.array(team(""), team(" B")).alias("Constructors"),
    )
    entry = F.struct(
        F.col("season").cast("string").alias("season"),
        F.col("round").cast("string").alias("round"),
        F.col("items").alias("DriverStandings"),
    )
    return _paged(t, "driver_standings", RACE, item, entry, "StandingsTable", "StandingsLists")


def _team_standing_pages(t: Tables) -> DataFrame:
    item = F.struct(
        F.col("position").cast("string").alias("position"),
        F.col("points").cast("string").alias("points"),
        F.col("wins").cast("string").alias("wins"),
        F.struct(
            F.col("constructor_id").alias("constructorId"),
            F.coalesce("constructor", F.lit("?")).alias("name"),
            F.coalesce("constructor_country", F.lit("?")).alias("nationality"),
        ).alias("Constructor"),
    )
    entry = F.struct(
        F.col("season").cast("string").alias("season"),
        F.col("round").cast("string").alias("round"),
        F.col("items").alias("ConstructorStandings"),
    )
    page = F.struct(
        F.struct(F.struct(F.array(entry).alias("StandingsLists")).alias("StandingsTable")).alias("MRData")
    )
    # a race has at most ten teams
    teams = t.raw("constructor_standings").groupBy(*RACE).agg(F.collect_list(item).alias("items"))
    return teams.select(F.to_json(page).alias("page"))


def _flat(endpoint: str, make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    return lambda t: pages.FLATTEN[endpoint](pages.parse_pages(make(t), endpoint))


QUERIES["flatten_race_results"] = Query(
    _flat("race_results", _result_pages),
    "select season, round, race_name, circuit, date, driver_id, driver_code, "
    "concat('Given ', coalesce(driver_name, 'Family')) as driver_name, constructor, grid, position, points, "
    "coalesce(status, '?') as status, cast(fastest_lap_rank as int) as fastest_lap_rank from raw_race_results",
    "points",
)
QUERIES["flatten_pit_stops"] = Query(
    _flat("pit_stops", _stop_pages),
    "select season, round, race_name, circuit, date, driver_id, lap_pitted, stop_num, pit_in_time, pit_stop_duration "
    "from raw_pit_stops",
)
QUERIES["flatten_race_schedule"] = Query(
    _flat("race_schedule", _schedule_pages),
    "select season, round, coalesce(race_name, '?') as race_name, coalesce(circuit, '?') as circuit, race_date, "
    "race_start_time, fp1_date, fp1_time, fp2_date, fp2_time, fp3_date, fp3_time, sprint_qualy_date, "
    "sprint_qualy_time, qualy_date, qualy_time from raw_race_schedule",
)
QUERIES["flatten_driver_standings"] = Query(
    _flat("driver_standings", _driver_standing_pages),
    "select season, round, driver_id, driver_code, concat('Given ', coalesce(driver_name, 'Family')) as driver_name, "
    "driver_dob, coalesce(driver_country, '?') as driver_country, constructor, "
    "coalesce(constructor_country, '?') as constructor_country, case when position <= 15 then position end as position, "
    "points, wins from raw_driver_standings",
    "points",
)
QUERIES["flatten_constructor_standings"] = Query(
    _flat("constructor_standings", _team_standing_pages),
    "select season, round, constructor_id, coalesce(constructor, '?') as constructor, "
    "coalesce(constructor_country, '?') as constructor_country, position, points, wins from raw_constructor_standings",
    "points",
)

# --- operators on the generated tables themselves ---------------------------------------------
QUERIES["slug_and_blank"] = Query(
    lambda t: t.source("part").select(
        "p_partkey",
        fn.slugify(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))).alias("slug"),
        fn.blank_to_null(F.when(F.col("p_size") > 25, F.lit("")).otherwise(F.col("p_type"))).alias("kind"),
        fn.digits_to_int(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit(""))).alias("brand_no"),
        fn.digits_to_int("p_brand").alias("not_a_number"),
        fn.pair_label("p_type", "p_brand").alias("label"),
        fn.surrogate_key("p_partkey", F.when(F.col("p_size") > 10, F.col("p_size"))).alias("part_id"),
    ),
    "select p_partkey, replace(lower(trim(concat('  ', upper(p_name), ' '))), ' ', '_') as slug, "
    "nullif(case when p_size > 25 then '' else p_type end, '') as kind, "
    "cast(replace(p_brand, 'Brand#', '') as int) as brand_no, cast(null as int) as not_a_number, "
    "concat(p_type, ' vs ', p_brand) as label, "
    "md5(concat(cast(p_partkey as varchar), '-', case when p_size > 10 then cast(p_size as varchar) "
    "else '_dbt_utils_surrogate_key_null_' end)) as part_id from part",
)
QUERIES["spread_percentiles"] = Query(
    lambda t: spread_percentiles(
        t.source("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", {"p02": 0.02, "p50": 0.5, "p95": 0.95}
    ),
    "select l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.02) as p02, "
    "quantile_cont(l_extendedprice, 0.5) as p50, quantile_cont(l_extendedprice, 0.95) as p95 "
    "from lineitem group by all",
    "p02 p50 p95",
)


# --- published rounding -----------------------------------------------------------------------
# The queries above leave these figures unrounded; here they come as published, rounded half up.
_ROUNDED: dict[str, tuple[Callable[[Tables], DataFrame], dict[str, int]]] = {
    "racecraft": (lambda t: results.racecraft(t.gold("race_results")), {"avg_finish": 2, "avg_grid": 2}),
    "scorecard": (
        lambda t: results.scorecard(t.gold("race_results"), t.gold("driver_standings"), t.gold("lap_times")),
        {"avg_finish": 2, "avg_grid": 2, "avg_median_pace_s": 2, "avg_consistency_s": 2, "avg_delta_to_fastest_s": 3},
    ),
    "pace_summary": (
        lambda t: pace.pace_summary(t.gold("lap_times")), {"median_lap_s": 3, "std_lap_s": 3, "delta_to_fastest_s": 3}
    ),
    "pace_vs_consistency": (
        lambda t: pace.pace_vs_consistency(t.gold("lap_times")), {"median_lap_s": 3, "std_lap_s": 3}
    ),
    "teammate_pace": (
        lambda t: pace.teammate_pace(t.gold("lap_times"), t.gold("race_results")),
        {"pace_a": 3, "pace_b": 3, "pace_delta_s": 3},
    ),
    "range_share": (lambda t: telemetry.range_share(t.staged("telemetry")), {"pct_within_drs_range": 1}),
    "speed_by_gear": (lambda t: telemetry.speed_by_gear(t.staged("telemetry")), {"avg_speed": 1, "max_speed": 1}),
    "throttle_bands": (lambda t: telemetry.throttle_bands(t.staged("telemetry")), {"pct": 1}),
    "mart_telemetry_stints": (
        lambda t: t.mart("telemetry_stints", digits=3),
        dict.fromkeys(
            "avg_speed min_speed_on_throttle avg_throttle full_throttle_pct brake_pct drs_open_pct avg_gear".split(), 3
        ),
    ),
}
for _name, (_build, _digits) in _ROUNDED.items():
    _half_up = ", ".join(f"cast(round(cast({c} as decimal(38, 10)), {d}) as double) as {c}" for c, d in _digits.items())
    _plain = QUERIES[_name]
    QUERIES[f"{_name}_rounded"] = Query(
        _build, f"select * replace ({_half_up}) from ({_plain.sql})", _plain.floats, _plain.texts, _plain.ints
    )


# --- sources and sinks: written and read back -------------------------------------------------
_WEATHER = "season, round, time, air_temp, humidity, pressure, rainfall, track_temp, wind_direction, wind_speed"


def _landed(t: Tables, name: str) -> str:
    """The landing zone of a session with one raw table, landed when first needed."""

    def land() -> str:
        root = f"{shared_folder(t.spark)}/lapforge/landing-{uuid.uuid4().hex}"
        bronze.land_raw(t.raw(name).drop("source", "ingested_at"), "B", root, name)
        return root

    return t._once(f"landed_{name}", land)


def _columns(df: DataFrame) -> DataFrame:
    return df.select(*[c.strip() for c in _WEATHER.split(",")])


def _stored(t: Tables, changed: DataFrame | None = None) -> DataFrame:
    """The silver results as a table of the catalog, some races replaced after that."""
    name = f"results_{uuid.uuid4().hex}"
    sinks.create_empty(t.spark, t.silver("results").schema.simpleString()[7:-1], name, ["season"])
    sinks.replace_races(t.silver("results"), name)
    for _ in range(2 if changed is not None else 0):  # twice, with the same result
        sinks.replace_races(changed, name)
    return t.spark.table(name).select("season", "round", "driver_id", "points", "laps")


def _refreshed(t: Tables) -> DataFrame:
    name = f"standings_{uuid.uuid4().hex}"
    for frame in (t.silver("driver_standings").limit(3), t.silver("driver_standings")):
        sinks.full_refresh(frame, name, ["season"])
    return t.spark.table(name).select("season", "round", "driver_id", "points", "wins")


QUERIES["landed_files"] = Query(
    lambda t: _columns(bronze.read_bronze(t.spark, _landed(t, "weather"), "weather")),
    f"select {_WEATHER} from raw_weather",
    "air_temp humidity pressure track_temp wind_speed",
)
QUERIES["landed_round"] = Query(
    lambda t: _columns(bronze.read_bronze(t.spark, _landed(t, "weather"), "weather", 1996, 3)),
    f"select {_WEATHER} from raw_weather where season = 1996 and round = 3",
    "air_temp humidity pressure track_temp wind_speed",
)
QUERIES["stored_table"] = Query(
    _stored, "select season, round, driver_id, points, laps from silver_results", "points"
)
QUERIES["replaced_partitions"] = Query(
    lambda t: _stored(t, t.silver("results").where("round <= 2").withColumn("points", F.col("points") + 100)),
    "select season, round, driver_id, points + case when round <= 2 then 100 else 0 end as points, laps from silver_results",
    "points",
)
QUERIES["refreshed_table"] = Query(
    _refreshed, "select season, round, driver_id, points, wins from silver_driver_standings", "points"
)
QUERIES["results_of_a_race"] = Query(
    lambda t: dashboards.for_race(t.gold("race_results"), 1995, 4).select("season", "round", "abbreviation", "points"),
    "select season, round, abbreviation, points from mart_race_results where season = 1995 and round = 4",
    "points",
)

# --- streams ----------------------------------------------------------------------------------
_DISTANT = "with_distance as (select * from raw_telemetry where distance is not null)"
QUERIES["stream_clean"] = Query(
    streams.cleaned,
    "select distinct season, round, driver, lap_number, cast(date as timestamp) as date from raw_telemetry where distance is not null",
    texts="date",
)
QUERIES["stream_windows"] = Query(
    streams.windowed,
    f"""
    with {_DISTANT}
    select time_bucket(interval '6 hours', cast(date as timestamp), timestamp '1970-01-01') as window_start, season, round,
      driver as abbreviation, count(*) as samples, avg(speed) as avg_speed, max(speed) as max_speed,
      avg(case when throttle >= 99 then 1e0 else 0e0 end) * 100 as full_throttle_pct,
      avg(case when brake then 1e0 else 0e0 end) * 100 as brake_pct,
      avg(case when drs in (10, 12, 14) then 1e0 else 0e0 end) * 100 as drs_open_pct
    from with_distance group by all
    """,
    "avg_speed max_speed full_throttle_pct brake_pct drs_open_pct",
    "window_start",
)
QUERIES["stream_merge"] = Query(
    streams.merged,
    "select season, round, driver, lap_number, date, relative_distance, speed, (select count(*) from silver_telemetry) as stored_rows, "
    "cast(0 as bigint) as pending_twice from silver_telemetry",
    "relative_distance speed",
    "date",
)
QUERIES["stream_lap_context"] = Query(
    streams.with_late_laps,
    "select t.season, t.round, t.abbreviation, t.lap_number, t.date, t.speed, l.stint, l.compound, l.tyre_life, l.fresh_tyre "
    "from silver_telemetry t left join silver_laps l on l.season = t.season and l.round = t.round "
    "and l.abbreviation = t.abbreviation and l.lap_number = t.lap_number",
    "speed",
    "date",
)


# --- order as published, catalogue, footers, profiles -------------------------------------------
QUERIES["published_scorecard"] = Query(
    lambda t: with_order(
        results.scorecard(t.gold("race_results"), t.gold("driver_standings"), t.gold("lap_times")),
        ["season", F.col("total_points").desc_nulls_last(), F.col("avg_finish").asc_nulls_last(), "abbreviation", "constructor"],
    ).select("season", "abbreviation", "constructor", "total_points", "avg_finish", "order_idx"),
    "select season, abbreviation, constructor, total_points, avg_finish, row_number() over (order by season, "
    "total_points desc nulls last, avg_finish nulls last, abbreviation, constructor) as order_idx "
    f"from ({QUERIES['scorecard_rounded'].sql})",
    "total_points avg_finish",
)
QUERIES["published_results"] = Query(
    lambda t: with_order(
        dashboards.get_race_results(t.gold("race_results")),
        ["season", "round", F.col("finish_position").asc_nulls_last(), "abbreviation"],
    ),
    f"select *, row_number() over (order by season, round, finish_position nulls last, abbreviation) as order_idx from ({QUERIES['get_race_results'].sql})",
)
QUERIES["preview_laps"] = Query(
    lambda t: catalog.preview(t.staged("laps"), ["season", "round", "abbreviation", "lap_number"], 25).select(
        "season", "round", "abbreviation", "lap_number", "compound", "lap_time_seconds"
    ),
    "select season, round, abbreviation, lap_number, compound, lap_time_seconds from silver_laps "
    "order by season, round, abbreviation, lap_number limit 25",
    "lap_time_seconds",
)
QUERIES["round_counts"] = Query(
    lambda t: catalog.footer_counts(t.spark, f"{_landed(t, 'weather')}/weather"),
    "select season, round, count(*) as rows from raw_weather group by season, round",
)


def _page_lines(t: Tables) -> str:
    """Result pages as lines of a few files; of the pages of first rounds a torn copy landed as well."""

    def land() -> str:
        path = f"{shared_folder(t.spark)}/lapforge/pages-{uuid.uuid4().hex}"
        made = _result_pages(t)
        torn = made.where(F.contains("page", F.lit('"round":"1",'))).select(F.substring("page", 1, 60).alias("page"))
        made.unionAll(torn).coalesce(2).write.text(path)
        return path

    return t._once("landed_pages", land)


QUERIES["page_lines"] = Query(
    lambda t: pages.flatten_race_results(pages.read_page_lines(t.spark, _page_lines(t), "race_results")),
    QUERIES["flatten_race_results"].sql,
    "points",
)
_PAGE_SQL = "select distinct season, round, race_name, circuit, date, cast(regexp_extract(driver_id, '([0-9]+)', 1) as int) // 5 as p from raw_race_results"
QUERIES["page_report"] = Query(
    lambda t: pages.page_report(pages.read_page_lines(t.spark, _page_lines(t), "race_results"), "race_results"),
    f"select 'race_results' as endpoint, count(*) + count(*) filter (round = 1) as pages, count(*) filter (round = 1) as bad_pages from ({_PAGE_SQL})",
)


def _profiled(t: Tables) -> DataFrame:
    """A profile of half the seasons, then of all: the second run reads the new ones only."""
    df = t.silver("telemetry")
    profile = Profile(t.spark, f"{shared_folder(t.spark)}/lapforge/profile-{uuid.uuid4().hex}", ["driver", "driver_ahead", "status"])
    profile.update(df.where("season % 2 = 0"))
    profile.update(df)
    return profile.report(RACE)


QUERIES["incremental_profile"] = Query(
    _profiled,
    " union all ".join(
        f"select season, round, '{c}' as \"column\", count(*) as rows, count(*) - count({c}) as nulls, count(distinct {c}) as distinct_values "
        "from silver_telemetry group by season, round"
        for c in ("driver", "driver_ahead", "status")
    ),
)
def bucketed(t: Tables, name: str) -> DataFrame:
    """A silver table stored by lap, as telemetry and laps are joined by it; its rows move once, while they are narrow."""

    def store() -> DataFrame:
        table = f"bucketed_{name}_{uuid.uuid4().hex}"
        keys, path = [*RACE, "abbreviation", "lap_number"], f"{shared_folder(t.spark)}/lapforge/{table}"
        sinks.store_bucketed(t.cleaned(name, by_lap=True), table, keys, t.buckets, path)
        return t.spark.table(table)

    return t._once(f"bucketed_{name}", store)


QUERIES["stints_from_buckets"] = Query(
    lambda t: marts.mart_telemetry_stints(
        staging.staged(bucketed(t, "telemetry"), "telemetry"), staging.staged(bucketed(t, "laps"), "laps"), t.staged("results"), digits=None
    ),
    QUERIES["mart_telemetry_stints"].sql,
    QUERIES["mart_telemetry_stints"].floats,
)
QUERIES["catalog_columns"] = Query(
    lambda t: catalog.list_columns(t.source("lineitem")).select("position", "column_name"),
    "select cast(ordinal_position as int) as position, column_name from information_schema.columns where table_name = 'lineitem'",
)
_WANTED_COLUMNS = ["l_orderkey", "l_lap", "l_tax", "l_driver"]
QUERIES["dq_required_columns"] = Query(
    lambda t: t.spark.createDataFrame(
        [("lineitem", c) for c in quality.missing_columns(t.source("lineitem"), _WANTED_COLUMNS)], "table string, column string"
    ),
    "select 'lineitem' as \"table\", c as \"column\" from (values " + ", ".join(f"('{c}')" for c in _WANTED_COLUMNS) + ") v(c) "
    "where c not in (select column_name from information_schema.columns where table_name = 'lineitem')",
)
QUERIES["session_columns"] = Query(
    lambda t: bronze.move_last(
        bronze.with_lineage(
            bronze.with_keys(fn.snake_case_columns(t.source("nation").toDF("NationKey", "Name", "DRS2Region")), 2031, 7), "B"
        ).withColumn("ingested_at", F.col("ingested_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$")),
        "nation_key",
    ),
    "select n_name as name, n_regionkey as drs2_region, 2031 as season, 7 as round, 'B' as source, "
    "true as ingested_at, n_nationkey as nation_key from nation",
)


def _as_view(t: Tables) -> DataFrame:
    staging.staged_view(t.silver("laps"), "laps")
    return t.spark.sql("select season, round, abbreviation, count(*) as laps, max(stint) as stints from stg_laps group by all")


QUERIES["staged_view"] = Query(
    _as_view, "select season, round, abbreviation, count(*) as laps, max(stint) as stints from silver_laps group by all"
)
