"""Race-shaped raw tables derived from the generated test tables.

The statements below run unchanged in Spark and in DuckDB.  They only shape
inputs; everything under test happens in the library.  Fields stay small at any
scale: a race has at most 20 drivers and a driver at most 53 laps per race, and
more data means more seasons (every 80 suppliers or 120 users open new ones).
Silver tables and marts are written to the session's shared folder when first
needed, as in the layered store they stand for, and later queries read them; as many files as tasks, whatever the seasons.
Since a race is that small, rows are dealt out by race while they are narrow; cleaning and the marts then work in place.
Table names are written in braces, which Spark binds to DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.functions import whole_number
from lapforge.operators.losses import Losses
from lapforge.plans import marts, telemetry
from lapforge.plans.silver import CLEANERS
from lapforge.plans.staging import staged
from lapforge.session import written, written_by

STATEMENTS = {
    "lines": """
        select cast(year(l_shipdate) + 10 * floor(l_suppkey / 80) as int) as season,
               cast(year(l_shipdate) as int) as cal_year,
               cast(month(l_shipdate) as int) as round,
               cast(floor(l_suppkey / 4) % 20 as int) as dn,
               cast(1 + (l_orderkey * 7 + l_linenumber * 3 + l_partkey) % 53 as bigint) as lap,
               cast(round(l_extendedprice * 100) as bigint) as cents,
               concat(cast(cast(l_shipdate as date) as string), 'T06:00:00+00:00') as ingested_at,
               l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
        from {lineitem}
    """,
    "entries": """
        select season, cal_year, round, dn, l_returnflag as flag, count(*) as n,
               max(cents) as top_cents, min(cents) as low_cents
        from {lines}
        group by season, cal_year, round, dn, l_returnflag
    """,
    "raw_laps": """
        select l_orderkey * 1000 as time,
               concat('D', cast(dn as string)) as driver,
               cast(dn as string) as driver_number,
               case when l_discount = 0 then null else 60000000000 + (cents % 60000) * 1000000 end as lap_time,
               cast(lap as double) as lap_number,
               cast(1 + floor((lap - 1) / 12) as double) as stint,
               case when (lap - 1) % 12 = 0 and lap > 1 then lap * 90000000000 end as pit_out_time,
               case when lap % 12 = 0 then lap * 90000000000 + 85000000000 end as pit_in_time,
               20000000000 + (cents % 7000) * 1000000 as sector1_time,
               20000000000 + (cents % 11000) * 1000000 as sector2_time,
               case when l_linenumber = 7 then null else 20000000000 + (cents % 13000) * 1000000 end as sector3_time,
               l_suppkey * 1000000000 as sector1_session_time,
               cast(l_linenumber as bigint) * 1000000000 as sector2_session_time,
               cast(null as bigint) as sector3_session_time,
               cast(l_partkey as double) as speed_i1,
               l_extendedprice as speed_i2,
               l_quantity as speed_fl,
               l_tax as speed_st,
               l_linenumber = 1 as is_personal_best,
               case cast(floor((lap - 1) / 12) + dn as bigint) % 4
                    when 0 then 'SOFT' when 1 then 'MEDIUM' when 2 then 'HARD' end as compound,
               cast(1 + (lap - 1) % 12 as double) as tyre_life,
               cast(floor((lap - 1) / 12) as bigint) % 2 = 0 as fresh_tyre,
               concat('  Team ', cast(cast(floor(dn / 2) as bigint) as string), ' ') as team,
               lap * 90000000000 as lap_start_time,
               l_shipdate as lap_start_date,
               case l_returnflag when 'N' then '1' when 'A' then '2' else '' end as track_status,
               cast(l_linenumber + dn as double) as position,
               case when l_linestatus = 'F' then false end as deleted,
               case when l_linestatus = 'F' then '' else 'track limits' end as deleted_reason,
               false as fast_f1_generated,
               l_linestatus = 'O' as is_accurate,
               season, round, 'B' as source, ingested_at
        from {lines}
    """,
    "raw_results": """
        select cast(dn as string) as driver_number,
               concat('D ', cast(dn as string)) as broadcast_name,
               concat('D', cast(dn as string)) as abbreviation,
               concat('  Drv ', cast(dn as string), ' ') as driver_id,
               concat('Team ', cast(cast(floor(dn / 2) as bigint) as string)) as team_name,
               concat('00ff', lpad(cast(cast(floor(dn / 2) as bigint) as string), 2, '0')) as team_color,
               concat(' Team ', cast(cast(floor(dn / 2) as bigint) as string)) as team_id,
               case when n % 5 = 0 then null else concat('First', cast(dn as string)) end as first_name,
               case when n % 7 = 0 then null else concat('Last', cast(dn as string)) end as last_name,
               case when n % 11 = 0 then null else concat('Full ', cast(dn as string)) end as full_name,
               'https://example.org/x.png' as headshot_url, 'XX' as country_code,
               case when (dn + round) % 9 = 7 then null
                    else cast(1 + (dn * 7 + round * 5 + season) % 20 as double) end as position,
               case when (dn + round) % 9 = 7 then 'R' when n % 6 = 0 then null
                    else cast(1 + (dn * 7 + round * 5 + season) % 20 as string) end as classified_position,
               case when n % 13 = 0 then null else cast(1 + (dn * 11 + round * 3) % 20 as double) end as grid_position,
               top_cents * 1000000 as q1, low_cents * 1000000 as q2, cast(null as bigint) as q3,
               top_cents * 1000000 + 345000000 as time,
               case when n % 4 = 0 then null else 'Finished' end as status,
               cast(greatest(25 - (dn * 7 + round * 5 + season) % 20 * 2, 0) as double) as points,
               cast(n as double) as laps, season, round, 'B' as source,
               case flag when 'A' then '2024-01-01T00:00:00+00:00' when 'N' then '2024-01-02T00:00:00+00:00'
                    else '2024-01-03T00:00:00+00:00' end as ingested_at
        from {entries}
    """,
    "raw_race_results": """
        select season, round, concat('Race ', cast(round as string)) as race_name,
               concat('Circuit ', cast(round as string)) as circuit,
               concat(cast(cal_year as string), '-', lpad(cast(round as string), 2, '0'), '-01') as date,
               concat(case when (dn + round) % 10 = 9 then 'Else ' else 'Drv ' end, cast(dn as string), '  ') as driver_id,
               case when dn % 10 = 9 then null else concat('D', cast(dn as string)) end as driver_code,
               case when dn % 10 = 8 then null else concat('Driver ', cast(dn as string)) end as driver_name,
               concat('Team ', cast(cast(floor(dn / 2) as bigint) as string)) as constructor,
               cast(1 + (dn * 11 + round * 3) % 20 as int) as grid,
               case when (dn + round) % 9 = 7 then null
                    else cast(1 + (dn * 7 + round * 5 + season) % 20 as int) end as position,
               cast(greatest(26 - (dn * 7 + round * 5 + season) % 20, 0) as double) as points,
               case when n % 3 = 0 then null else '+1 Lap' end as status,
               case when n % 5 = 0 then null else cast(1 + dn as double) end as fastest_lap_rank,
               'A' as source,
               case flag when 'A' then '2024-01-01T00:00:00+00:00' when 'N' then '2024-01-02T00:00:00+00:00'
                    else '2024-01-03T00:00:00+00:00' end as ingested_at
        from {entries}
    """,
    "raw_driver_standings": """
        select season, round, concat(' Drv ', cast(dn as string)) as driver_id,
               case when dn = 19 then null else concat('D', cast(dn as string)) end as driver_code,
               case when dn % 10 = 8 then null else concat('Driver ', cast(dn as string)) end as driver_name,
               concat(cast(1980 + dn as string), '-02-15') as driver_dob,
               case when n % 3 = 0 then null else 'British' end as driver_country,
               concat('Team ', cast(cast(floor(dn / 2) as bigint) as string)) as constructor,
               case when n % 4 = 0 then null else 'German' end as constructor_country,
               cast(1 + dn as int) as position,
               cast(round * ((dn * 13) % 26) as double) + cast((season + dn) % 5 as double) / 2 as points,
               cast(round % 4 as int) as wins, 'A' as source,
               case flag when 'A' then '2024-01-01T00:00:00+00:00' when 'N' then '2024-01-02T00:00:00+00:00'
                    else '2024-01-03T00:00:00+00:00' end as ingested_at
        from {entries}
    """,
    "raw_constructor_standings": """
        select season, round, concat('Team ', cast(cast(floor(dn / 2) as bigint) as string), ' ') as constructor_id,
               case when sum(n) % 5 = 0 then null
                    else concat('Team ', cast(cast(floor(dn / 2) as bigint) as string)) end as constructor,
               case when sum(n) % 4 = 0 then null else 'German' end as constructor_country,
               cast(1 + floor(dn / 2) as int) as position,
               cast(round * (30 - floor(dn / 2)) as double) as points,
               cast(round % 3 as int) as wins, 'A' as source,
               case flag when 'A' then '2024-01-01T00:00:00+00:00' when 'N' then '2024-01-02T00:00:00+00:00'
                    else '2024-01-03T00:00:00+00:00' end as ingested_at
        from {entries}
        group by season, round, floor(dn / 2), flag
    """,
    "stops": """
        select cast(year(o_orderdate) + 10 * floor(o_custkey / 1200) as int) as season,
               cast(year(o_orderdate) as int) as cal_year,
               cast(month(o_orderdate) as int) as round,
               cast(floor(o_custkey / 60) % 20 as int) as dn,
               cast(12 + 12 * (o_orderkey % 4) as bigint) as lap,
               concat(cast(cast(o_orderdate as date) as string), 'T06:00:00+00:00') as ingested_at,
               cast(round(o_totalprice * 100) as bigint) as cents, o_orderkey, o_custkey
        from {orders}
    """,
    "raw_pit_stops": """
        select season, round, concat('Race ', cast(round as string)) as race_name,
               concat('Circuit ', cast(round as string)) as circuit,
               concat(cast(cal_year as string), '-', lpad(cast(round as string), 2, '0'), '-01') as date,
               concat(' Drv ', cast(case when cents % 7 = 5 then 99 else dn end as string)) as driver_id,
               cast(lap as string) as lap_pitted,
               cast(cast(floor(lap / 12) as bigint) as string) as stop_num,
               concat(lpad(cast(cents % 26 as string), 2, '0'), ':16:', lpad(cast(o_orderkey % 60 as string), 2, '0'))
                   as pit_in_time,
               case when cents % 11 = 0 then 'DNF'
                    when cents % 11 = 1 then '   '
                    when cents % 11 = 2 then concat('1:', cast(10 + o_orderkey % 50 as string), '.500')
                    when cents % 11 = 3 then cast(20 + o_orderkey % 20 as string)
                    when cents % 11 = 4 then concat('0.', cast(100 + cents % 900 as string))
                    when cents % 11 = 5 then concat('25:', cast(10 + o_orderkey % 50 as string), '.250')
                    else concat(' ', cast(18 + o_orderkey % 20 as string), '.', cast(100 + cents % 900 as string))
                    end as pit_stop_duration,
               'A' as source, ingested_at
        from {stops}
    """,
    "raw_race_schedule": """
        select season, round,
               case when sum(n) % 6 = 0 then null else concat('Race ', cast(round as string)) end as race_name,
               case when sum(n) % 7 = 0 then null else concat('Circuit ', cast(round as string)) end as circuit,
               concat(cast(cal_year as string), '-', lpad(cast(round as string), 2, '0'), '-08') as race_date,
               case when round = 11 then 'TBC' else '14:00:00Z' end as race_start_time,
               concat(cast(cal_year as string), '-', lpad(cast(round as string), 2, '0'), '-06') as fp1_date,
               ' 01:30:00Z' as fp1_time,
               case when round % 3 = 0 then null
                    else concat(cast(cal_year as string), '-', lpad(cast(round as string), 2, '0'), '-06') end as fp2_date,
               case when round % 3 = 0 then null else '05:00:00Z' end as fp2_time,
               case when round % 3 = 0 then null
                    else concat(cast(cal_year as string), '-', lpad(cast(round as string), 2, '0'), '-07') end as fp3_date,
               case when round % 3 = 0 then null else '01:30:00Z' end as fp3_time,
               case when round % 3 = 0
                    then concat(cast(cal_year as string), '-', lpad(cast(round as string), 2, '0'), '-06') end
                    as sprint_qualy_date,
               case when round % 3 = 0 then '03:30:00Z' end as sprint_qualy_time,
               concat(cast(cal_year as string), '-', lpad(cast(round as string), 2, '0'), '-07') as qualy_date,
               '05:00:00Z' as qualy_time, 'A' as source,
               case flag when 'A' then '2024-01-01T00:00:00+00:00' when 'N' then '2024-01-02T00:00:00+00:00'
                    else '2024-01-03T00:00:00+00:00' end as ingested_at
        from {entries}
        group by season, cal_year, round, flag
    """,
    "samples": """
        select cast(1996 + floor((day(ts) - 1) / 12) + 10 * floor(user_id / 120) as int) as season,
               cast(1 + (day(ts) - 1) % 12 as int) as round,
               cast(floor(user_id / 6) % 20 as int) as dn,
               cast(1 + floor(hour(ts) / 8) as bigint) as lap,
               cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) as bigint) as sec,
               cast(regexp_extract(props, '([0-9]+)', 1) as int) as k,
               concat(cast(cast(ts as date) as string), 'T06:00:00+00:00') as ingested_at,
               event_id, ts, event_type, value
        from {events}
    """,
    "raw_telemetry": """
        select date_trunc('minute', ts) as date,
               sec * 1000000000 + event_id % 1000 * 1000000 as session_time,
               case event_type when 'view' then '' when 'click' then null
                    else concat('D', cast((dn + 1) % 20 as string)) end as driver_ahead,
               value / 100 as distance_to_driver_ahead,
               (sec - (lap - 1) * 28800) * 1000000000 as time,
               cast(9000 + event_id % 3000 as double) as rpm,
               value as speed, cast(event_id % 9 as int) as n_gear, cast(k as double) as throttle,
               event_type = 'error' as brake, cast(event_id % 15 as int) as drs,
               case when value > 150 then null else cast(sec % 28800 as double) end as distance,
               cast(event_id as double) as relative_distance,
               case when event_type = 'signup' then '' else 'OnTrack' end as status,
               value * 2 - 100 as x, cast(event_id % 977 as double) as y, cast(k as double) / 8 as z,
               season, round, concat('D', cast(dn as string)) as driver,
               concat(' Team ', cast(cast(floor(dn / 2) as bigint) as string)) as team,
               lap as lap_number, 'B' as source, ingested_at
        from {samples}
    """,
    "lap_starts": """
        select distinct season, round, concat('D', cast(dn as string)) as driver, lap as lap_number,
               case when (lap = 1 and dn % 2 = 0) or (lap = 3 and dn % 5 = 0) or dn % 7 = 6 then null
                    else cast((lap - 1) * 28800 as double) end as lap_start_time_seconds
        from {samples}
    """,
    "raw_weather": """
        select cast(hour(ts) * 3600 + minute(ts) * 60 as bigint) * 1000000000 as time,
               case when event_type = 'error' then null else value end as air_temp,
               cast(event_id % 100 as double) as humidity, cast(event_id as double) as pressure,
               event_type = 'click' as rainfall,
               case when event_type = 'signup' then null else value + 10 end as track_temp,
               cast(event_id % 360 as int) as wind_direction, value / 10 as wind_speed,
               season, round, 'B' as source, ingested_at
        from {samples}
    """,
}

#: What "last" means for each raw table: enough columns to tell any two different rows apart.
ORDER = {
    "laps": [
        "ingested_at",
        "time_seconds",
        "sector1_session_time_seconds",
        "sector2_session_time_seconds",
        "speed_i1",
        "speed_i2",
        "speed_fl",
        "speed_st",
        "track_status",
        "is_accurate",
        "lap_time_seconds",
    ],
    "results": ["ingested_at"],
    "telemetry": ["ingested_at", "relative_distance"],
    "weather": ["ingested_at", "pressure"],
    "race_results": ["ingested_at"],
    "driver_standings": ["ingested_at"],
    "constructor_standings": ["ingested_at"],
    "pit_stops": ["ingested_at", "pit_in_time", "pit_stop_duration", "lap_pitted"],
    "race_schedule": ["ingested_at"],
}


#: Marts: job, staged inputs, options (shares stay unrounded for the comparison).
MARTS = {
    "race_results": (marts.mart_race_results, ["results", "race_results", "race_schedule"], {}),
    "driver_standings": (marts.mart_driver_standings, ["driver_standings"], {}),
    "constructor_standings": (marts.mart_constructor_standings, ["constructor_standings"], {}),
    "lap_times": (marts.mart_lap_times, ["laps", "results"], {}),
    "pit_stops": (marts.mart_pit_stops, ["pit_stops", "laps", "results"], {}),
    "tyre_strategy": (marts.mart_tyre_strategy, ["laps", "results"], {}),
    "telemetry_stints": (marts.mart_telemetry_stints, ["telemetry", "laps", "results"], {"digits": None}),
    "weather": (marts.mart_weather, ["weather", "race_schedule"], {}),
}

RACE = ["season", "round"]

#: Raw tables whose rows are dealt out by race before they are widened, and what they are made from.
DEALT = {"raw_laps": "lines", "raw_telemetry": "samples", "raw_weather": "samples"}

#: Tables kept in buckets of races.
BUCKETED = ("entries", "silver_laps", "gold_lap_times")

#: Bytes of a file that one task reads.  A generated row takes a dozen bytes there, and the cleaning jobs sort the much
#: wider rows shaped from it before their shuffle: Spark's 128 MB would be ten million of those in one task.
SPLIT = "8m"

#: Session settings: buckets of races are read as such, and serve joins whose keys begin with the race.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",  # results are compared with naive UTC timestamps
    "spark.sql.files.maxPartitionBytes": SPLIT,
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def lap_of(narrow: str) -> list[Column | str]:
    """Season, round, abbreviation and lap number that a narrow row will have once it is cleaned.

    Dealt out by these expressions, the cleaned rows lie by lap: Spark follows them into the columns they become.
    """
    lap = {"lines": whole_number(F.expr("cast(lap as double)")), "samples": F.col("lap")}
    return [*RACE, F.expr("concat('D', cast(dn as string))"), lap[narrow]]


class Tables:
    """Lazy access to the derived tables of one data folder."""

    _open: dict[tuple[str, str], Tables] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Tables:
        """The tables of a folder; their plans (not their rows) are shared by all queries of a session."""
        key = (spark.sparkContext.applicationId, folder.rstrip("/"))
        if key not in cls._open:
            cls._open[key] = cls(spark, folder)
        for name, value in SETTINGS.items():
            spark.conf.set(name, value)
        return cls._open[key]

    def __init__(self, spark: SparkSession, folder: str):
        for name, value in SETTINGS.items():
            spark.conf.set(name, value)
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}
        self.losses: dict[str, Losses] = {}

    def source(self, name: str) -> DataFrame:
        """A test table as generated."""
        return self._once(f"source_{name}", lambda: self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def _once(self, key: str, make) -> DataFrame:
        if key not in self._made:
            self._made[key] = make()
        return self._made[key]

    def shaped(self, name: str) -> DataFrame:
        """One of the statements above; the entries of the races, which five raw tables are made from, are written once."""
        if name == "entries":
            return self._table(name, lambda: self._bind(name).repartition(self.buckets, *RACE))
        return self._once(name, lambda: self._bind(name))

    def _bind(self, name: str, **dealt: DataFrame) -> DataFrame:
        text = STATEMENTS[name]
        used = {t: self.shaped(t) for t in STATEMENTS if f"{{{t}}}" in text and t not in dealt} | dealt
        used.update({t: self.source(t) for t in ("lineitem", "orders", "events") if f"{{{t}}}" in text})
        return self.spark.sql(text, **used)

    def raw(self, name: str) -> DataFrame:
        return self.shaped(f"raw_{name}")

    @cached_property
    def buckets(self) -> int:
        """Parts that races are dealt out to: as many as tasks read the largest table, so a part does not grow with it."""
        return max(8, self.source("lineitem").rdd.getNumPartitions())

    def _dealt(self, name: str, keys: Sequence[Column | str] = RACE) -> DataFrame:
        """Rows by race, or other keys; those of a race are next to each other before they move, which packs them better."""
        return self.shaped(name).sortWithinPartitions(*RACE).repartition(self.buckets, *keys)

    def cleaned(self, name: str, losses: Losses | None = None, by_lap: bool = False) -> DataFrame:
        """A cleaning job from the raw rows on; its rows lie by race, or by lap, where they are many."""
        raw = f"raw_{name}"
        narrow = DEALT.get(raw)
        rows = self._bind(raw, **{narrow: self._dealt(narrow, lap_of(narrow) if by_lap else RACE)}) if narrow else self.shaped(raw)
        return CLEANERS[name](rows, order_cols=ORDER[name], losses=losses)

    def silver(self, name: str) -> DataFrame:
        """A cleaned table, written once per session and read from there; the job that writes it counts what it loses."""

        def make() -> DataFrame:
            self.losses[name] = Losses(name)
            return self.cleaned(name, self.losses[name])

        return self._table(f"silver_{name}", make)

    def staged(self, name: str) -> DataFrame:
        return self._once(f"staged_{name}", lambda: staged(self.silver(name), name))

    def mart(self, name: str, **changed) -> DataFrame:
        """A mart job from the silver tables on."""
        build, inputs, options = MARTS[name]
        return build(*[self.staged(i) for i in inputs], **options | changed)

    def gold(self, name: str) -> DataFrame:
        """A mart, written once per session and read from there."""
        return self._table(f"gold_{name}", lambda: self.mart(name))

    def publish(self, at_once: int = 4) -> None:
        """Write all silver tables, then all marts; several jobs share the executors."""
        self.shaped("entries")
        with ThreadPoolExecutor(at_once) as jobs:
            list(jobs.map(self.silver, ORDER))
            list(jobs.map(self.gold, MARTS))

    def _table(self, key: str, make) -> DataFrame:
        # no folder per season: seasons grow with the data, and each would cost a file of every table
        name = f"{self.folder.strip('/').replace('/', '_')}/{key}"
        if key in BUCKETED:
            return self._once(key, lambda: written_by(make(), name, RACE, self.buckets))
        return self._once(key, lambda: written(make(), name))

    @cached_property
    def teammates(self) -> DataFrame:
        """Team-mates of every race: (season, round, driver_a, driver_b)."""
        entry = self.gold("race_results").select("season", "round", "team_id", "abbreviation")
        a = entry.withColumnRenamed("abbreviation", "driver_a")
        b = entry.withColumnRenamed("abbreviation", "driver_b")
        pairs = a.join(b, ["season", "round", "team_id"])
        return pairs.where("driver_a < driver_b").select("season", "round", "driver_a", "driver_b")

    @cached_property
    def lap_pairs(self) -> DataFrame:
        """The best laps of the two drivers of a team in a race, as (driver_a, lap_a, driver_b, lap_b)."""
        samples = self.staged("telemetry")
        teams = telemetry.driver_inventory(samples).select("season", "round", "team", "abbreviation").distinct()
        best = telemetry.best_lap(samples).join(teams, ["season", "round", "abbreviation"])
        a, b = (
            best.selectExpr("season", "round", "team", f"abbreviation as driver_{x}", f"lap_number as lap_{x}") for x in "ab"
        )
        pairs = a.join(b, ["season", "round", "team"]).where("driver_a < driver_b")
        return pairs.select("season", "round", "driver_a", "lap_a", "driver_b", "lap_b")
