"""Flattening of landed API pages (nested JSON) into raw tables.

A page is one JSON document; all pages of an endpoint are read as one dataset,
so pagination needs no loop.  The schemas declare optional fields, which makes
an absent field NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.functions import digits_to_int, full_name

_RACE = "season string, round string, raceName string, date string, Circuit struct<circuitName: string>"
_SESSION = "struct<date: string, time: string>"
_DRIVER = "driverId: string, code: string, givenName: string, familyName: string"
_TEAM = "name: string, nationality: string"


def _page(table: str, inner: str) -> str:
    return f"MRData struct<total: string, limit: string, offset: string, {table}: struct<{inner}>>"


def _races(extra: str) -> str:
    fields = ", ".join(part.replace(" ", ": ", 1) for part in _RACE.split(", "))
    return _page("RaceTable", f"Races: array<struct<{fields}, {extra}>>")


def _standings(extra: str) -> str:
    return _page("StandingsTable", f"StandingsLists: array<struct<season: string, round: string, {extra}>>")


#: Page schema of every endpoint.
PAGES = {
    "race_results": _races(
        "Results: array<struct<grid: string, position: string, points: string, status: string, "
        f"Driver: struct<{_DRIVER}>, Constructor: struct<{_TEAM}>, FastestLap: struct<rank: string>>>"
    ),
    "pit_stops": _races(
        "PitStops: array<struct<driverId: string, lap: string, stop: string, time: string, duration: string>>"
    ),
    "race_schedule": _races(
        f"time: string, FirstPractice: {_SESSION}, SecondPractice: {_SESSION}, ThirdPractice: {_SESSION}, "
        f"SprintQualifying: {_SESSION}, Sprint: {_SESSION}, Qualifying: {_SESSION}"
    ),
    "driver_standings": _standings(
        "DriverStandings: array<struct<position: string, points: string, wins: string, "
        f"Driver: struct<{_DRIVER}, dateOfBirth: string, nationality: string>, "
        f"Constructors: array<struct<{_TEAM}>>>>"
    ),
    "constructor_standings": _standings(
        "ConstructorStandings: array<struct<position: string, points: string, wins: string, "
        f"Constructor: struct<constructorId: string, {_TEAM}>>>"
    ),
}


def read_pages(spark: SparkSession, path: str, endpoint: str) -> DataFrame:
    """All landed pages of an endpoint (one JSON document per file)."""
    return spark.read.schema(PAGES[endpoint]).json(path, multiLine=True)


def parse_pages(texts: DataFrame, endpoint: str, column: str = "page") -> DataFrame:
    """The same from a column of JSON text."""
    return texts.select(F.from_json(column, PAGES[endpoint]).alias("__page")).select("__page.*")


def read_page_lines(spark: SparkSession, path: str, endpoint: str) -> DataFrame:
    """All pages of an endpoint landed as lines, one JSON document each.

    A file of any size is split among tasks.  A line that is no such page has its text in ``bad_page`` and nothing
    else; blank lines are left out.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    page = F.from_json("value", f"{PAGES[endpoint]}, bad_page string", {"columnNameOfCorruptRecord": "bad_page"})
    return lines.select(page.alias("__page")).select("__page.*")


def page_report(pages: DataFrame, endpoint: str) -> DataFrame:
    """(endpoint, pages, bad_pages) of :func:`read_page_lines`."""
    bad = F.count_if(F.col("bad_page").isNotNull())
    return pages.agg(F.count(F.lit(1)).alias("pages"), bad.alias("bad_pages")).select(F.lit(endpoint).alias("endpoint"), "pages", "bad_pages")


def _each(df: DataFrame, path: str, name: str, *kept: str) -> DataFrame:
    """One row per element of an array; rows without elements go.

    Written as an outer explode and a filter, because Spark would put a check of
    the array in front of a plain one and so parse the page text once more.
    """
    return df.select(*kept, F.explode_outer(path).alias(name)).where(F.col(name).isNotNull())


def _race_rows(pages: DataFrame, *inner: str) -> DataFrame:
    races = _each(pages, "MRData.RaceTable.Races", "race")
    for field in inner:
        races = _each(races, f"race.{field}", "item", "race")
    return races


def _race_keys() -> list[Column]:
    return [
        F.col("race.season").cast("int").alias("season"),
        F.col("race.round").cast("int").alias("round"),
        F.col("race.raceName").alias("race_name"),
        F.col("race.Circuit.circuitName").alias("circuit"),
    ]


def flatten_race_results(pages: DataFrame) -> DataFrame:
    return _race_rows(pages, "Results").select(
        *_race_keys(),
        F.col("race.date").alias("date"),
        F.col("item.Driver.driverId").alias("driver_id"),
        F.col("item.Driver.code").alias("driver_code"),
        full_name("item.Driver.givenName", "item.Driver.familyName").alias("driver_name"),
        F.col("item.Constructor.name").alias("constructor"),
        F.col("item.grid").cast("int").alias("grid"),
        digits_to_int("item.position").alias("position"),
        F.col("item.points").cast("double").alias("points"),
        F.col("item.status").alias("status"),
        F.nullif("item.FastestLap.rank", F.lit("")).cast("int").alias("fastest_lap_rank"),
    )


def flatten_pit_stops(pages: DataFrame) -> DataFrame:
    return _race_rows(pages, "PitStops").select(
        *_race_keys(),
        F.col("race.date").alias("date"),
        F.col("item.driverId").alias("driver_id"),
        F.col("item.lap").alias("lap_pitted"),
        F.col("item.stop").alias("stop_num"),
        F.col("item.time").alias("pit_in_time"),
        F.col("item.duration").alias("pit_stop_duration"),
    )


def flatten_race_schedule(pages: DataFrame) -> DataFrame:
    sessions = {
        "fp1": "FirstPractice",
        "fp2": "SecondPractice",
        "fp3": "ThirdPractice",
        "sprint_qualy": "SprintQualifying",
        "qualy": "Qualifying",
    }
    return _race_rows(pages).select(
        *_race_keys(),
        F.col("race.date").alias("race_date"),
        F.col("race.time").alias("race_start_time"),
        *[
            F.col(f"race.{session}.{part}").alias(f"{short}_{part}")
            for short, session in sessions.items()
            for part in ("date", "time")
        ],
    )


def _standing_rows(pages: DataFrame, field: str) -> DataFrame:
    lists = _each(pages, "MRData.StandingsTable.StandingsLists", "list")
    return _each(lists, f"list.{field}", "item", "list")


def _list_keys() -> list[Column]:
    return [F.col("list.season").cast("int").alias("season"), F.col("list.round").cast("int").alias("round")]


def _standing() -> list[Column]:
    return [
        digits_to_int("item.position").alias("position"),
        F.col("item.points").cast("double").alias("points"),
        F.col("item.wins").cast("int").alias("wins"),
    ]


def flatten_driver_standings(pages: DataFrame) -> DataFrame:
    """A driver of several teams counts for the first one listed."""
    team = F.get("item.Constructors", F.lit(0))
    return _standing_rows(pages, "DriverStandings").select(
        *_list_keys(),
        F.col("item.Driver.driverId").alias("driver_id"),
        F.col("item.Driver.code").alias("driver_code"),
        full_name("item.Driver.givenName", "item.Driver.familyName").alias("driver_name"),
        F.col("item.Driver.dateOfBirth").alias("driver_dob"),
        F.col("item.Driver.nationality").alias("driver_country"),
        team["name"].alias("constructor"),
        team["nationality"].alias("constructor_country"),
        *_standing(),
    )


def flatten_constructor_standings(pages: DataFrame) -> DataFrame:
    return _standing_rows(pages, "ConstructorStandings").select(
        *_list_keys(),
        F.col("item.Constructor.constructorId").alias("constructor_id"),
        F.col("item.Constructor.name").alias("constructor"),
        F.col("item.Constructor.nationality").alias("constructor_country"),
        *_standing(),
    )


FLATTEN = {
    "race_results": flatten_race_results,
    "pit_stops": flatten_pit_stops,
    "race_schedule": flatten_race_schedule,
    "driver_standings": flatten_driver_standings,
    "constructor_standings": flatten_constructor_standings,
}
