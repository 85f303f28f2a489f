"""Cleaning jobs on one- and two-row frames."""

import datetime as dt

import pytest

from lapforge import schemas
from lapforge.operators.losses import Losses
from lapforge.plans import silver

STAMP = "2031-07-21T00:00:00+00:00"
LATER = "2031-07-22T00:00:00+00:00"
# An invented championship: teams of birds, drivers of trees.
KEY = {"season": 2031, "round": 7}
PLACE = {"race_name": "Lake Prize", "circuit": "North Shore"}
BASE = {
    "race_results": {
        **KEY, **PLACE, "date": "2031-07-20", "driver_id": "oak", "driver_code": "OAK", "driver_name": "Olga Oak",
        "constructor": "Heron", "grid": 12, "position": 3, "points": 15.0, "status": "+1 Lap", "fastest_lap_rank": 4.0,
    },
    "driver_standings": {
        **KEY, "driver_id": "elm", "driver_code": "ELM", "driver_name": "Emil Elm", "driver_dob": "2004-12-31",
        "driver_country": "Finnish", "constructor": "Kestrel", "constructor_country": "Danish", "position": 8,
        "points": 33.5, "wins": 0,
    },
    "constructor_standings": {
        **KEY, "constructor_id": "kestrel", "constructor": "Kestrel", "constructor_country": "Danish", "position": 4,
        "points": 61.5, "wins": 0,
    },
    "pit_stops": {
        **KEY, **PLACE, "date": "2031-07-20", "driver_id": "elm", "lap_pitted": "17", "stop_num": "1",
        "pit_in_time": "13:05:59", "pit_stop_duration": "21.4",
    },
    "race_schedule": {
        **KEY, **PLACE, "race_date": "2031-07-20", "race_start_time": "12:30:00Z", "fp1_date": "2031-07-18",
        "fp1_time": "09:00:00Z", "fp2_date": "2031-07-18", "fp2_time": "13:15:00Z", "fp3_date": "2031-07-19",
        "fp3_time": "08:45:00Z", "sprint_qualy_date": None, "sprint_qualy_time": None, "qualy_date": "2031-07-19",
        "qualy_time": "12:00:00Z",
    },
    "results": {
        "driver_number": "204", "broadcast_name": "E ELM", "abbreviation": "ELM", "driver_id": "elm",
        "team_name": "Kestrel", "team_color": "A1B2C3", "team_id": "kestrel", "first_name": "Emil", "last_name": "Elm",
        "full_name": "Emil Elm", "headshot_url": "none", "country_code": "FIN", "position": 9.0,
        "classified_position": "9", "grid_position": 14.0, "q1": 71250000000, "q2": None, "q3": None,
        "time": 5400250000000, "status": "Finished", "points": 2.0, "laps": 71.0, **KEY,
    },
    "laps": {
        "time": 1000500000000, "driver": "ELM", "driver_number": "204", "lap_time": 72125000000, "lap_number": 11.0,
        "stint": 2.0, "pit_out_time": None, "pit_in_time": 1000400000000, "sector1_time": 20000000000,
        "sector2_time": 25062500000, "sector3_time": None, "sector1_session_time": 948375000000,
        "sector2_session_time": None, "sector3_session_time": 1000500000000, "speed_i1": 199.5, "speed_i2": None,
        "speed_fl": 281.0, "speed_st": 330.25, "is_personal_best": True, "compound": "HARD", "tyre_life": 6.0,
        "fresh_tyre": False, "team": "Kestrel", "lap_start_time": 928375000000,
        "lap_start_date": dt.datetime(2031, 7, 20, 12, 45, 30), "track_status": "24", "position": 16.0, "deleted": True,
        "deleted_reason": "", "fast_f1_generated": True, "is_accurate": False, **KEY,
    },
    "telemetry": {
        "date": dt.datetime(2031, 7, 20, 12, 45, 31, 250000), "session_time": 929625000000, "driver_ahead": "",
        "distance_to_driver_ahead": 12.5, "time": 1250000000, "rpm": 10101.0, "speed": 144.0, "n_gear": 4,
        "throttle": 100.0, "brake": False, "drs": 12, "distance": 48.0, "relative_distance": 0.01, "status": "OnTrack",
        "x": 1.5, "y": -2.5, "z": 0.0, **KEY, "driver": "ELM", "team": "Kestrel", "lap_number": 11,
    },
    "weather": {
        "time": 90500000000, "air_temp": 17.5, "humidity": 81.0, "pressure": 990.25, "rainfall": True, "track_temp": 19.0,
        "wind_direction": 359, "wind_speed": 0.0, **KEY,
    },
}


def cleaned(spark, table, *changes, stamps=None):
    columns = [c.strip().split(" ")[0] for c in schemas.RAW_TABLES[table].split(",")]
    rows = []
    for i, change in enumerate(changes or ({},)):
        stamp = stamps[i] if stamps else STAMP
        row = {**BASE[table], "source": "s", "ingested_at": stamp, **change}
        rows.append(tuple(row[c] for c in columns))
    raw = spark.createDataFrame(rows, schemas.RAW_TABLES[table])
    return silver.CLEANERS[table](raw)


def row(spark, table, **change):
    return cleaned(spark, table, change).collect()[0]


@pytest.mark.parametrize("table", list(BASE))
def test_plain_row_survives_with_typed_load_time(spark, table):
    got = cleaned(spark, table).collect()
    assert len(got) == 1
    assert got[0]["ingested_at"] == dt.datetime(2031, 7, 21)


@pytest.mark.parametrize(
    "table, change",
    [
        ("race_results", {"status": "Lapped"}),
        ("driver_standings", {"points": 44.0}),
        ("constructor_standings", {"points": 80.0}),
        ("pit_stops", {"pit_stop_duration": "31.0"}),
        ("race_schedule", {"circuit": "Elsewhere"}),
        ("results", {"points": 18.0}),
        ("laps", {"position": 7.0}),
        ("telemetry", {"speed": 100.0}),
        ("weather", {"humidity": 60.0}),
    ],
)
def test_of_equal_keys_the_last_loaded_stays(spark, table, change):
    name, value = next(iter(change.items()))
    for order in ((STAMP, LATER), (LATER, STAMP)):
        got = cleaned(spark, table, {}, change, stamps=order).collect()
        assert len(got) == 1
        wanted = value if order[1] == LATER else BASE[table][name]
        if table == "pit_stops":
            wanted = float(wanted)
        assert got[0][name] == wanted


@pytest.mark.parametrize(
    "table, change",
    [
        ("race_results", {"round": 8}),
        ("race_results", {"season": 2030}),
        ("driver_standings", {"driver_id": "other"}),
        ("constructor_standings", {"constructor_id": "other"}),
        ("pit_stops", {"stop_num": "2"}),
        ("race_schedule", {"round": 8}),
        ("results", {"driver_id": "other"}),
        ("laps", {"lap_number": 12.0}),
        ("laps", {"driver": "OAK"}),
        ("telemetry", {"driver": "OAK"}),
        ("telemetry", {"lap_number": 12}),
        ("telemetry", {"lap_number": None}),
        ("weather", {"time": 91500000000}),
    ],
)
def test_near_duplicates_stay(spark, table, change):
    assert cleaned(spark, table, {}, change).count() == 2


def test_race_results(spark):
    got = row(spark, "race_results", status=None, driver_code=None, driver_name=None, driver_id="  van Oak ",
              constructor="Grey Heron", fastest_lap_rank=None)
    assert (got["status"], got["abbreviation"], got["driver_name"]) == ("Unknown", "UNK", "Unknown Driver")
    assert (got["driver_id"], got["constructor"], got["fastest_lap_rank"]) == ("van_oak", "grey_heron", None)
    assert row(spark, "race_results")["fastest_lap_rank"] == 4
    assert row(spark, "race_results")["date"] == dt.date(2031, 7, 20)
    with pytest.raises(Exception):
        row(spark, "race_results", date="20/07/2031")


def test_driver_standings(spark):
    got = row(spark, "driver_standings", driver_country=None, constructor_country=None, driver_name=None, points=0.5)
    assert (got["driver_country"], got["constructor_country"]) == ("Unknown", "Unknown")
    assert (got["driver_name"], got["points"], got["driver_dob"]) == ("Unknown Driver", 0.5, dt.date(2004, 12, 31))


def test_constructor_standings(spark):
    got = row(spark, "constructor_standings", constructor=None, constructor_id=" Grey Heron ")
    assert (got["constructor"], got["constructor_id"]) == ("Unknown Constructor", "grey_heron")
    assert row(spark, "constructor_standings")["constructor"] == "Kestrel"


def test_pit_stops(spark):
    got = row(spark, "pit_stops", pit_stop_duration="2:03.25", pit_in_time="25:61:00")
    assert got["pit_stop_duration"] == pytest.approx(123.25)
    assert (got["lap_pitted"], got["stop_num"], got["pit_in_time"]) == (17, 1, None)
    for bad in (None, "", "   ", "DNF", "nan"):
        assert cleaned(spark, "pit_stops", {"pit_stop_duration": bad}).count() == 0


def test_race_schedule(spark):
    got = row(spark, "race_schedule", race_name=None, circuit=None)
    assert got["race_datetime"] == dt.datetime(2031, 7, 20, 12, 30)
    assert got["sprint_qualy_datetime"] is None
    assert (got["race_name"], got["circuit"]) == ("Unknown Race", "Unknown Circuit")
    sprint = row(spark, "race_schedule", fp2_date=None, fp2_time=None, sprint_qualy_date="2031-07-18",
                 sprint_qualy_time="16:20:00Z")
    assert (sprint["fp2_datetime"], sprint["sprint_qualy_datetime"]) == (None, dt.datetime(2031, 7, 18, 16, 20))
    assert row(spark, "race_schedule", race_start_time="TBC")["race_datetime"] is None
    columns = cleaned(spark, "race_schedule").columns
    assert len(columns) == len(schemas.RACE_SCHEDULE.split(",")) - 6


def test_race_schedule_without_optional_columns(spark):
    raw = spark.createDataFrame([(2031, 7, "R", "C", STAMP)], "season int, round int, race_name string, circuit string, ingested_at string")
    assert "fp1_datetime" not in silver.clean_race_schedule(raw).columns


def test_results(spark):
    got = row(spark, "results", classified_position=None, status=None, first_name=None, last_name=None, full_name=None,
              position=None, driver_id=" Ash  Tree ", team_id="Grey Heron Cars")
    assert (got["classified_position"], got["status"], got["full_name"]) == ("Unknown", "Unknown", "Unknown Driver")
    assert (got["first_name"], got["last_name"], got["position"]) == ("Unknown", "Unknown", None)
    assert (got["driver_id"], got["team_id"]) == ("ash__tree", "grey_heron_cars")
    assert row(spark, "results")["time_seconds"] == 5400.25
    assert row(spark, "results", classified_position="W")["classified_position"] == "W"
    assert not {"headshot_url", "country_code", "q1", "q2", "q3", "time"} & set(got.asDict())


def test_laps(spark):
    got = row(spark, "laps", compound=None, track_status="", team=" Grey Heron Cars ", lap_time=None)
    assert (got["compound"], got["track_status"], got["team"]) == ("UNKNOWN", None, "grey_heron_cars")
    assert (got["lap_time_seconds"], got["deleted_reason"], got["abbreviation"]) == (None, None, "ELM")
    plain = row(spark, "laps")
    assert (plain["lap_time_seconds"], plain["sector2_time_seconds"], plain["lap_number"]) == (72.125, 25.0625, 11)
    assert "lap_time" not in plain.asDict()
    assert cleaned(spark, "laps", {"is_accurate": True}, {"lap_number": 1.0}).count() == 2


def test_telemetry(spark):
    got = row(spark, "telemetry", status="")
    assert (got["driver_ahead"], got["status"], got["distance"]) == (None, None, 48.0)
    assert (got["session_time_seconds"], got["lap_time_seconds"]) == (929.625, 1.25)
    assert cleaned(spark, "telemetry", {"distance": None}).count() == 0
    assert cleaned(spark, "telemetry", {"distance": float("nan")}).count() == 0


def test_weather_fill(spark):
    def temps(*readings):
        rows = [{"season": s, "round": r, "time": t * 10**9, "air_temp": a} for s, r, t, a in readings]
        got = cleaned(spark, "weather", *rows).orderBy("season", "round", "time_seconds").collect()
        return [g["air_temp"] for g in got]

    assert temps((2031, 7, 0, 9.5), (2031, 7, 45, None), (2031, 7, 50, 11.0)) == [9.5, 9.5, 11.0]
    assert temps((2031, 7, 0, 9.5), (2031, 7, 45, None), (2031, 7, 45, None)) == [9.5, 9.5]
    assert temps((2031, 7, 0, 9.5), (2031, 8, 45, None)) == [9.5, None]
    assert temps((2030, 7, 0, 9.5), (2031, 7, 45, None)) == [9.5, None]
    assert temps((2031, 7, 0, None), (2031, 7, 45, -1.0)) == [None, -1.0]
    # of two readings at one time the last is kept, with the temperature known by then
    for stamps in ((STAMP, LATER), (LATER, STAMP)):
        pair = cleaned(spark, "weather", {"air_temp": 8.25, "humidity": 40.0}, {"air_temp": None, "humidity": 41.0}, stamps=stamps)
        got = pair.collect()
        assert [(g["air_temp"], g["humidity"]) for g in got] == [(8.25, 41.0 if stamps[1] == LATER else 40.0)]
    assert temps((2031, 7, 0, 9.5), (2031, 7, 86400, None), (2031, 7, 172800, float("nan"))) == [9.5] * 3


def test_values_are_read_once_when_losses_are_counted(spark):
    """Counting what cannot be read does not read every value a second time."""
    raw = spark.createDataFrame([], schemas.PIT_STOPS)
    plain, counted = (
        silver.clean_pit_stops(raw, losses=job)._jdf.queryExecution().optimizedPlan().toString() for job in (None, Losses("pit_stops"))
    )
    time_of_day = r"\d{1,2}:\d{1,2}:\d{1,2}"
    assert plain.count(time_of_day) == counted.count(time_of_day) > 0
