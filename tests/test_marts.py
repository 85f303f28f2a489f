"""Marts and analyses on small hand-made tables."""

import pytest
from conftest import rows

from lapforge.operators import quality
from lapforge.plans import dashboards, marts, pace, results, staging, telemetry

RESULTS = (
    "season int, round int, driver_id string, driver_number string, broadcast_name string, abbreviation string, "
    "first_name string, last_name string, full_name string, team_id string, team_name string, team_color string, "
    "grid_position long, finish_position long, classified_position string, laps long, status string, points double, "
    "race_time_seconds double"
)


def results_b(spark, *drivers):
    data = [
        (2026, 1, d, "1", d, d[:1].upper(), d, d, d, team, team, colour, 5, finish, "1", 50, "Finished", 1.0, 100.0)
        for d, team, colour, finish in drivers
    ]
    return spark.createDataFrame(data, RESULTS)


def laps(spark, data):
    """(driver, lap, stint, compound, tyre_life, time, accurate)"""
    schema = (
        "season int, round int, abbreviation string, lap_number long, stint long, compound string, tyre_life long, "
        "lap_time_seconds double, is_accurate boolean, fresh_tyre boolean"
    )
    return spark.createDataFrame([(2026, 1, *d, True) for d in data], schema)


def test_points_of_one_source_status_of_the_other(spark):
    a = spark.createDataFrame(
        [(2026, 1, "ann", "Race", "C", None, "slug", 25.0, 1, "Other")],
        "season int, round int, driver_id string, race_name string, circuit string, race_date date, "
        "constructor string, points double, fastest_lap_rank long, status string",
    )
    schedule = spark.createDataFrame([(2026, 1, True)], "season int, round int, is_sprint_weekend boolean")
    b = results_b(spark, ("ann", "T", "aa", 1), ("bob", "T", "aa", 2))
    got = {r["driver_id"]: r for r in marts.mart_race_results(b, a, schedule).collect()}
    assert (got["ann"]["points"], got["ann"]["status"], got["ann"]["constructor"]) == (25.0, "Finished", "slug")
    assert (got["bob"]["points"], got["bob"]["race_name"], got["bob"]["is_sprint_weekend"]) == (None, None, True)


def test_points_this_round(spark):
    df = spark.createDataFrame(
        [(2026, r, "ann", p) for r, p in ((1, 10.0), (2, 25.0), (4, 26.0))] + [(2025, 9, "ann", 99.0)],
        "season int, round int, constructor_id string, championship_points double",
    ).selectExpr("*", "'x' constructor", "'y' constructor_country", "1 championship_position", "0 wins")
    got = rows(marts.mart_constructor_standings(df), "season", "round", "points_this_round")
    assert got == [(2025, 9, None), (2026, 1, None), (2026, 2, 15.0), (2026, 4, 1.0)]


@pytest.mark.parametrize("chunk", [1, 8, 4096])
def test_next_compound(spark, chunk):
    lap_rows = laps(
        spark, [("A", 5, 1, "SOFT", 5, 90.0, True), ("A", 6, 2, "HARD", 1, 90.0, True), ("A", 20, 2, "MEDIUM", 15, 90.0, True)]
    )
    stops = spark.createDataFrame(
        [(2026, 1, d, "R", "C", None, n, lap, None, 25.0) for d, n, lap in
         (("ann", 1, 5), ("ann", 2, 20), ("ann", 3, 40), ("zed", 1, 5), ("zed", 2, 20))],
        "season int, round int, driver_id string, race_name string, circuit string, race_date date, "
        "pit_stop_number long, lap_pitted long, pit_in_time string, pit_stop_duration_seconds double",
    )
    b = results_b(spark, ("ann", "T", "aa", 1)).withColumn("abbreviation", marts.F.lit("A"))
    faithful = marts.pit_stops_enriched(stops, lap_rows, b, chunk_laps=chunk)
    assert rows(faithful, "driver_id", "pit_stop_number", "compound_ending", "compound_starting") == [
        ("ann", 1, "SOFT", "MEDIUM"), ("ann", 2, "MEDIUM", None), ("ann", 3, None, None),
        ("zed", 1, None, None), ("zed", 2, None, None),
    ]
    following = marts.pit_stops_enriched(stops, lap_rows, b, next_lap=True)
    assert rows(following, "driver_id", "pit_stop_number", "compound_starting")[0] == ("ann", 1, "HARD")
    slow = marts.mart_pit_stops(stops, lap_rows, b, slow=20)
    assert {r[0] for r in slow.select("is_slow_pit_stop").collect()} == {True}


def test_tyre_stints(spark):
    lap_rows = laps(
        spark,
        [("A", 1, 1, "SOFT", 1, 90.0, True), ("A", 2, 1, "SOFT", 2, 92.0, False), ("A", 3, 1, "SOFT", 3, 94.0, True),
         ("A", 4, 1, "SOFT", 4, None, True), ("B", 1, 1, "HARD", 1, 90.0, False)],
    )
    got = {r["abbreviation"]: r for r in marts.tyre_stints(lap_rows).collect()}
    a, b = got["A"], got["B"]
    assert (a["stint_start_lap"], a["stint_end_lap"], a["stint_length_laps"], a["tyre_age_end"]) == (1, 3, 3, 3)
    assert (a["avg_lap_time_seconds"], a["fastest_lap_seconds"]) == (92.0, 90.0)
    assert a["degradation_rate_seconds_per_lap"] == pytest.approx(2.0)
    assert (b["avg_lap_time_seconds"], b["degradation_rate_seconds_per_lap"]) == (None, None)


def test_telemetry_stints_equal_joining_every_sample(spark):
    tel = spark.createDataFrame(
        [(2026, 1, "A", lap, float(s), float(th), br, drs, g, float(d))
         for lap, s, th, br, drs, g, d in ((1, 0, 99, True, 10, 1, 5), (1, 100, 50, False, 8, 3, 90),
                                           (2, 200, 100, False, 12, 5, 70), (3, 9, 9, True, 0, 1, 1))],
        "season int, round int, abbreviation string, lap_number long, speed double, throttle double, brake boolean, "
        "drs int, n_gear int, distance double",
    )
    lap_rows = laps(spark, [("A", 1, 1, "S", 1, 90.0, True), ("A", 2, 1, "S", 2, 90.0, True), ("A", 3, None, "S", 3, 90.0, True)])
    got = marts.telemetry_stints(tel, lap_rows).collect()
    assert len(got) == 1
    g = got[0]
    assert (g["stint_laps"], g["tyre_age_start"], g["tyre_age_end"]) == (2, 1, 2)
    assert (g["avg_speed"], g["max_speed"], g["min_speed_on_throttle"]) == (100.0, 200.0, 100.0)
    assert (g["full_throttle_pct"], g["brake_pct"], g["drs_open_pct"]) == (66.667, 33.333, 66.667)
    assert (g["avg_throttle"], g["avg_gear"], g["max_distance_metres"]) == (83.0, 3.0, 90.0)


def test_staging_renames(spark):
    df = spark.createDataFrame([(2026, 1, "x", 1, 2.0, 3, "c", "n")],
        "season int, round int, constructor_id string, position int, points double, wins int, constructor_country string, constructor string")
    out = staging.staged_view(df, "constructor_standings")
    assert out.columns[-3:] == ["championship_position", "championship_points", "wins"]
    assert spark.table("stg_constructor_standings").count() == 1


def race(spark, data):
    """(round, team, driver, grid, finish)"""
    return spark.createDataFrame(
        [(2026, *d) for d in data],
        "season int, round int, constructor string, abbreviation string, grid_position long, finish_position long",
    )


def test_head_to_head_tie_goes_to_the_second(spark):
    df = race(spark, [(1, "t", "A", 1, 3), (1, "t", "B", 2, 3), (2, "t", "A", 1, 1), (2, "t", "B", 1, 2), (3, "t", "A", 1, None), (3, "t", "B", 1, 1)])
    assert rows(results.head_to_head(df), "driver_a", "driver_b", "winner", "rounds_ahead") == [("A", "B", "A", 1), ("A", "B", "B", 1)]


def test_racecraft_ignores_unplaced(spark):
    df = race(spark, [(1, "t", "A", 5, 1), (2, "t", "A", 2, 4), (3, "t", "A", None, 1), (4, "t", "A", 1, None)])
    got = results.racecraft(df).collect()[0]
    assert (got["races"], got["total_positions_gained"], got["avg_finish"], got["avg_grid"]) == (2, 2, 2.5, 3.5)


def test_pace_summary_of_single_lap(spark):
    df = laps(spark, [("A", 1, 1, "S", 1, 50.0, True), ("A", 2, 1, "S", 2, 90.0, True), ("B", 2, 1, "S", 2, 91.5, True), ("B", 3, 1, "S", 3, None, True)])
    df = df.selectExpr("*", "'t' team_id", "cast(null as double) pit_out_time_seconds")
    got = rows(pace.pace_summary(df), "abbreviation", "median_lap_s", "std_lap_s", "lap_count", "delta_to_fastest_s")
    assert got == [("A", 90.0, None, 1, 0.0), ("B", 91.5, None, 2, 1.5)]


def test_best_lap_is_the_smallest_time_stamp(spark):
    df = spark.createDataFrame(
        [(2026, 1, "A", 1, 0.0), (2026, 1, "A", 1, 0.3), (2026, 1, "A", 2, 0.1), (2026, 1, "A", 3, 0.1), (2026, 1, "A", None, 0.01)],
        "season int, round int, abbreviation string, lap_number long, lap_time_seconds double",
    )
    assert rows(telemetry.best_lap(df), "lap_number", "lap_time") == [(2, 0.1)]


def test_trend_line_spans_the_fit(spark):
    curve = spark.createDataFrame([(2026, 1, "S", x, 1.0 + 2.0 * x) for x in (1, 2, 4)], "season int, round int, compound string, tyre_life long, median double")
    fit = dashboards.degradation_fit(curve)
    line = rows(dashboards.trend_line(fit), "i", "x", "y")
    assert len(line) == 50
    assert line[0][1:] == (1.0, pytest.approx(3.0)) and line[-1][1:] == (pytest.approx(4.0), pytest.approx(9.0))
    assert dashboards.degradation_fit(curve.where("tyre_life = 1")).count() == 0


def test_filters_by_race(spark):
    df = race(spark, [(1, "t", "A", 5, 1), (2, "t", "A", 2, 4)])
    assert dashboards.for_race(df, 2026, 2).count() == 1
    assert dashboards.for_race(df, 2025).count() == 0
    assert dashboards.for_race(df).count() == 2


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")
    assert rows(quality.not_null(df, ["k", "v"])) == [("k", 0), ("v", 1)]
    assert rows(quality.unique(df, ["k"])) == [(1, 2)]
    assert quality.null_rows(df, "v").count() == 1
    assert quality.missing_columns(df, ["k", "z"]) == ["z"]
    report = quality.drop_report("t", df, df.where("k = 1")).collect()[0]
    assert (report["bronze"], report["silver"], report["dropped"], report["alarm"]) == (3, 2, 1, True)
    empty = quality.drop_report("t", df.limit(0), df.limit(0)).collect()[0]
    assert (empty["bronze"], empty["dropped_pct"], empty["alarm"]) == (0, 0.0, False)
    counted, seen = quality.counted(df, "seen")
    counted.collect()
    assert seen.get["rows"] == 3


def test_slopes_on_a_limit_are_no_outliers(spark):
    """Stints whose slope is exactly -2 or 5; ``regr_slope`` puts some of them beyond by the last bit."""
    ages = [[1, 3], [1, 4, 6], [2, 3, 9], [1, 2, 3, 5, 8]]
    data = []
    for stint in range(4000):
        x, slope = ages[stint % 4], (-2, 5)[stint % 2]
        data += [(1, 1, "A", stint, "HARD", True, i, age, (60_000 + 37 * stint % 9973 + slope * 1000 * age) / 1000, True) for i, age in enumerate(x)]
    laps = spark.createDataFrame(
        data, "season int, round int, abbreviation string, stint long, compound string, fresh_tyre boolean, "
        "lap_number long, tyre_life long, lap_time_seconds double, is_accurate boolean"
    )
    stints = marts.tyre_stints(laps)
    assert {r[0] for r in stints.select("degradation_rate_seconds_per_lap").distinct().collect()} == {-2.0, 5.0}
    assert quality.degradation_outliers(stints).count() == 0
    one = marts.tyre_stints(laps.where("stint = 0 and tyre_life = 1")).collect()
    assert one[0]["degradation_rate_seconds_per_lap"] is None


def test_laps_on_a_fence_and_equal_medians(spark):
    """A lap exactly 1.5 quartile distances out is within the whiskers; equal medians are ordered by name."""
    data = []
    for race in range(2000):
        q1, iqr = 60_000 + 7 * race, 2 * (1 + race % 900)
        times = [q1, q1, q1 + iqr // 2, q1 + iqr, q1 + iqr * 5 // 2]  # quartiles q1 and q1 + iqr
        data += [(race, 1, "B", 2 + i, t / 1000, None) for i, t in enumerate(times)]
        middle = q1 + iqr // 2
        data += [(race, 1, "A", 2 + i, t / 1000, None) for i, t in enumerate([middle - 1 - race % 97, middle + 1 + race % 97])]
    laps = spark.createDataFrame(
        data, "season int, round int, abbreviation string, lap_number long, lap_time_seconds double, pit_out_time_seconds double"
    )
    boxes = pace.lap_boxes(laps).collect()
    assert all(r["outliers"] == 0 for r in boxes)
    assert all(r["order_idx"] == (1 if r["abbreviation"] == "A" else 2) for r in boxes)


def test_degradation_deltas_move_laps_once(spark):
    """One shuffle; a stint without a number is a stint, its first timed lap counts."""
    schema = "season int, round int, abbreviation string, team_name string, stint long, compound string, tyre_life long, lap_number long, lap_time_seconds double"
    laps = [(2030, 1, "A", "t", s, "SOFT", n, n, t) for s, n, t in [(1, 1, None), (1, 2, 80.0), (1, 3, 81.5), (None, 9, 90.0), (None, 8, 88.0)]]
    got = dashboards.degradation_deltas(spark.createDataFrame(laps, schema))
    assert rows(got, "lap_number", "delta") == [(2, 0.0), (3, 1.5), (8, 0.0), (9, 2.0)]
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
