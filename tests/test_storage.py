"""Sources, sinks, catalog, and the streaming path."""

import json
import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_silver import BASE, LATER, STAMP

from lapforge import schemas
from lapforge.operators.profile import Profile
from lapforge.operators.ranking import with_order
from lapforge.plans import dashboards
from lapforge.plans.silver import clean_telemetry, typed_telemetry
from lapforge.session import shared_folder, written
from lapforge.sources import bronze, catalog, pages, sinks
from lapforge.streaming import live
from lapforge.streaming.merge import LiveTable
from testbed.bindings import Tables
from testbed.catalogue import bucketed


def test_replace_partitions_is_idempotent_and_touches_only_its_races(spark, database):
    table = f"{database}.laps"
    first = spark.createDataFrame([(2026, 1, "a", 1), (2026, 2, "b", 2)], "season int, round int, d string, v int")
    sinks.replace_partitions(first, table)
    again = spark.createDataFrame([(2026, 2, "c", 3), (2026, 2, "d", 4)], "season int, round int, d string, v int")
    for _ in range(2):
        sinks.replace_partitions(again.select("v", "round", "d", "season"), table)
        assert rows(spark.table(table), "round", "d", "v") == [(1, "a", 1), (2, "c", 3), (2, "d", 4)]


def test_a_hot_race_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(200_000).selectExpr("2026 as season", "1 as round", "id", "sha2(cast(id as string), 256) as pad")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        sinks.spread_by(df, ["season", "round"]).write.partitionBy("season", "round").parquet(str(tmp_path / "hot"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(str(tmp_path / "hot"))
    assert back.count() == 200_000 and len(back.inputFiles()) > 3


def test_full_refresh_and_create_empty(spark, database):
    table = f"{database}.t"
    sinks.create_empty(spark, "season int, round int, v int", table)
    sinks.create_empty(spark, "season int, round int, v int", table)
    assert spark.table(table).count() == 0
    for n in (3, 2):
        sinks.full_refresh(spark.range(n), f"{database}.r")
        assert spark.table(f"{database}.r").count() == n


def test_catalog_reports(spark, database):
    df = spark.createDataFrame([(2026, 1), (2026, 1), (2025, 3)], "season int, round int")
    sinks.full_refresh(df, f"{database}.t")
    report = catalog.verify_tables(spark, [f"{database}.t", f"{database}.none"])
    got = {r["table"].split(".")[1]: (r["rows"], r["rounds"], r["seasons"], r["error"]) for r in report.collect()}
    assert got == {"t": (3, 2, 2, None), "none": (None, None, None, "table not found")}
    assert [r["tableName"] for r in catalog.list_tables(spark, database).collect()] == ["t"]
    assert rows(catalog.list_columns(df), "position", "column_name", "data_type") == [(1, "season", "int"), (2, "round", "int")]
    assert tuple(catalog.round_counts(df, 2026, 1).collect()[0]) == (2, 3)
    assert [r["season"] for r in catalog.preview(df, ["season"], 2).collect()] == [2025, 2026]
    assert catalog.union_all([df, spark.range(1)]).columns == ["season", "round", "id"]


def test_landing_and_partition_pruning(spark, tmp_path):
    columns = [c.strip().split(" ")[0] for c in schemas.WEATHER.split(",")]
    plain = [c for c in columns if c not in ("source", "ingested_at")]
    ddl = ", ".join(p for p in schemas.WEATHER.split(", ") if p.split(" ")[0] in plain)
    data = [tuple({**BASE["weather"], "round": r, "time": t}[c] for c in plain) for r in (1, 2) for t in (0, 1, 2)]
    df = spark.createDataFrame(data, ddl)
    for _ in range(2):
        bronze.land_raw(df, "B", str(tmp_path), "weather")
    back = bronze.read_bronze(spark, str(tmp_path), "weather", BASE["weather"]["season"], 2)
    assert back.count() == 3
    assert back.select("source").distinct().collect()[0][0] == "B"
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan
    assert bronze.read_files(spark, f"{tmp_path}/weather").count() == 6
    assert bronze.move_last(df, "season").columns[-1] == "season"
    assert bronze.with_keys(spark.range(1), 2026, 3).select("season", "round").collect()[0] == (2026, 3)


def test_files_by_pattern_and_nanoseconds(spark, tmp_path):
    stamps = np.array(["2026-03-08T04:03:26.366123456"], dtype="datetime64[ns]")
    for name in ("round1.parquet", "round2.parquet", "other.parquet"):
        pq.write_table(pa.table({"date": pa.array(stamps), "v": [1]}), tmp_path / name)
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        df = bronze.read_nanosecond_files(spark, str(tmp_path), "telemetry")
        assert {str(r["date"]) for r in df.collect()} == {"2026-03-08 04:03:26.366123"}
        assert bronze.read_files(spark, str(tmp_path), pattern="round*.parquet").count() == 2
    finally:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "false")


def test_pages_split_over_files(spark, tmp_path):
    def result(driver, position, **more):
        return {"grid": "1", "position": position, "points": "25", "status": "Finished",
                "Driver": {"driverId": driver, "givenName": "G", "familyName": "F"}, "Constructor": {"name": "T"}, **more}

    race = {"season": "2026", "round": "1", "raceName": "R", "date": "2026-03-08", "Circuit": {"circuitName": "C"}}
    for i, results in enumerate(
        ([result("a", "1", FastestLap={"rank": "3"})], [result("b", "R"), result("c", "2", FastestLap={"rank": ""})])
    ):
        page = {"MRData": {"total": "3", "limit": "2", "offset": str(i * 2), "RaceTable": {"Races": [{**race, "Results": results}]}}}
        (tmp_path / f"p{i}.json").write_text(json.dumps(page, indent=1))
    flat = pages.flatten_race_results(pages.read_pages(spark, str(tmp_path), "race_results"))
    got = rows(flat, "driver_id", "driver_code", "driver_name", "position", "fastest_lap_rank", "season")
    assert got == [("a", None, "G F", 1, 3, 2026), ("b", None, "G F", None, None, 2026), ("c", None, "G F", 2, None, 2026)]


def test_schedule_pages_with_missing_sessions(spark):
    race = {"season": "2026", "round": "2", "raceName": "R", "date": "d", "time": "t", "Circuit": {"circuitName": "C"},
            "FirstPractice": {"date": "a", "time": "b"}, "SprintQualifying": {"date": "s"}, "Qualifying": {"date": "q", "time": "z"}}
    texts = spark.createDataFrame([(json.dumps({"MRData": {"RaceTable": {"Races": [race]}}}),)], "page string")
    got = pages.flatten_race_schedule(pages.parse_pages(texts, "race_schedule")).collect()[0]
    assert (got["fp1_time"], got["fp2_date"], got["sprint_qualy_date"], got["sprint_qualy_time"], got["qualy_time"]) == (
        "b", None, "s", None, "z",
    )


def test_shared_folder_follows_the_session(spark, tmp_path):
    own = shared_folder(spark)
    assert own == shared_folder(spark)
    back = written(spark.range(5), "x/y")
    assert back.count() == 5 and own in back.inputFiles()[0]


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    """Samples are summed per lap and meet their laps where they lie."""
    df = spark.range(3000).selectExpr("1 as season", "cast(id % 3 as int) as round", "cast(id % 7 as string) as abbreviation", "id % 11 as lap_number", "id as v")
    keys = ["season", "round", "abbreviation", "lap_number"]
    for name, part in {"b_samples": df, "b_laps": df.select(*keys).distinct()}.items():
        sinks.store_bucketed(part, name, keys, 5, str(tmp_path / name))
    try:
        sums = spark.table("b_samples").groupBy(*keys).agg(F.sum("v").alias("v"))
        joined = sums.join(spark.table("b_laps").hint("merge"), keys)
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.agg(F.sum("v")).first()[0] == sum(range(3000)) and len(spark.table("b_samples").inputFiles()) == 5
    finally:
        spark.sql("drop table b_samples")
        spark.sql("drop table b_laps")


def test_replace_races_keeps_other_races_of_a_season(spark, database):
    table = f"{database}.small"
    sinks.replace_races(spark.createDataFrame([(1, r, 0) for r in range(4)] + [(2, 0, 0)], "season int, round int, v int"), table)
    for _ in range(2):
        sinks.replace_races(spark.createDataFrame([(1, 2, 9), (1, 2, 8), (3, 1, 7)], "season int, round int, v int"), table)
        want = [(1, 0, 0), (1, 1, 0), (1, 2, 8), (1, 2, 9), (1, 3, 0), (2, 0, 0), (3, 1, 7)]
        assert rows(spark.table(table), "season", "round", "v") == want


def test_page_lines_split_and_bad_pages(spark, tmp_path):
    page = '{"MRData": {"total": "1", "RaceTable": {"Races": [{"season": "2031", "round": "%d", "raceName": "r", "PitStops": [{"driverId": "d", "lap": "3"}]}]}}}'
    lines = [page % i for i in range(400)] + ["", "no page", page[:40], "   "]
    (tmp_path / "p.jsonl").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = pages.read_page_lines(spark, str(tmp_path / "p.jsonl"), "pit_stops")
        assert got.rdd.getNumPartitions() > 3
        assert [tuple(r) for r in pages.page_report(got, "pit_stops").collect()] == [("pit_stops", 402, 2)]
        flat = pages.flatten_pit_stops(got)
        assert sorted(r["round"] for r in flat.collect()) == list(range(400))
        assert sorted(r[0] for r in got.where("bad_page is not null").select("bad_page").collect()) == sorted(["no page", page[:40]])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_counts_come_from_footers(spark, tmp_path):
    df = spark.range(100).selectExpr("cast(id % 2 as int) as season", "cast(id % 5 as int) as round", "id")
    df.write.partitionBy("season", "round").parquet(str(tmp_path / "t"))
    got = catalog.footer_counts(spark, str(tmp_path / "t"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(" in plan and "PushedGroupBy: [season, round]" in plan.replace("`", "")
    assert rows(got) == [(s, r, 10) for s in (0, 1) for r in range(5)]


def test_order_as_data(spark):
    rng = np.random.default_rng(3)
    data = [(int(a), None if a % 9 == 0 else float(b)) for a, b in zip(rng.integers(0, 40, 500), rng.integers(0, 5, 500), strict=True)]
    df = spark.createDataFrame(data, "a int, b double").repartition(7)
    got = with_order(df, [F.col("b").desc_nulls_last(), "a"]).orderBy("order_idx").collect()
    assert [r["order_idx"] for r in got] == list(range(1, 501))
    assert [(r["a"], r["b"]) for r in got] == sorted(data, key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
    assert with_order(df.limit(0), ["a"]).count() == 0


def test_order_as_data_puts_nulls_last(spark):
    df = spark.createDataFrame([("D2", None), ("D2", "team_1"), (None, "team_0")], "a string, b string")
    got = with_order(df, ["a", "b"]).orderBy("order_idx").collect()
    assert [tuple(r)[:2] for r in got] == [("D2", "team_1"), ("D2", None), (None, "team_0")]


def test_published_tables_have_no_file_per_season(spark, tmp_path):
    """Seasons grow with the data; files follow the tasks that write them."""
    seasons = [(1000 * i, i, 80 * i, 1, 1.0, 100.0 + i, 0.1, 0.0, "A", "F", datetime(1995, 3, 1)) for i in range(200)]
    lines = spark.createDataFrame(
        seasons, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    t = Tables.of(spark, str(tmp_path))
    for table in (t.silver("laps"), t.silver("results"), t.gold("lap_times")):
        assert table.select("season").distinct().count() == table.count() == 200
        assert len(table.inputFiles()) <= 8


def test_tables_stored_by_lap_move_their_rows_once(spark, tmp_path):
    """Rows are dealt out by lap while they are narrow; the wide rows stay there, and buckets follow the size of the table."""
    lines = [
        (7 * i, i % 90, None if i % 31 == 0 else 5 * i % 400, i % 5, 1.0, 100.0 + i, 0.1, 0.0, "A", "F", None if i % 41 == 0 else datetime(1995, 1 + i % 12, 1))
        for i in [*range(600), *range(200)]
    ]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    events = [
        (i, None if i % 37 == 0 else datetime(2024, 1, 1 + i % 28, i % 24, i % 60), None if i % 29 == 0 else i % 500, "view", float(i % 170), '{"k": 3}')
        for i in [*range(600), *range(200)]
    ]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    t = Tables.of(spark, str(tmp_path))
    lap = ["season", "round", "abbreviation", "lap_number"]
    for name in ("laps", "telemetry"):
        stored = bucketed(t, name)
        assert f"silver_{name}" not in t._made
        moved = t.cleaned(name, by_lap=True).repartition(t.buckets, *lap)
        plan = moved._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.index("Window") < plan.index("Exchange")
        assert rows(stored) == rows(t.cleaned(name).select(*stored.columns)) and stored.count() > 100
        assert len(stored.inputFiles()) <= t.buckets
    sums = bucketed(t, "telemetry").groupBy(*lap).agg(F.count("speed").alias("n"))
    assert "Exchange" not in sums.join(bucketed(t, "laps").hint("merge"), lap)._jdf.queryExecution().executedPlan().toString()


def test_profile_reads_new_races_only(spark, tmp_path):
    make = lambda rounds, stamp, v="x": spark.createDataFrame(
        [(2031, r, None if i % 3 == 0 else f"{v}{i % 4}", stamp) for r in rounds for i in range(12)], "season int, round int, d string, ingested_at string"
    )
    profile = Profile(spark, str(tmp_path / "p"), ["d"])
    profile.update(make([1, 2], "a"))
    table = make([1, 2, 3], "a").unionAll(make([2], "b", "y"))  # round 2 was loaded again, round 3 is new
    assert rows(profile.outdated(table), "round") == [(2,), (3,)]
    profile.update(table)
    assert rows(profile.report(["round"])) == [(1, "d", 12, 4, 4), (2, "d", 24, 8, 8), (3, "d", 12, 4, 4)]
    assert rows(profile.report()) == [("d", 48, 16, 8)] and profile.outdated(table).count() == 0


# --- streaming --------------------------------------------------------------------------------


def landed(spark, folder, batches):
    """Write each batch of (driver, seconds after 04:00, speed, stamp) as one telemetry file."""
    columns = [c.strip().split(" ")[0] for c in schemas.TELEMETRY.split(",")]
    for batch in batches:
        data = []
        for driver, second, speed, stamp in batch:
            when = pd.Timestamp("2031-07-20 04:00:00") + pd.Timedelta(seconds=second)
            row = {**BASE["telemetry"], "source": "B", "ingested_at": stamp, "driver": driver, "speed": float(speed),
                   "date": when.to_pydatetime(), "lap_number": 1 + second // 100}
            data.append(tuple(row[c] for c in columns))
        frame = spark.createDataFrame(data, schemas.TELEMETRY).coalesce(1)
        frame.write.mode("append").parquet(folder)


def run_once(query):
    query.awaitTermination(120)
    if query.exception():
        raise query.exception()


@pytest.fixture
def landing(spark, tmp_path):
    folder = str(tmp_path / "landing")
    landed(
        spark, folder,
        [[("A", s, s, STAMP) for s in range(0, 180, 20)] + [("B", 5, 1, STAMP)],
         [("A", s, s + 1, LATER) for s in range(100, 260, 20)]],
    )
    return folder


def test_stream_dedup_matches_batch_keys(spark, landing, tmp_path):
    stream = live.clean_stream(live.telemetry_stream(spark, landing, files_per_batch=1))
    run_once(
        stream.writeStream.format("memory").queryName("dedup").option("checkpointLocation", str(tmp_path / "c1"))
        .trigger(availableNow=True).start()
    )
    batch = clean_telemetry(spark.read.schema(schemas.TELEMETRY).parquet(landing))
    keys = schemas.SILVER_KEYS["telemetry"]
    assert rows(spark.table("dedup"), *keys) == rows(batch, *keys)


def test_stream_windows_match_batch(spark, landing, tmp_path):
    stream = live.window_figures(live.clean_stream(live.telemetry_stream(spark, landing)))
    run_once(
        stream.writeStream.format("memory").queryName("figures").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    )
    batch = typed_telemetry(spark.read.schema(schemas.TELEMETRY).parquet(landing))
    want = live.window_figures(batch.dropDuplicates(schemas.SILVER_KEYS["telemetry"]))
    columns = ["abbreviation", "window_start", "samples"]
    assert rows(spark.table("figures"), *columns) == rows(want, *columns)


def telemetry_table(spark, tmp_path):
    schema = typed_telemetry(spark.createDataFrame([], schemas.TELEMETRY)).schema
    return LiveTable(spark, str(tmp_path / "table"), schema, schemas.SILVER_KEYS["telemetry"])


COLUMNS = ["driver", "lap_number", "date", "speed"]


def test_stream_merge_equals_batch_clean(spark, landing, tmp_path):
    table = telemetry_table(spark, tmp_path)
    batch = clean_telemetry(spark.read.schema(schemas.TELEMETRY).parquet(landing))
    stored = []
    for attempt in (1, 2):  # the second run has lost its checkpoint and delivers everything again
        stream = typed_telemetry(live.telemetry_stream(spark, landing, files_per_batch=1))
        run_once(
            stream.writeStream.foreachBatch(table.writer("pit wall"))
            .option("checkpointLocation", str(tmp_path / f"m{attempt}")).trigger(availableNow=True).start()
        )
        assert rows(table.current(), *COLUMNS) == rows(batch, *COLUMNS)
        stored.append(table.stored().count())
    assert stored == [18, 18]
    table.merge()
    assert rows(table.current(), *COLUMNS) == rows(batch, *COLUMNS) and table.pending().count() == 0


def small_table(spark, tmp_path):
    schema = spark.createDataFrame([], "season int, round int, k int, v int").schema
    return LiveTable(spark, str(tmp_path / "many"), schema, ["season", "round", "k"], ["v"])


def batch_of(spark, *data):
    return spark.createDataFrame(list(data), "season int, round int, k int, v int").coalesce(1)


def test_cost_of_a_batch_follows_the_batch(spark, tmp_path):
    """Many small batches add small files only."""
    table = small_table(spark, tmp_path)
    add = table.writer("q")
    for number in range(6):
        add(batch_of(spark, *[(2031, 7, k, number) for k in (number, 0)]), number)
    assert len(table.stored().inputFiles()) == 6 and table.current().count() == 6
    table.merge()
    assert rows(table.current(), "k", "v") == [(0, 5), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]


def test_batches_are_stored_once_whenever_they_come_again(spark, tmp_path):
    table = small_table(spark, tmp_path)
    add, other = table.writer("a"), table.writer("b")
    first = batch_of(spark, (1, 1, 1, 10), (1, 2, 1, 10), (1, 2, 1, 9))
    for _ in range(2):
        add(first, 0)
    assert table.stored().count() == 2
    table.merge()
    add(first, 0)  # merged already: ignored
    assert table.pending().count() == 0 and table.version() == 1
    other(batch_of(spark, (1, 2, 2, 5)), 0)  # another stream counts its own batches
    add(batch_of(spark, (1, 2, 1, 11)), 1)
    want = [(1, 1, 1, 10), (1, 2, 1, 11), (1, 2, 2, 5)]
    assert rows(table.current()) == want
    for _ in range(2):  # the second merge finds nothing to do
        table.merge()
        assert rows(table.current()) == want and table.version() == 2
    # race 1 was not rewritten, race 2 was; batches of the first merge are gone, those of the second still there
    base = table._read("base", "version long").where("round = 1").select("version").distinct().collect()
    assert [r[0] for r in base] == [1] and {(r["query"], r["batch"]) for r in table.stored().collect()} == {("a", 1), ("b", 0)}


def test_batches_that_arrive_during_a_merge_stay(spark, tmp_path, monkeypatch):
    """A batch, and a reader, come between the writing of the base and the ledger."""
    table = small_table(spark, tmp_path)
    add = table.writer("a")
    add(batch_of(spark, (1, 1, 1, 1)), 0)
    replace = table._replace

    def slow(df, part, by):
        replace(df, part, by)
        if part == "base":
            monkeypatch.setattr(table, "_replace", replace)
            add(batch_of(spark, (1, 1, 2, 2), (1, 1, 1, 3)), 1)
            assert rows(table.current()) == [(1, 1, 1, 3), (1, 1, 2, 2)]

    monkeypatch.setattr(table, "_replace", slow)
    table.merge()
    assert rows(table.current()) == [(1, 1, 1, 3), (1, 1, 2, 2)] and table.pending().count() == 2
    table.merge()
    assert rows(table.current()) == [(1, 1, 1, 3), (1, 1, 2, 2)] and table.pending().count() == 0


def test_a_merge_that_dies_leaves_no_trace(spark, tmp_path, monkeypatch):
    table = small_table(spark, tmp_path)
    add = table.writer("a")
    add(batch_of(spark, (1, 1, 1, 1), (1, 2, 1, 1)), 0)
    replace = table._replace

    def dies(df, part, by):
        replace(df, part, by)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(table, "_replace", dies)
    with pytest.raises(RuntimeError):
        table.merge()
    monkeypatch.setattr(table, "_replace", replace)
    assert table.version() == 0 and rows(table.current()) == [(1, 1, 1, 1), (1, 2, 1, 1)]
    add(batch_of(spark, (1, 1, 1, 2)), 1)
    table.merge()
    assert rows(table.current()) == [(1, 1, 1, 2), (1, 2, 1, 1)]


def test_empty_live_table(spark, tmp_path):
    table = small_table(spark, tmp_path)
    table.merge()
    table.writer("a")(batch_of(spark), 0)
    table.merge()
    assert table.current().count() == 0 and table.version() == 0


def test_writers_at_once_keep_each_others_partitions(spark, database):
    """With a static default, two replacements that overlap in time touch their own partitions only."""
    table = f"{database}.two"
    sinks.replace_partitions(spark.createDataFrame([(1, r, 0) for r in range(6)], "season int, round int, v int"), table)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        with ThreadPoolExecutor(2) as jobs:
            frames = [spark.createDataFrame([(1, r, 9)], "season int, round int, v int") for r in (1, 2)]
            list(jobs.map(lambda df: sinks.replace_partitions(df, table), frames))
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "static"
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table), "round", "v") == [(0, 0), (1, 9), (2, 9), (3, 0), (4, 0), (5, 0)]


def test_stream_lap_context(spark, landing, tmp_path):
    laps = spark.createDataFrame(
        [(2031, 7, "A", 1, 1, "SOFT", 1, True)],
        "season int, round int, abbreviation string, lap_number long, stint long, compound string, tyre_life long, fresh_tyre boolean",
    )
    stream = live.with_lap_context(typed_telemetry(live.telemetry_stream(spark, landing)), laps)
    run_once(
        stream.writeStream.format("memory").queryName("context").option("checkpointLocation", str(tmp_path / "c3"))
        .trigger(availableNow=True).start()
    )
    got = spark.table("context").groupBy("abbreviation", "lap_number", "compound").agg(F.count("*").alias("n"))
    assert {(r[0], r[1], r[2]) for r in got.collect()} == {("A", 1, "SOFT"), ("A", 2, None), ("A", 3, None), ("B", 1, None)}


LAP_SCHEMA = (
    "season int, round int, abbreviation string, lap_number long, stint long, compound string, tyre_life long, fresh_tyre boolean, "
    "lap_start_date timestamp"
)


def test_late_laps_reach_their_samples(spark, tmp_path):
    """Laps that land after their samples; a lap that never comes; state that goes when the watermark has passed."""
    samples, laps = str(tmp_path / "samples"), str(tmp_path / "laps")
    spark.createDataFrame([], LAP_SCHEMA).write.parquet(laps)
    spark.createDataFrame([], schemas.TELEMETRY).write.parquet(samples)
    joined = live.with_late_laps(
        typed_telemetry(live.telemetry_stream(spark, samples)), live.lap_stream(spark, laps, LAP_SCHEMA), "60 seconds", longest="100 seconds"
    )

    def step(batch=(), lap=()):
        if batch:
            landed(spark, samples, [batch])
        if lap:
            start = pd.Timestamp("2031-07-20 04:00:00")
            data = [(2031, 7, d, n, n, c, 1, True, (start + pd.Timedelta(seconds=s)).to_pydatetime()) for d, n, s, c in lap]
            spark.createDataFrame(data, LAP_SCHEMA).coalesce(1).write.mode("append").parquet(laps)
        query = (
            joined.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "c4")).trigger(availableNow=True).start()
        )
        run_once(query)
        return sum(s.numRowsTotal for s in [*query.lastProgress.stateOperators]) if query.lastProgress else 0

    def seen():
        return rows(spark.read.parquet(str(tmp_path / "out")), "driver", "lap_number", "date", "compound")

    at = lambda s: pd.Timestamp("2031-07-20 04:00:00").to_pydatetime() + pd.Timedelta(seconds=s)
    step([("A", 10, 1, STAMP), ("A", 50, 1, STAMP), ("B", 45, 1, STAMP)], [])
    assert seen() == []  # the samples wait
    step([("A", 120, 1, STAMP)], [("A", 1, 0, "SOFT"), ("A", 1, 0, "HARD")])
    assert len(seen()) == 2 and {r[3] for r in seen()} in ({"SOFT"}, {"HARD"})  # one row of a repeated lap counts
    held = step([("A", 130, 1, STAMP)], [("A", 2, 100, "MEDIUM")])
    assert [r[:2] + r[3:] for r in seen()][2:] == [("A", 2, "MEDIUM")] * 2
    # a session later the watermark has passed everything so far: B goes out without a lap, and little is held
    left = step([("A", 5000, 1, STAMP)], [("A", 51, 5000, "SOFT")])
    assert [r for r in seen() if r[0] == "B"] == [("B", 1, at(45), None)] and left < held


def test_written_files_are_packed(spark):
    """Hex keys cost about their entropy, not a byte a digit."""
    df = spark.range(20000).select(F.md5(F.col("id").cast("string")).alias("k"))
    files = [f.removeprefix("file:") for f in written(df, "packed/keys").inputFiles()]
    assert sum(os.path.getsize(f) for f in files) < 24 * 20000


# --- races dealt out once ---------------------------------------------------------------------


@pytest.fixture
def race_tables(spark, tmp_path):
    """Tables of a folder with a few seasons of laps."""
    lines = spark.range(4000).selectExpr(
        "id as l_orderkey", "id % 90 as l_partkey", "id % 240 as l_suppkey", "cast(1 + id % 7 as int) as l_linenumber", "1.0D as l_quantity",
        "cast(100 + id as double) as l_extendedprice", "0.1D as l_discount", "0.0D as l_tax", "substr('ANR', cast(1 + id % 3 as int), 1) as l_returnflag",
        "'F' as l_linestatus", "timestamp '1995-01-05' + make_interval(0, cast(id % 12 as int)) as l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    return Tables.of(spark, str(tmp_path))


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange " in line]


def test_entries_of_races_are_made_once(race_tables):
    """Five raw tables are made from the entries of the races: their cleaning reads them by race and moves no row."""
    for name in ("results", "race_results", "driver_standings", "constructor_standings", "race_schedule"):
        cleaned = race_tables.cleaned(name)
        assert exchanges(cleaned) == [] and cleaned.count() > 0
        assert not any("lineitem" in f for f in cleaned.inputFiles())


def test_laps_move_once_and_narrow(race_tables, spark):
    """Laps are dealt out by race before they are widened; the mart joins them where they lie, however many drivers there are."""
    (moved,) = exchanges(race_tables.cleaned("laps"))
    assert "hashpartitioning(season" in moved
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = race_tables.mart("lap_times")
        plan = mart._jdf.queryExecution().executedPlan().toString()
        laps_side = plan.split("SortMergeJoin")[1].split("silver_laps")[0]
        assert "SortMergeJoin" in plan and "Exchange" not in laps_side
        # nor do those who read the mart by driver or stint
        assert exchanges(dashboards.degradation_deltas(race_tables.gold("lap_times"))) == []
        assert len(race_tables.gold("lap_times").inputFiles()) <= race_tables.buckets
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert race_tables.silver("laps").count() == race_tables.gold("lap_times").count() > 0
