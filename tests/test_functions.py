"""Column helpers on hand-made values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lapforge import functions as fn


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column("v")).collect()[0][0]


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("27.733", 27.733),
        ("1:27.733", 87.733),
        ("2:05.000", 125.0),
        ("28", 28.0),
        (" 28 ", 28.0),
        ("1:02:03", 62.0),
        (None, None),
        ("", None),
        ("   ", None),
        ("DNF", None),
        ("nan", None),
        ("1:", None),
        ("1:xx", None),
        ("12d", None),
    ],
)
def test_duration_to_seconds(spark, text, seconds):
    got = one(spark, fn.duration_to_seconds, text)
    assert got == (pytest.approx(seconds) if seconds is not None else None)


@pytest.mark.parametrize(
    "text, slug",
    [("  russell  ", "russell"), ("de vries", "de_vries"), ("Red Bull Racing", "red_bull_racing"),
     ("\tA  B\n", "a__b"), (None, None), ("", "")],
)
def test_slugify(spark, text, slug):
    assert one(spark, fn.slugify, text) == slug


@pytest.mark.parametrize("ns, seconds", [(96458000000, 96.458), (4986801000000, 4986.801), (0, 0.0), (None, None)])
def test_ns_to_seconds(spark, ns, seconds):
    assert one(spark, fn.ns_to_seconds, ns, "bigint") == seconds


def test_ns_to_seconds_of_text_that_is_no_number(spark):
    assert one(spark, fn.ns_to_seconds, "x") is None


@pytest.mark.parametrize("text, number", [("3", 3), ("R", None), ("", None), ("-1", None), (None, None)])
def test_digits_to_int(spark, text, number):
    assert one(spark, fn.digits_to_int, text) == number


def test_whole_number(spark):
    assert one(spark, fn.whole_number, "9") == 9
    for bad in ("x", "9d", "12f", "2.7", "inf", "", None):
        assert one(spark, fn.whole_number, bad) is None
    assert one(spark, fn.whole_number, "-3.0") == -3
    assert one(spark, fn.whole_number, 4.0, "double") == 4


@pytest.mark.parametrize("text, kept", [("", None), (" ", " "), ("x", "x"), (None, None)])
def test_blank_to_null(spark, text, kept):
    assert one(spark, fn.blank_to_null, text) == kept


@pytest.mark.parametrize(
    "text", ["2026-03-08T04:00:00Z", "2026-03-08 04:00:00", "2026-03-08T05:00:00+01:00", "2026-03-08T04:00:00+00:00"]
)
def test_utc_timestamp(spark, text):
    assert one(spark, fn.utc_timestamp, text) == dt.datetime(2026, 3, 8, 4)


def test_utc_timestamp_strictness(spark):
    assert one(spark, fn.utc_timestamp, "soon") is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|soon"):
        one(spark, lambda c: fn.utc_timestamp(c, strict=True), "soon")


def test_date_time(spark):
    df = spark.createDataFrame(
        [(" 2026-03-08", "04:00:00Z "), ("2026-03-08", None), (None, "04:00:00Z"), ("2026-03-08", "TBC")],
        "d string, t string",
    )
    got = [r[0] for r in df.select(fn.date_time("d", "t")).collect()]
    assert got == [dt.datetime(2026, 3, 8, 4), None, None, None]


@pytest.mark.parametrize("text, kept", [("15:16:40", "15:16:40"), ("25:00:00", None), ("x", None), ("1:2:3", "01:02:03"), (None, None)])
def test_time_of_day(spark, text, kept):
    assert one(spark, fn.time_of_day, text) == kept


def test_date_strict_raises(spark):
    assert one(spark, fn.date_strict, "2026-03-08") == dt.date(2026, 3, 8)
    with pytest.raises(Exception):
        one(spark, fn.date_strict, "08.03.2026")


def test_surrogate_key(spark):
    df = spark.createDataFrame([(2026, None)], "a int, b string")
    assert df.select(fn.surrogate_key("a", "b")).collect()[0][0] == "69e9363a9405be8a76a0c26ff54ac612"


@pytest.mark.parametrize(
    "camel, snake",
    [("LapNumber", "lap_number"), ("SpeedI1", "speed_i1"), ("nGear", "n_gear"), ("DRS", "drs"),
     ("FastF1Generated", "fast_f1_generated"), ("Sector1SessionTime", "sector1_session_time")],
)
def test_snake_case(camel, snake):
    assert fn.snake_case(camel) == snake


def test_snake_case_columns(spark):
    df = spark.createDataFrame([(1, 2)], "LapNumber int, DRS int")
    assert fn.snake_case_columns(df).columns == ["lap_number", "drs"]


def test_labels(spark):
    df = spark.createDataFrame([("full_throttle_pct", "SOFT"), ("lift_pct", "X"), ("a", None)], "b string, c string")
    got = df.select(fn.band_label("b"), fn.label_or("c", {"SOFT": "S"}, "?")).collect()
    assert [tuple(r) for r in got] == [("full throttle", "S"), ("lift", "?"), ("a", "?")]


def test_ns_to_timestamp(spark):
    assert one(spark, fn.ns_to_timestamp, 1_700_000_000_123_456_789, "bigint") == dt.datetime(
        2023, 11, 14, 22, 13, 20, 123456
    )


def test_load_stamp_is_iso_utc(spark):
    text = spark.range(1).select(fn.load_stamp()).collect()[0][0]
    assert dt.datetime.fromisoformat(text).utcoffset() == dt.timedelta(0)
    assert spark.range(1).select(F.lit(text).cast("timestamp")).collect()[0][0] is not None
