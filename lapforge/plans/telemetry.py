"""Car telemetry analyses on staged telemetry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapforge.functions import band_label, rounded
from lapforge.operators.asof import asof_join
from lapforge.operators.resample import FLAGS, LINEAR, STATES, segments, with_elapsed, with_points

RACE = ["season", "round"]
ENTRY = ["season", "round", "abbreviation"]
LAP = [*ENTRY, "lap_number"]


def assign_lap(
    samples: DataFrame,
    lap_starts: DataFrame,
    keys: Sequence[str] = ("season", "round", "driver"),
    sample_time: str = "session_time_seconds",
    start_time: str = "lap_start_time_seconds",
    chunk_seconds: float = 600.0,
) -> DataFrame:
    """Give every sample the lap that was running; ``lap_number`` becomes the last column.

    Samples of keys without any valid lap start are left out.
    """
    timed = lap_starts.where(F.col(start_time).isNotNull()).select(*keys).distinct()
    samples = samples.join(timed, list(keys), "left_semi")
    return asof_join(samples, lap_starts, list(keys), sample_time, start_time, ["lap_number"], chunk_seconds)


def driver_inventory(telemetry: DataFrame) -> DataFrame:
    """Drivers and teams with telemetry in each race, and how many samples."""
    return telemetry.groupBy(*ENTRY, "team").agg(F.count(F.lit(1)).alias("rows"))


def best_lap(telemetry: DataFrame) -> DataFrame:
    """Per driver the lap with the smallest positive lap-relative time stamp (lowest lap on ties)."""
    laps = (
        telemetry.where((F.col("lap_time_seconds") > 0) & F.col("lap_number").isNotNull())
        .groupBy(*LAP)
        .agg(F.min("lap_time_seconds").alias("lap_time"))
    )
    return _smallest(laps)


def fastest_lap(lap_times: DataFrame) -> DataFrame:
    """Per driver the lap with the smallest lap time."""
    laps = lap_times.where(F.col("lap_time_seconds").isNotNull()).select(
        *LAP, F.col("lap_time_seconds").alias("lap_time")
    )
    return _smallest(laps)


def _smallest(laps: DataFrame) -> DataFrame:
    best = F.min(F.struct("lap_time", "lap_number")).alias("__best")
    return laps.groupBy(*ENTRY).agg(best).select(*ENTRY, "__best.lap_number", "__best.lap_time")


def lap_trace(telemetry: DataFrame, laps: DataFrame | None = None) -> DataFrame:
    """Samples of the given laps (season, round, driver, lap), or of every known lap."""
    known = telemetry.where(F.col("lap_number").isNotNull())
    chosen = known if laps is None else known.join(laps.select(*LAP), LAP, "left_semi")
    return chosen.select(
        *ENTRY,
        "team",
        "lap_number",
        "distance",
        "speed",
        "throttle",
        "brake",
        "drs",
        "rpm",
        "n_gear",
        "x",
        "y",
        "z",
        "driver_ahead",
        "distance_to_driver_ahead",
        "track_status",
    )


PAIR = ["season", "round", "driver_a", "lap_a", "driver_b", "lap_b"]
CHANNELS = (*LINEAR, "brake", "drs")


def paired_traces(telemetry: DataFrame, pairs: DataFrame, columns: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """One row per pair of laps whose distances overlap: ``a`` and ``b``, the samples of either lap in order, and the
    distances that both cover.

    The pairs pick their laps first, so only those samples are moved.  A lap is bounded, so two of them fit a row.
    """
    lap_of = [
        F.struct(F.lit(side).alias("side"), F.col(f"driver_{side}").alias("abbreviation"), F.col(f"lap_{side}").alias("lap_number"))
        for side in ("a", "b")
    ]
    sides = pairs.select(*PAIR).distinct().withColumn("__lap", F.explode(F.array(*lap_of))).select(*PAIR, "__lap.*")
    samples = telemetry.where(F.col("distance").isNotNull()).select(*LAP, "distance", *dict.fromkeys([*columns, *ties]))
    own = F.struct("distance", *[F.struct(F.col(t).isNull(), F.col(t)).alias(f"__{t}") for t in ties], *columns)
    # a number of its own: a pair's row is small next to its grid, so the partitions must not be merged by size
    parts = int(telemetry.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = samples.join(sides, LAP).repartition(parts, *PAIR).groupBy(*PAIR).agg(
        *[F.sort_array(F.collect_list(F.when(F.col("side") == side, own))).alias(side) for side in ("a", "b")]
    )
    first, last = (lambda c: F.get(c, F.lit(0))["distance"]), (lambda c: F.element_at(c, -1)["distance"])
    both = both.where((F.size("a") > 0) & (F.size("b") > 0))
    span = both.withColumns({"grid_lo": F.greatest(first("a"), first("b")), "grid_hi": F.least(last("a"), last("b"))})
    return span.where(F.col("grid_lo") <= F.col("grid_hi"))


def compare_laps(
    telemetry: DataFrame,
    pairs: DataFrame,
    n: int = 700,
    channels: Sequence[str] = CHANNELS,
    ties: Sequence[str] = ("telemetry_timestamp",),
) -> DataFrame:
    """Two laps side by side on the grid that spans the distance they share, with speed and time deltas (A minus B).

    ``pairs`` has (season, round, driver_a, lap_a, driver_b, lap_b); the result has one row per pair and grid point.
    """
    names = list(dict.fromkeys([*channels, "speed"]))
    kinds = {"flags": [c for c in names if c in FLAGS], "states": [c for c in names if c in STATES]}
    kinds["linear"] = [c for c in names if c not in FLAGS and c not in STATES]
    rows = paired_traces(telemetry, pairs, names, ties)
    for side in ("a", "b"):
        rows = with_points(rows, side, f"__{side}", "grid_lo", "grid_hi", n, **kinds)
    rows = with_elapsed(rows, {"__a": "__ta", "__b": "__tb"}, n)
    # the grid is the same on both sides, so points go together by place
    points = rows.select(*PAIR, F.inline(F.arrays_zip("__a", "__b", "__ta", "__tb")))
    ordered = [*kinds["linear"], *kinds["flags"], *kinds["states"]]
    return points.select(
        *PAIR,
        "__a.grid_idx",
        "__a.distance",
        *[F.col(f"__{side}.{c}").alias(f"{c}_{side}") for c in ordered for side in ("a", "b")],
        F.col("__ta").alias("elapsed_s_a"),
        F.col("__tb").alias("elapsed_s_b"),
        (F.col("__a.speed") - F.col("__b.speed")).alias("speed_delta"),
        (F.col("__ta") - F.col("__tb")).alias("time_delta"),
    )


def delta_range(compared: DataFrame, percentile: float = 0.95) -> DataFrame:
    """Colour range of a speed-delta map: a high percentile of its absolute value per pair.

    A pair has as many values as the grid has points.
    """
    return compared.groupBy(*PAIR).agg(
        F.percentile(F.abs("speed_delta"), F.lit(percentile)).alias("abs_max")
    )


def track_segments(
    telemetry: DataFrame,
    channel: str = "speed",
    ties: Sequence[str] = ("telemetry_timestamp",),
    low: float = 0.02,
    high: float = 0.98,
    chunk_metres: float = 1000.0,
) -> DataFrame:
    """Line pieces of every lap with the channel value at their start and the lap's colour range."""
    samples = telemetry.where(F.col("lap_number").isNotNull() & F.col("distance").isNotNull())
    samples = samples.select(*LAP, "distance", "x", "y", channel, *[t for t in ties if t != channel])
    pieces = (
        segments(samples, LAP, ["x", "y"], ties=ties, chunk_metres=chunk_metres)
        .where(F.col("following").isNotNull())
        .select(
            *LAP,
            "distance",
            "x",
            "y",
            F.col("following.x").alias("next_x"),
            F.col("following.y").alias("next_y"),
            F.col(channel).cast("double").alias("value"),
        )
    )
    # a lap has a bounded number of samples
    span = samples.groupBy(*LAP).agg(F.percentile(F.col(channel).cast("double"), F.array(F.lit(low), F.lit(high))).alias("__q"))
    span = span.select(*LAP, F.get("__q", F.lit(0)).alias("value_low"), F.get("__q", F.lit(1)).alias("value_high"))
    return pieces.join(span, LAP, "left")


def braking_zones(telemetry: DataFrame) -> DataFrame:
    return telemetry.where(F.col("brake")).select(*LAP, "distance", "x", "y")


def gap_trace(telemetry: DataFrame) -> DataFrame:
    """Samples with a car ahead."""
    return telemetry.where(F.col("distance_to_driver_ahead") > 0).select(
        *LAP, "distance", "distance_to_driver_ahead"
    )


def range_share(telemetry: DataFrame, max_gap: float = 1.0, digits: int | None = 1) -> DataFrame:
    """Share of the samples of each lap that lie within ``max_gap`` of the car ahead."""
    gap = F.col("distance_to_driver_ahead")
    close = F.count_if((gap > 0) & (gap <= max_gap))
    return telemetry.groupBy(*LAP).agg(
        rounded(F.lit(100.0) * close / F.count(F.lit(1)), digits).alias("pct_within_drs_range")
    )


def speed_by_gear(telemetry: DataFrame, digits: int | None = 1) -> DataFrame:
    moving = telemetry.where((F.col("n_gear") > 0) & (F.col("speed") > 0))
    return moving.groupBy(*ENTRY, "n_gear").agg(
        rounded(F.avg("speed"), digits).alias("avg_speed"),
        rounded(F.max("speed"), digits).alias("max_speed"),
        F.count(F.lit(1)).alias("samples"),
    )


def throttle_bands(
    telemetry: DataFrame, full: float = 98, lift: float = 20, digits: int | None = 1
) -> DataFrame:
    """Share of samples at full, partial and no throttle, one row per driver and band."""
    throttle = F.col("throttle")

    def share(condition: Column) -> Column:
        return rounded(F.lit(100.0) * F.count_if(condition) / F.count(F.lit(1)), digits)

    wide = telemetry.groupBy(*ENTRY).agg(
        share(throttle >= full).alias("full_throttle_pct"),
        share((throttle >= lift) & (throttle < full)).alias("partial_throttle_pct"),
        share(throttle < lift).alias("lift_pct"),
    )
    bands = ["full_throttle_pct", "partial_throttle_pct", "lift_pct"]
    return wide.unpivot(ENTRY, bands, "band", "pct").withColumn("band", band_label("band"))
