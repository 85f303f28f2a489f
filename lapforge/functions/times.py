"""Time helpers (Column in, Column out).  The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapforge.functions.text import ColumnOrName, as_column, numeric, strip


def ns_to_seconds(c: ColumnOrName) -> Column:
    """Integer nanoseconds -> seconds; anything that is not a number -> NULL."""
    return as_column(c).try_cast("double") / F.lit(1e9)


def ns_to_timestamp(c: ColumnOrName) -> Column:
    """Nanosecond epoch, as raw Parquet files hold it, -> timestamp."""
    return F.timestamp_micros(F.floor(as_column(c) / F.lit(1000)).cast("bigint"))


def duration_to_seconds(c: ColumnOrName) -> Column:
    """``"27.733"`` -> 27.733, ``"1:27.733"`` -> 87.733, anything else -> NULL.

    Only the first two parts of a colon-separated text count: ``"1:02:03"`` -> 62.
    """
    text = as_column(c).cast("string")
    minutes, seconds = (numeric(F.substring_index(F.substring_index(text, ":", i), ":", -1)) for i in (1, 2))
    return F.when(F.contains(text, F.lit(":")), minutes * F.lit(60.0) + seconds).otherwise(numeric(c))


def utc_timestamp(c: ColumnOrName, strict: bool = False) -> Column:
    """ISO text (``Z``, offset, ``T`` or blank form) -> timestamp.

    ``strict`` raises on bad text, otherwise bad text gives NULL.
    """
    col = as_column(c)
    return col.cast("timestamp") if strict else col.try_cast("timestamp")


def date_time(date: ColumnOrName, time: ColumnOrName) -> Column:
    """Date text plus time text -> timestamp; NULL if either is missing or bad."""
    return F.concat(strip(date), F.lit("T"), strip(time)).try_cast("timestamp")


def date_strict(c: ColumnOrName) -> Column:
    """``yyyy-MM-dd`` text -> date; bad text raises."""
    return F.to_date(as_column(c), "yyyy-MM-dd")


def time_of_day(c: ColumnOrName) -> Column:
    """``H:M:S`` text -> canonical ``HH:mm:ss`` text, NULL if it is no time of day."""
    col = as_column(c)
    parsed = F.when(
        col.rlike(r"^\d{1,2}:\d{1,2}:\d{1,2}$"), F.try_to_timestamp(col, F.lit("H:m:s"))
    )
    return F.date_format(parsed, "HH:mm:ss")


def load_stamp() -> Column:
    """Load time as ISO text in UTC."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
