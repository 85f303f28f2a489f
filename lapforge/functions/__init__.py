"""Column expressions: text, time and key helpers."""

from lapforge.functions.keys import surrogate_key
from lapforge.functions.text import (
    band_label,
    blank_to_null,
    digits_to_int,
    full_name,
    label_or,
    numeric,
    pair_label,
    rounded,
    slugify,
    snake_case,
    snake_case_columns,
    whole_number,
)
from lapforge.functions.times import (
    date_strict,
    date_time,
    duration_to_seconds,
    load_stamp,
    ns_to_seconds,
    ns_to_timestamp,
    time_of_day,
    utc_timestamp,
)

__all__ = [
    "band_label",
    "blank_to_null",
    "date_strict",
    "date_time",
    "digits_to_int",
    "duration_to_seconds",
    "full_name",
    "label_or",
    "load_stamp",
    "ns_to_seconds",
    "ns_to_timestamp",
    "numeric",
    "pair_label",
    "rounded",
    "slugify",
    "snake_case",
    "snake_case_columns",
    "surrogate_key",
    "time_of_day",
    "utc_timestamp",
    "whole_number",
]
