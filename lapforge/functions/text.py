"""Text and number helpers (Column in, Column out)."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

#: Plain decimal number, or infinity, as text between any white space.
NUMBER_TEXT = r"(?iU)^\s*([+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity))\s*$"
#: Column types whose values are numbers already.
NUMBER_TYPES = ("tinyint", "smallint", "int", "bigint", "double")


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Remove every kind of leading and trailing white space, not only blanks."""
    return F.regexp_replace(as_column(c), r"(?U)^\s+|\s+$", "")


def slugify(c: ColumnOrName) -> Column:
    """``"  Red Bull "`` -> ``"red_bull"``; each inner blank becomes one underscore."""
    return F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_"))


def blank_to_null(c: ColumnOrName) -> Column:
    """Empty text -> NULL; text of blanks stays."""
    return F.nullif(as_column(c), F.lit(""))


def numeric(c: ColumnOrName) -> Column:
    """Number, or NULL where the value is not one.

    The type of a column is known when a query is planned, so the choice below costs nothing: numbers are cast,
    and only text is matched, once.
    """
    value = as_column(c)
    found = F.regexp_extract(value.cast("string"), NUMBER_TEXT, 1).try_cast("double")  # no match: "", so NULL
    none = F.lit(None).cast("double")
    return F.when(F.typeof(value).isin(*NUMBER_TYPES), F.nanvl(value.try_cast("double"), none)).otherwise(found)


def whole_number(c: ColumnOrName) -> Column:
    """64-bit integer, or NULL where the value is not a whole number ("9d", "2.7" and infinity give NULL)."""
    value = numeric(c)
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def rounded(c: ColumnOrName, digits: int | None) -> Column:
    """Rounded half up, as written with ten decimals, so that the last bit of a sum does not decide; None: as it is."""
    value = as_column(c)
    if digits is None:
        return value
    return F.coalesce(F.round(value.try_cast("decimal(38,10)"), digits).cast("double"), F.round(value, digits))


def digits_to_int(c: ColumnOrName) -> Column:
    """Integer where the text has digits only ("R", "" and " 3" give NULL)."""
    col = as_column(c)
    return F.when(col.rlike(r"^[0-9]+$"), col.try_cast("int"))


def full_name(given: ColumnOrName, family: ColumnOrName) -> Column:
    return F.concat(as_column(given), F.lit(" "), as_column(family))


def pair_label(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.concat(as_column(a), F.lit(" vs "), as_column(b))


def band_label(c: ColumnOrName) -> Column:
    """``full_throttle_pct`` -> ``full throttle``."""
    without_unit = F.replace(as_column(c), F.lit("_pct"), F.lit(""))
    return F.replace(without_unit, F.lit("_"), F.lit(" "))


def label_or(c: ColumnOrName, labels: Mapping[str, str], default: Column | str | None) -> Column:
    """Look a value up in a short fixed list; unlisted values get ``default``."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), as_column(c)), fallback)


def snake_case(name: str) -> str:
    """``Sector1SessionTime`` -> ``sector1_session_time``; ``DRS`` -> ``drs``."""
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*(snake_case(name) for name in df.columns))
