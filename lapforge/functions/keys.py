"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lapforge.functions.text import ColumnOrName, as_column

#: Fixed value: what a NULL key part reads as inside the digest.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 over the ``-``-joined text of the key columns."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(NULL_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
