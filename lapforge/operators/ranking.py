"""Row order as data: the place of every row in a total order, without bringing all rows into one task."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapforge.session import written

#: Bits of ``monotonically_increasing_id`` that count within a partition.
_WITHIN = 33


def with_order(df: DataFrame, order: Sequence[Column | str], out: str = "order_idx") -> DataFrame:
    """Add the place of each row, from 1, when sorted by ``order`` and then by all columns; names sort NULLs last.

    Rows are dealt out by ranges of the order and sorted within; a row's place is its number within its partition
    plus the sizes of the partitions before.  The sorted rows are written once, so places do not change if a task
    runs again; the driver sees one count per partition.
    """
    spark = df.sparkSession
    named = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    total = [*named, *[F.col(c).asc_nulls_last() for c in df.columns]]
    rows = df.repartitionByRange(*total).sortWithinPartitions(*total).withColumn("__id", F.monotonically_increasing_id())
    rows = written(rows, f"order/{uuid.uuid4().hex}")
    part = F.shiftright("__id", _WITHIN).cast("long")
    sizes = sorted((r["part"], r["count"]) for r in rows.groupBy(part.alias("part")).count().collect())
    before, starts = 0, []
    for number, size in sizes:
        starts += [F.lit(number).cast("long"), F.lit(before).cast("long")]
        before += size
    if not starts:
        return rows.drop("__id").withColumn(out, F.lit(0).cast("long"))
    within = F.col("__id").bitwiseAND(F.lit((1 << _WITHIN) - 1))
    return rows.withColumn(out, F.element_at(F.create_map(*starts), part) + within + 1).drop("__id").select(*df.columns, out)
