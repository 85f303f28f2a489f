"""As-of join: the last event at or before each sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapforge.operators.ordered import (
    CHUNK,
    OWN,
    SIDE,
    carried_forward,
    chunk_of,
    chunk_window,
    own_rows,
)

SALT = "__salt"


def asof_join(
    samples: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    sample_time: str,
    event_time: str,
    values: Sequence[str],
    chunk_width: float = 600.0,
    salts: int = 8,
) -> DataFrame:
    """Give every sample the ``values`` of the last event with ``event_time <= sample_time``.

    An event at the very time of a sample counts; of events with equal times
    the one with the larger values wins; events without a time are ignored;
    samples before the first event get NULL.

    Both sides are put in one stream ordered by time and the event is filled
    forward, so each sample is moved once and no candidate pairs are built.
    ``chunk_width`` (in units of time) bounds how much of a hot key one task
    gets.  Even copies of one sample are dealt out, by the input split they come
    from; the few events are there once per salt.
    """
    keys = list(keys)
    carried = F.struct(*[F.col(v).alias(v) for v in values])
    own = [c for c in samples.columns if c not in values]
    event_rows = events.where(F.col(event_time).isNotNull()).select(
        *keys, F.col(event_time).cast("double").alias("__t"), F.lit(0).alias("__kind"), carried.alias("__event")
    )
    sample_rows = samples.select(*own, F.col(sample_time).cast("double").alias("__t"), F.lit(1).alias("__kind"))
    chunk = chunk_of("__t", chunk_width)
    # the struct itself breaks ties between events; samples have none
    order = ["__t", "__kind", "__tie"]
    event_rows = event_rows.withColumns({"__tie": F.col("__event"), CHUNK: chunk})
    sample_rows = sample_rows.withColumn(CHUNK, chunk)

    # what every chunk starts with does not depend on salts: the times that occur are enough
    times = sample_rows.select(*keys, CHUNK).distinct()
    before = carried_forward(
        event_rows.unionByName(times, allowMissingColumns=True), keys, order, ["__event"]
    )
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    stream = (
        sample_rows.withColumns({SIDE: F.lit(OWN), SALT: F.pmod(F.spark_partition_id(), F.lit(salts))})
        .unionByName(event_rows.withColumns({SIDE: F.lit(OWN), SALT: every_salt}), allowMissingColumns=True)
        .unionByName(before.withColumn(SALT, every_salt), allowMissingColumns=True)
    )
    so_far = chunk_window([*keys, SALT], order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = own_rows(stream.withColumn("__event", F.last("__event", ignorenulls=True).over(so_far)))
    return filled.where(F.col("__kind") == 1).select(*own, *[F.col(f"__event.{v}").alias(v) for v in values])
