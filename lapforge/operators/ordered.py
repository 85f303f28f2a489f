"""Order-dependent operators that stay spread out when one key is hot.

A plain window sends all rows of a key to one task.  Here every key is cut into
*chunks* of its order column (``chunk`` is any column that never decreases
along the order, such as ``floor(time / 600)``), windows run per (key, chunk),
and the little that a chunk needs from its neighbours is computed by a partial
aggregation and added to it as extra rows.  The chunk is a function of the row
alone, so a task that is run again after an executor is lost sees the same
chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "__chunk"
SIDE = "__side"
BEFORE, OWN, AFTER = 0, 1, 2


def chunk_of(order_col: str, width: float) -> Column:
    """Chunk number of a row: its order value cut into steps of ``width``."""
    return F.floor(F.col(order_col).cast("double") / F.lit(float(width))).cast("bigint")


def _ascending(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def _descending(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]


def rank_value(cols: Sequence[str]) -> Column:
    """One comparable value that sorts like ``cols`` ascending with NULLs last."""
    parts = []
    for c in cols:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.struct(*parts)


def keep_last(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """Keep the last row of every key.

    "Last" is by ``order_cols`` and then by two hashes of all other columns, so
    the result does not depend on how the input is partitioned, and a sort compares
    two numbers instead of thirty columns.  Spark applies the ``row_number = 1``
    limit before the shuffle too (WindowGroupLimit), which leaves one candidate
    per key and input task even for a hot key.
    """
    ties = [c for c in df.columns if c not in keys and c not in order_cols]
    order, helpers = _descending(order_cols), {}
    if ties:
        helpers = {"__tie": F.xxhash64(*ties), "__tie2": F.hash(*ties)}
        order += [F.col("__tie"), F.col("__tie2")]
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumns(helpers).withColumn("__rn", F.row_number().over(newest_first))
    return ranked.where(F.col("__rn") == 1).drop("__rn", *helpers)


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    chunk: Column,
    carried: Sequence[str],
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Add to every (key, chunk) copies of the rows just before and just after it.

    Copies hold only ``carried`` columns (the rest is NULL) and are marked by
    ``__side``: 0 for rows before, 2 for rows after; own rows have 1.  A row
    window of at most ``before`` preceding and ``after`` following rows over
    :func:`chunk_window` is then exact.
    """
    base = df.withColumn(CHUNK, chunk)
    out = base.withColumn(SIDE, F.lit(OWN))
    wanted = list(dict.fromkeys([*order_cols, *carried]))
    wanted = [c for c in wanted if c not in keys]
    if max(before, after) == 1:
        copies = _edge_rows(base, keys, order_cols, wanted, before, after)
        return out.unionByName(copies, allowMissingColumns=True)
    for count, side in ((before, BEFORE), (after, AFTER)):
        if count:
            copies = _edge_runs(base, keys, order_cols, wanted, count, side)
            out = out.unionByName(copies, allowMissingColumns=True)
    return out


def _along_chunks(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(F.col(CHUNK).asc_nulls_last())


def _edge_rows(
    base: DataFrame, keys: Sequence[str], order_cols: Sequence[str], wanted: Sequence[str], before: int, after: int
) -> DataFrame:
    """The last row of the chunk before and/or the first row of the chunk after, for every chunk.

    First and last rows come from one aggregation that combines before its shuffle.
    """
    rank, row = rank_value(order_cols), F.struct(*wanted)
    edges = base.groupBy(*keys, CHUNK).agg(
        *([F.max_by(row, rank).alias("__end")] if before else []),
        *([F.min_by(row, rank).alias("__start")] if after else []),
    )
    along = _along_chunks(keys)
    found = []
    if before:
        found.append(F.struct(F.lit(BEFORE).alias(SIDE), F.lag("__end").over(along).alias("row")))
    if after:
        found.append(F.struct(F.lit(AFTER).alias(SIDE), F.lead("__start").over(along).alias("row")))
    return (
        edges.withColumn("__found", F.array(*found))
        .select(*keys, CHUNK, F.explode("__found").alias("__copy"))
        .where(F.col("__copy.row").isNotNull())
        .select(*keys, CHUNK, *[F.col(f"__copy.row.{c}").alias(c) for c in wanted], f"__copy.{SIDE}")
    )


def _edge_runs(
    base: DataFrame, keys: Sequence[str], order_cols: Sequence[str], wanted: Sequence[str], count: int, side: int
) -> DataFrame:
    """The ``count`` rows just before (or after) every chunk."""
    ordering = _descending(order_cols) if side == BEFORE else _ascending(order_cols)
    place = -F.col("__rn") if side == BEFORE else F.col("__rn")
    edge = (
        base.select(*keys, CHUNK, *wanted)
        .withColumn("__rn", F.row_number().over(Window.partitionBy(*keys, CHUNK).orderBy(*ordering)))
        .where(F.col("__rn") <= count)
        # at most ``count`` rows per chunk are collected here
        .groupBy(*keys, CHUNK)
        .agg(F.sort_array(F.collect_list(F.struct(place.alias("__place"), *wanted))).alias("__rows"))
    )
    # every chunk that exists has at least one row, so ``count`` chunks suffice
    along = _along_chunks(keys)
    frame = along.rowsBetween(-count, -1) if side == BEFORE else along.rowsBetween(1, count)
    joined = F.flatten(F.collect_list("__rows").over(frame))
    skip = F.greatest(F.size(joined) - count, F.lit(0)) if side == BEFORE else F.lit(0)
    return (
        edge.withColumn("__kept", F.slice(joined, skip + 1, count))
        .select(*keys, CHUNK, F.explode("__kept").alias("__row"))
        .select(*keys, CHUNK, *[F.col(f"__row.{c}").alias(c) for c in wanted], F.lit(side).alias(SIDE))
    )


def chunk_window(keys: Sequence[str], order_cols: Sequence[str]):
    """Window over one chunk, neighbour copies first and last."""
    return Window.partitionBy(*keys, CHUNK).orderBy(SIDE, *_ascending(order_cols))


def own_rows(df: DataFrame) -> DataFrame:
    """Drop the neighbour copies and the helper columns."""
    return df.where(F.col(SIDE) == OWN).drop(SIDE, CHUNK)


def shift(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    cols: dict[str, str],
    offset: int,
    chunk: Column,
) -> DataFrame:
    """``lag`` (negative offset) or ``lead`` (positive offset): new name -> source column."""
    size = abs(offset)
    widened = with_neighbours(
        df,
        keys,
        order_cols,
        chunk,
        list(cols.values()),
        before=size if offset < 0 else 0,
        after=size if offset > 0 else 0,
    )
    w = chunk_window(keys, order_cols)
    move = F.lag if offset < 0 else F.lead
    return own_rows(widened.withColumns({new: move(src, size).over(w) for new, src in cols.items()}))


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    col: str,
    out: str,
    rows: int,
    chunk: Column,
) -> DataFrame:
    """Mean of the last ``rows`` rows; NULLs are skipped, one value is enough."""
    widened = with_neighbours(df, keys, order_cols, chunk, [col], before=rows - 1)
    w = chunk_window(keys, order_cols).rowsBetween(-(rows - 1), 0)
    return own_rows(widened.withColumn(out, F.avg(col).over(w)))


def carried_forward(
    base: DataFrame, keys: Sequence[str], order_cols: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """For every (key, chunk) one row with the last non-NULL values of all chunks before it."""
    lasts = base.groupBy(*keys, CHUNK).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), rank_value(order_cols))).alias(c) for c in cols]
    )
    earlier = _along_chunks(keys).rowsBetween(Window.unboundedPreceding, -1)
    return lasts.select(
        *keys,
        CHUNK,
        *[F.last(c, ignorenulls=True).over(earlier).alias(c) for c in cols],
        F.lit(BEFORE).alias(SIDE),
    )


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str],
    cols: Sequence[str],
    chunk: Column,
) -> DataFrame:
    """Replace NULLs by the last value before them within the key; leading NULLs stay."""
    base = df.withColumn(CHUNK, chunk)
    rows = base.withColumn(SIDE, F.lit(OWN)).unionByName(
        carried_forward(base, keys, order_cols, cols), allowMissingColumns=True
    )
    so_far = chunk_window(keys, order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in cols})
    return own_rows(filled).select(*df.columns)


def delta_from_first(
    df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], col: str, out: str
) -> DataFrame:
    """Value minus the first non-NULL value of its group.

    The first value comes from an aggregation that combines before the shuffle;
    AQE splits the join where a group is hot.
    """
    first = df.groupBy(*keys).agg(
        F.min_by(col, F.when(F.col(col).isNotNull(), rank_value(order_cols))).alias("__first")
    )
    return df.join(first, list(keys), "left").withColumn(out, F.col(col) - F.col("__first")).drop("__first")
