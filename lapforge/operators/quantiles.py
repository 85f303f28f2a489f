"""Exact percentiles.

``percentile`` keeps one counter per distinct value of a group, combined before
the shuffle.  That is small where values are coarse (lap times come in whole
milliseconds), however many rows a group has.  For groups with an unbounded
number of distinct values use :func:`spread_percentiles`, which never brings
more of a group together than a bounded number of values around a wanted rank.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapforge.session import written

#: Rank error of the sketch, as a share of the rows: 1 / ACCURACY.
ACCURACY = 10_000


def median(c: Column | str) -> Column:
    return F.percentile(c, F.lit(0.5))


def spread_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    accuracy: int = ACCURACY,
    gathered: int = 200_000,
) -> DataFrame:
    """Exact, interpolated percentiles per key: one output column per entry of ``probs``.

    1. A mergeable sketch per key (combined before the shuffle) gives, for every wanted rank, two values of the
       key that enclose it.  The sketch goes by rank, so it does not matter how the values are spread: a thousandth
       part of them or two hundred decades.
    2. One pass counts the rows below the enclosed range and every value within it; the shuffle is on key *and* value.
    3. The values within the range are ranked one by one.

    The enclosed range holds about six parts in ``accuracy`` of a key's rows.  Where that is more than ``gathered``, a
    sketch of the range alone encloses the rank more closely first, as often as needed; the number of rounds follows
    from the rows of the largest key.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    rows = rows.select(*keys, F.col(value).cast("double").alias("__v"))
    wanted = written(_wanted(rows, keys, probs, accuracy), f"percentiles/{uuid.uuid4().hex}")  # rows: keys x probs
    width = 6.0 / accuracy
    largest = wanted.agg(F.max("__total")).first()[0] or 0
    while largest * width > gathered and largest > accuracy:
        wanted = written(_closer(rows, wanted, keys), f"percentiles/{uuid.uuid4().hex}")
        width *= 6.0 / SLICES

    ranges = wanted.select(*keys, "__lo", "__hi").distinct()
    # all rows below a range are one group, of NULL
    inside = F.when(F.col("__v") >= F.col("__lo"), F.col("__v")).alias("__v")
    counted = rows.join(ranges, keys).where("__v <= __hi").groupBy(*keys, "__lo", "__hi", inside).agg(F.count(F.lit(1)).alias("__n"))
    along = Window.partitionBy(*keys, "__lo", "__hi").orderBy(F.col("__v").asc_nulls_first())
    ranked = counted.withColumn("__end", F.sum("__n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    picked = ranked.where("__v is not null").join(wanted, [*keys, "__lo", "__hi"])
    picked = picked.where((F.col("__r.k") < F.col("__end")) & (F.col("__r.k") >= F.col("__end") - F.col("__n")))
    return picked.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("__r.name") == name, F.col("__v") * F.col("__r.w"))).alias(name) for name in probs]
    )


#: Parts into which a closer look cuts a range.
SLICES = 1000


def _ranks(probs: Mapping[str, float]) -> Column:
    """The ranks between which each percentile lies, with their weights."""
    ranks = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("__total") - 1)
        low = F.floor(at)
        ranks.append(F.struct(F.lit(name).alias("name"), low.alias("k"), (F.lit(1.0) - (at - low)).alias("w")))
        ranks.append(F.struct(F.lit(name).alias("name"), (low + 1).alias("k"), (at - low).alias("w")))
    return F.filter(F.array(*ranks), lambda r: r["w"] > 0)


def _wanted(rows: DataFrame, keys: list[str], probs: Mapping[str, float], accuracy: int) -> DataFrame:
    """(keys, __total, __lo, __hi, __r): values that enclose every wanted rank."""
    marks = sorted({min(max(p + side * 3.0 / accuracy, 0.0), 1.0) for p in probs.values() for side in (-1, 1)})
    found = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__total"),
        F.min("__v").alias("__min"),
        F.max("__v").alias("__max"),
        F.percentile_approx("__v", F.array(*map(F.lit, marks)), F.lit(accuracy)).alias("__cuts"),
    )

    def cut(p: float, side: int, end: str) -> Column:
        mark = p + side * 3.0 / accuracy
        # a sketch of few rows is exact to less than a row, which is not enough at the ends of a range
        sure = (F.col("__total") > accuracy) & F.lit(0.0 < mark < 1.0)
        return F.when(sure, F.get("__cuts", F.lit(marks.index(min(max(mark, 0.0), 1.0))))).otherwise(F.col(end))

    place = {name: (cut(p, -1, "__min"), cut(p, 1, "__max")) for name, p in probs.items()}
    lo = F.coalesce(*[F.when(F.col("__r.name") == name, c[0]) for name, c in place.items()])
    hi = F.coalesce(*[F.when(F.col("__r.name") == name, c[1]) for name, c in place.items()])
    each = found.withColumn("__r", F.explode(_ranks(probs)))
    return each.select(*keys, "__total", lo.alias("__lo"), hi.alias("__hi"), "__r")


def _closer(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``wanted`` with every range cut to the neighbourhood of its rank, by a sketch of the rows within it."""
    marks = [i / SLICES for i in range(SLICES + 1)]
    inside = F.when(F.col("__v") >= F.col("__lo"), F.col("__v"))
    ranges = wanted.select(*keys, "__lo", "__hi").distinct()
    found = rows.join(ranges, keys).where("__v <= __hi").groupBy(*keys, "__lo", "__hi").agg(
        F.count_if(F.col("__v") < F.col("__lo")).alias("__below"),
        F.count(inside).alias("__in"),
        F.percentile_approx(inside, F.array(*map(F.lit, marks)), F.lit(ACCURACY)).alias("__cuts"),
    )
    # the slice of the rank, two more on either side; ranges of few rows stay as they are
    slice_ = F.floor((F.col("__r.k") - F.col("__below")) * F.lit(float(SLICES)) / F.col("__in")).cast("int")
    few = F.col("__in") <= ACCURACY
    lo = F.when(few | (slice_ < 3), F.col("__lo")).otherwise(F.get("__cuts", F.greatest(slice_ - 2, F.lit(0))))
    hi = F.when(few | (slice_ > SLICES - 4), F.col("__hi")).otherwise(F.get("__cuts", F.least(slice_ + 3, F.lit(SLICES))))
    joined = wanted.join(found, [*keys, "__lo", "__hi"])
    return joined.select(*keys, "__total", lo.alias("__lo_"), hi.alias("__hi_"), "__r").withColumnsRenamed({"__lo_": "__lo", "__hi_": "__hi"})


#: Fences of times in whole nanoseconds lie an eighth of a nanosecond apart; this is half of that, in seconds.
ON_FENCE = 0.0625e-9


def box_statistics(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Box-plot figures: quartiles, whiskers (last value within 1.5 IQR) and outlier count.

    ``value`` must be coarse (lap times); the join back is on the group keys and
    its right side has one row per group.  Values are whole nanoseconds, so a value that is nearer to a fence than
    ``ON_FENCE`` lies on it and is no outlier, whatever the last bit of the fence says.
    """
    keys = list(keys)
    values = df.where(F.col(value).isNotNull()).select(*keys, value)
    quartiles = values.groupBy(*keys).agg(
        F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("__q")
    ).select(
        *keys,
        F.get("__q", F.lit(0)).alias("q1"),
        F.get("__q", F.lit(1)).alias("median"),
        F.get("__q", F.lit(2)).alias("q3"),
    )
    reach = (F.col("q3") - F.col("q1")) * F.lit(1.5) + F.lit(ON_FENCE)
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        values.join(quartiles, keys)
        .groupBy(*keys)
        .agg(
            F.first("q1").alias("q1"),
            F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )
