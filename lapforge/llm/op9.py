"""Mix sources to target weights when documents may belong to several sources.

1. Documents are counted by *membership pattern* (the sorted set of their sources): one row of totals per pattern.
2. Every source gets a target: its weight's share of ``budget`` times all words, at most ``repeats`` times the words it
   has, the excess going to the other sources by weight until none is above its limit.
3. A minimum-cost flow sends each source's target to the patterns it can draw from.  A pattern offers its words once at
   cost 1, a second time at cost 3, a third at 5: convex costs, so repetition is used last and is spread.  The network
   has one node per source and pattern, the only thing that reaches the driver; it does not grow with the documents.
4. Each pattern's quota is met by whole passes over its documents and one seeded selection: documents in the order of
   md5(seed:id) while the middle of the document lies below the rest of the quota.  The cut is found by counting words
   per leading digits of the md5 value, twice, and ordering only the documents of the one slice that holds it.

A null or empty text has size 0 and is never taken; a null source is a source of its own, last in order; repeated rows
count each; columns named like those that are added are replaced; ties of the order are broken by size (rows equal in both are interchangeable); an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .tables import WORD, parked

SEED = "mix-1"
DIGITS = 3
#: Membership patterns (some hundred bytes each) that are sent to all tasks at most.
SENT = 50_000
_NEW = ("size", "source_size", "target", "taken")


def targets(sizes: list[int], weights: list[float], budget: float = 1.5, repeats: int = 2) -> list[float]:
    """Words wanted of each source: a common level times its weight, at most ``repeats`` times its size."""
    order = sorted(range(len(sizes)), key=lambda i: (repeats * sizes[i] / weights[i], i))
    total, capped, weight = budget * sum(sizes), 0, sum(weights)
    out = [float(repeats * s) for s in sizes]
    for k, i in enumerate(order):
        level = (total - capped) / weight
        if repeats * sizes[i] >= weights[i] * level:
            for j in order[k:]:
                out[j] = weights[j] * level
            break
        capped += repeats * sizes[i]
        weight -= weights[i]
    return out


def flow(quotas: list[int], patterns: list[tuple[list[int], int]], repeats: int) -> list[list[int]]:
    """Words that each source draws from each pattern: a minimum-cost flow by successive cheapest paths.

    ``patterns`` has (sources, words).  Pass c over a pattern costs 2c + 1 per word.
    """
    n, drawn, left = len(quotas), [[0] * len(quotas) for _ in patterns], list(quotas)
    used = [0] * len(patterns)
    offers: list[list[int]] = [[] for _ in quotas]
    for p, (members, _) in enumerate(patterns):
        for s in members:
            offers[s].append(p)
    for s in range(n):
        while left[s] > 0:
            # from the source over patterns it can draw from, or that another source can leave for another pattern
            back: dict[int, tuple[int, int]] = {}
            queue, reached = deque([s]), {s}
            while queue:
                at = queue.popleft()
                for p in offers[at]:
                    if p not in back:
                        back[p] = (at, p)
                        for other in patterns[p][0]:
                            if other not in reached and drawn[p][other] > 0:
                                reached.add(other)
                                back[-1 - other] = (other, p)
                                queue.append(other)
            open_ = [p for p in back if p >= 0 and used[p] < repeats * patterns[p][1]]
            if not open_:
                break
            best = min(open_, key=lambda p: (used[p] // patterns[p][1], p))
            words = patterns[best][1]
            amount = min(left[s], words - used[best] % words)
            path, p = [], best
            while True:
                source = back[p][0]
                path.append((source, p))
                if source == s:
                    break
                p = back[-1 - source][1]
                amount = min(amount, drawn[p][source])
            for k, (source, p) in enumerate(path):
                drawn[p][source] += amount
                if k + 1 < len(path):
                    drawn[path[k + 1][1]][source] -= amount
            used[best] += amount
            left[s] -= amount
    return drawn


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sources: Column | None = None,
    weights: tuple[float, ...] = (5, 2, 1),
    budget: float = 1.5,
    repeats: int = 2,
    seed: str = SEED,
) -> DataFrame:
    """(row's columns, size, source_size, target, taken) for every row of ``docs``.

    ``sources`` is an array column (default: the one source in ``source``); ``weights`` repeat over the sources in code
    point order, null last.  ``source_size`` and ``target`` are those of the row's first source.
    """
    spark = docs.sparkSession
    pattern = F.array_sort(F.array_distinct(sources if sources is not None else F.array("source")))
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    kept = [c for c in docs.columns if c != text and c.lower() not in _NEW]
    own = F.struct(*[F.col(f"`{c}`") for c in kept])
    rows = parked(docs.select(own.alias("row"), pattern.alias("pattern"), size.alias("size"), digest.alias("digest")), "sized")

    found = rows.groupBy("pattern").agg(F.sum("size").alias("size")).collect()  # a row per membership pattern
    found.sort(key=lambda r: [(s is None, s or "") for s in r["pattern"]])
    names = sorted({s for r in found for s in r["pattern"]}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    sizes = [sum(r["size"] for r in found if s in r["pattern"]) for s in names]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], budget, repeats)
    filled = [r for r in found if r["size"] > 0]
    drawn = flow(
        [math.floor(t + 0.5) for t in wanted], [([place[s] for s in r["pattern"]], r["size"]) for r in filled], repeats
    )
    quota = {tuple(r["pattern"]): sum(d) for r, d in zip(filled, drawn, strict=True)}
    plan = []
    for r in found:
        first, q = place[r["pattern"][0]] if r["pattern"] else None, quota.get(tuple(r["pattern"]), 0)
        passes, rest = divmod(q, r["size"]) if r["size"] else (0, 0)
        plan.append(
            (r["pattern"], sizes[first] if first is not None else 0, wanted[first] if first is not None else 0.0, passes, rest)
        )
    schema = T.StructType(
        [
            T.StructField("pattern", T.ArrayType(T.StringType())),
            T.StructField("source_size", T.LongType()),
            T.StructField("target", T.DoubleType()),
            T.StructField("passes", T.LongType()),
            T.StructField("rest", T.LongType()),
        ]
    )
    key = F.to_json("pattern", {"ignoreNullFields": "false"})
    plan = spark.createDataFrame(plan, schema).withColumn("key", key).drop("pattern")
    rows = rows.withColumn("key", key)

    # both have a row per membership pattern at most; beyond SENT of them they are joined like any table
    few = F.broadcast if len(found) <= SENT else lambda frame: frame
    cut = plan.select("key", "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("before"))
    for level in (1, 2):
        # written, since what follows reads it twice: else each use plans and runs all that leads to it again
        cut = parked(_narrowed(rows, few(cut), level * DIGITS), "cut")
    cut = cut.select("key", "prefix", F.col("before").alias("base"))
    placed = rows.join(few(plan), "key").join(few(cut), "key", "left")
    lead = F.substring("digest", 1, 2 * DIGITS)
    inside = placed.where(F.col("prefix").isNotNull() & (lead == F.col("prefix")))
    sure = placed.where(F.col("prefix").isNull() | (lead != F.col("prefix")))
    order = Window.partitionBy("key").orderBy("digest", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("end", F.col("base") + F.sum("size").over(order))
    inside = inside.withColumn("more", 2 * F.col("end") - F.col("size") <= 2 * F.col("rest")).drop("end")
    sure = sure.withColumn("more", F.coalesce(lead < F.col("prefix"), F.lit(False)))
    return (
        sure.unionByName(inside)
        .withColumn("taken", F.col("size") * (F.col("passes") + F.col("more").cast("long")))
        .select("row.*", *_NEW)
    )


def _narrowed(rows: DataFrame, cut: DataFrame, digits: int) -> DataFrame:
    """The slice of each pattern in which its running word count passes ``rest``, one level of digits deeper."""
    here = rows.join(cut, "key").where(F.col("digest").startswith(F.col("prefix")))
    slices = here.groupBy("key", "rest", "before", F.substring("digest", 1, digits).alias("slice")).agg(
        F.sum("size").alias("words")
    )
    run = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = slices.withColumn("end", F.col("before") + F.sum("words").over(run)).withColumn("start", F.col("end") - F.col("words"))
    return ends.where("start <= rest and rest < end").select(
        "key", "rest", F.col("slice").alias("prefix"), F.col("start").alias("before")
    )
