"""How the order-dependent operators behave when the data grows and one key holds a third of it.

Rows are made by Spark; for every operator the wall-clock time at N and 2N rows
and the largest share of rows that one (key, chunk) group holds are printed.
``SCALE_ROWS`` sets N.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from lapforge.operators.asof import asof_join
from lapforge.operators.ordered import chunk_of, forward_fill, keep_last, rolling_mean
from lapforge.operators.quantiles import spread_percentiles
from lapforge.session import local_session


def samples(spark, n):
    """Session seconds at 4 samples a second per key; key 0 has a third of all rows."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.when(hot, 0).otherwise(1 + F.pmod(F.hash("id"), F.lit(500))).alias("k"),
        (F.col("id") / 4.0).alias("t"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 1.0).alias("v"),
    )


def operators(spark, n):
    df = samples(spark, n)
    chunk = chunk_of("t", n / 4.0 / 64)
    # a lap start every 90 seconds or so
    starts = df.where((F.col("t") * 4).cast("long") % 361 == 0).select("k", F.col("t").alias("s"), F.col("t").alias("lap"))
    return {
        "forward_fill": lambda: forward_fill(df, ["k"], ["t"], ["v"], chunk),
        "rolling_mean": lambda: rolling_mean(df, ["k"], ["t"], "v", "m", 3, chunk),
        "asof_join": lambda: asof_join(df, starts, ["k"], "t", "s", ["lap"], n / 4.0 / 64),
        "spread_percentiles": lambda: spread_percentiles(df, ["k"], "v", {"p50": 0.5, "p95": 0.95}),
        "keep_last": lambda: keep_last(df, ["k"], ["t"]),
    }


def main() -> None:
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), shuffle_partitions=64, name="scale")
    n = int(os.environ.get("SCALE_ROWS", "4000000"))
    out = {}
    largest = (
        samples(spark, n).groupBy("k", chunk_of("t", n / 4.0 / 64).alias("c")).count().agg(F.max("count")).first()[0]
    )
    out["largest_group_share"] = round(largest / n, 5)
    for rows in (n // 4, n, 2 * n):
        for name, make in operators(spark, rows).items():
            started = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            out.setdefault(name, {})[str(rows)] = round(time.perf_counter() - started, 2)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
