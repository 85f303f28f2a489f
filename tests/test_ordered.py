"""Order-dependent operators against brute force, with chunks small enough to matter."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lapforge.operators import ordered
from lapforge.operators.asof import asof_join


def hot_frame(spark, seed, n=400):
    """One key holds a third of all rows; gaps, NULLs and an uneven order column."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.34 else rng.randrange(1, 12)
        value = None if rng.random() < 0.4 else float(rng.randrange(100))
        rows.append((key, float(rng.choice([rng.randrange(50), rng.randrange(1000)])), i, value))
    return rows, spark.createDataFrame(rows, "k int, t double, i int, v double").repartition(7)


def by_key(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


@pytest.mark.parametrize("width", [1, 100, 10000])
def test_forward_fill(spark, width):
    rows, df = hot_frame(spark, 1)
    got = ordered.forward_fill(df, ["k"], ["t", "i"], ["v"], ordered.chunk_of("t", width))
    want = {}
    for group in by_key(rows).values():
        last = None
        for r in group:
            last = r[3] if r[3] is not None else last
            want[r[2]] = last
    assert {r["i"]: r["v"] for r in got.collect()} == want


@pytest.mark.parametrize("width, size", [(1, 2), (1, 5), (7, 3), (10000, 3)])
def test_rolling_mean(spark, width, size):
    rows, df = hot_frame(spark, 2)
    got = ordered.rolling_mean(df, ["k"], ["t", "i"], "v", "m", size, ordered.chunk_of("t", width))
    want = {}
    for group in by_key(rows).values():
        for at, r in enumerate(group):
            seen = [x[3] for x in group[max(0, at - size + 1) : at + 1] if x[3] is not None]
            want[r[2]] = sum(seen) / len(seen) if seen else None
    result = {r["i"]: r["m"] for r in got.collect()}
    assert result.keys() == want.keys()
    for i, v in want.items():
        assert result[i] == (pytest.approx(v) if v is not None else None)


def test_rolling_mean_example(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([1.0, None, 4.0, 7.0])], "k int, i int, v double")
    got = ordered.rolling_mean(df, ["k"], ["i"], "v", "m", 3, ordered.chunk_of("i", 2)).orderBy("i")
    assert [r["m"] for r in got.collect()] == [1.0, 1.0, 2.5, 5.5]


@pytest.mark.parametrize("width, offset", [(1, -3), (1, 1), (7, -1), (7, 2), (10000, 1)])
def test_shift(spark, width, offset):
    rows, df = hot_frame(spark, 3)
    got = ordered.shift(df, ["k"], ["t", "i"], {"s": "i"}, offset, ordered.chunk_of("t", width))
    want = {}
    for group in by_key(rows).values():
        for at, r in enumerate(group):
            want[r[2]] = group[at + offset][2] if 0 <= at + offset < len(group) else None
    assert {r["i"]: r["s"] for r in got.collect()} == want


@pytest.mark.parametrize("width", [1, 50, 10000])
def test_asof_join(spark, width):
    rng = np.random.default_rng(5)
    left = pd.DataFrame({"t": rng.uniform(0, 500, 600).round(1), "k": rng.choice([0, 0, 1, 2], 600), "i": range(600)})
    right = pd.DataFrame({"t": rng.uniform(20, 480, 60).round(1), "k": rng.choice([0, 1, 3], 60), "lap": range(60)})
    want = pd.merge_asof(
        left.sort_values("t"), right.sort_values(["t", "lap"]), on="t", by="k", direction="backward"
    )
    got = asof_join(
        spark.createDataFrame(left), spark.createDataFrame(right), ["k"], "t", "t", ["lap"], chunk_width=width
    )
    expected = {r.i: None if pd.isna(r.lap) else int(r.lap) for r in want.itertuples()}
    assert {r["i"]: r["lap"] for r in got.collect()} == expected
    assert got.columns[-1] == "lap"


def test_asof_edges(spark):
    samples = spark.createDataFrame(
        [("A", 9.9), ("A", 10.0), ("A", 19.999), ("A", 20.0), ("A", 99.0), ("B", 15.0), ("C", 1.0)], "d string, t double"
    )
    events = spark.createDataFrame(
        [("A", 10.0, 1), ("A", 20.0, 2), ("A", 30.0, 3), ("A", None, 9), ("B", 15.0, 4), ("B", 15.0, 5)],
        "d string, s double, lap int",
    )
    got = asof_join(samples, events, ["d"], "t", "s", ["lap"], chunk_width=10)
    assert {(r["d"], r["t"]): r["lap"] for r in got.collect()} == {
        ("A", 9.9): None, ("A", 10.0): 1, ("A", 19.999): 1, ("A", 20.0): 2, ("A", 99.0): 3, ("B", 15.0): 5, ("C", 1.0): None,
    }


def test_asof_with_a_third_of_all_rows_being_copies(spark):
    copies = spark.range(0, 3000, 1, 6).selectExpr("'A' as d", "15.0d as t", "1 as copy")
    others = spark.range(0, 6000, 1, 6).selectExpr("concat('K', id % 50) as d", "id / 10.0d as t", "0 as copy")
    events = spark.range(0, 60, 1, 3).selectExpr("if(id % 3 = 0, 'A', concat('K', id % 50)) as d", "id * 10.0d as s", "id as lap")
    got = asof_join(copies.union(others), events, ["d"], "t", "s", ["lap"], chunk_width=50)
    assert got.count() == 9000
    assert {r["lap"] for r in got.where("copy = 1").select("lap").distinct().collect()} == {0}
    from lapforge.operators.asof import SALT

    plan = got._jdf.queryExecution().executedPlan().toString()
    assert SALT in plan and "Cartesian" not in plan


def test_delta_from_first(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 90.0), (1, 3, 91.0), (2, 1, None)], "s int, lap int, v double")
    got = ordered.delta_from_first(df, ["s"], ["lap"], "v", "d")
    assert {(r["s"], r["lap"]): r["d"] for r in got.collect()} == {(1, 1): None, (1, 2): 0.0, (1, 3): 1.0, (2, 1): None}


def test_keep_last_is_independent_of_partitioning(spark):
    rows = [(i % 5, i % 3, float(i % 7), None if i % 4 == 0 else f"x{i % 6}") for i in range(300)]
    results = set()
    for parts in (1, 3, 11):
        df = spark.createDataFrame(rows, "k int, o int, v double, s string").repartition(parts)
        results.add(tuple(sorted(tuple(r) for r in ordered.keep_last(df, ["k"], ["o"]).collect())))
    assert len(results) == 1
    assert len(results.pop()) == 5


def test_keep_last_treats_null_keys_as_one(spark):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2), (1, 3, 1)], "a int, b int, o int")
    assert sorted((r["a"], r["b"] or 0, r["o"]) for r in ordered.keep_last(df, ["a", "b"], ["o"]).collect()) == [
        (1, 0, 2),
        (1, 3, 1),
    ]


def test_keep_last_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = ordered.keep_last(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
