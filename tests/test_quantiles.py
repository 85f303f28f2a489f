"""Percentiles against numpy."""

import numpy as np
import pandas as pd
import pytest

from lapforge.operators import quantiles
from lapforge.operators.quantiles import box_statistics, spread_percentiles

PROBS = {"p00": 0.0, "p02": 0.02, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def check(spark, pdf, *limits):
    got = spread_percentiles(spark.createDataFrame(pdf).repartition(5), ["k"], "v", PROBS, *limits)
    result = {r["k"]: r for r in got.collect()}
    groups = {k: g["v"].dropna() for k, g in pdf.groupby("k")}
    assert result.keys() == {k for k, g in groups.items() if len(g)}
    for k, row in result.items():
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(np.percentile(groups[k], p * 100), rel=1e-12, abs=1e-12), (k, name)


#: (accuracy, gathered): the defaults; a coarse sketch; closer looks until next to nothing is gathered.
LIMITS = [(), (100, 10**6), (50, 30)]


@pytest.mark.parametrize("limits", LIMITS)
def test_spread_percentiles_uniform_and_hot(spark, limits):
    rng = np.random.default_rng(1)
    keys = np.where(rng.random(3000) < 0.34, 0, rng.integers(1, 40, 3000))
    check(spark, pd.DataFrame({"k": keys, "v": rng.normal(size=3000)}), *limits)


def test_spread_percentiles_duplicates_and_outliers(spark):
    rng = np.random.default_rng(2)
    values = rng.integers(0, 5, 1000).astype(float)
    values[::250] = 1e9
    check(spark, pd.DataFrame({"k": rng.integers(0, 3, 1000), "v": values}), 100, 50)


def test_spread_percentiles_small_groups(spark):
    pdf = pd.DataFrame({"k": [1, 2, 2, 3, 3, 3, 4], "v": [7.0, 1.0, 2.0, 5.0, 5.0, 5.0, None]})
    check(spark, pdf)
    check(spark, pdf, 2, 1)


def test_box_statistics(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, None]
    df = spark.createDataFrame([(1, v) for v in values], "k int, v double")
    row = box_statistics(df, ["k"], "v").collect()[0]
    assert (row["q1"], row["median"], row["q3"]) == tuple(np.percentile(values[:-1], [25, 50, 75]))
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (1.0, 5.0, 1)


@pytest.mark.parametrize("limits", LIMITS)
def test_values_over_two_hundred_decades(spark, limits):
    """Equal steps in the logarithm: slices of equal width would leave all but one decade in the first."""
    rng = np.random.default_rng(7)
    values = 10.0 ** rng.uniform(-100, 100, 6000) * rng.choice([-1, 1], 6000)
    check(spark, pd.DataFrame({"k": rng.integers(0, 2, 6000), "v": values}), *limits)


@pytest.mark.parametrize("spread", ["id / 200000.0", "pow(10, id / 1000.0 - 100)", "if(id = 0, 1e12, id / 200000.0)"])
def test_little_is_gathered(spark, spread, monkeypatch):
    """A hot key with many distinct values: the ranges that are ranked hold a few parts in ten thousand of its rows."""
    df = spark.range(200_000).selectExpr("'k' as k", f"cast({spread} as double) as v")
    rows, probs = df.selectExpr("k", "v as __v"), {"p50": 0.5, "p95": 0.95}
    wanted = quantiles._wanted(rows, ["k"], probs, 10_000)
    inside = rows.join(wanted, "k").where("__v between __lo and __hi").groupBy("__lo", "__r").count()
    assert max(r["count"] for r in inside.collect()) <= 200_000 * 10 / 10_000
    got = spread_percentiles(df, ["k"], "v", probs).first()
    values = np.array([r[1] for r in df.collect()])
    assert (got["p50"], got["p95"]) == pytest.approx(tuple(np.percentile(values, [50, 95])))
    closer = quantiles._closer(rows, wanted, ["k"])
    inside = rows.join(closer, "k").where("__v between __lo and __hi").groupBy("__lo", "__r").count()
    assert max(r["count"] for r in inside.collect()) <= 200
