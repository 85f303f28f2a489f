"""Nearest neighbours: recall and order against brute force, copies, edge cases."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lapforge.llm import op10, queries

FOLDER = "/root/testdata/sf0.01"


def brute(ids, x, queries_, k):
    out = {}
    for q in queries_:
        i = ids.index(q)
        s = sorted(((-float((x[j] * x[i]).sum()), ids[j]) for j in range(len(ids)) if j != i))
        out[q] = [(v, -d) for d, v in s[:k]]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_parts_follow_the_rows():
    assert [op10.parts_for(n) for n in (0, 1, 3, 4, 500, 2000, 51_282, 10**6, 10**12)] == [1, 1, 1, 2, 16, 32, 128, 512, 8192]


@pytest.mark.parametrize("blocks", [(op10.ROWS, op10.QUERIES), (10, 3)])
def test_query_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(op10, "ROWS", blocks[0])
    monkeypatch.setattr(op10, "QUERIES", blocks[1])
    got = lists(queries.op10_learned_partitions(spark, FOLDER))
    rows = [r for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want = brute(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    assert all(s == pytest.approx(float((x[ids.index(v)] * x[ids.index(q)]).sum()), abs=1e-12) for q in got for v, s in got[q])


def test_few_rows_copies_and_ties(spark, monkeypatch):
    """One part, so exact: a vector shared by most rows, and ties by the smaller id."""
    monkeypatch.setattr(op10, "parts_for", lambda rows: 1)
    rows = [(i, [1.0, 0.0]) for i in range(0, 60)] + [(100 + i, [0.5, float(i)]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = lists(op10.nearest(df, F.col("id") % 20 == 0))
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows])
    assert got == brute(ids, x, [0, 20, 40, 100], 20)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 1.0]), (6, []),
            (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [-1.0, 0.0]), (8, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "vec_id long, embedding array<double>, part int, score int")
    got = lists(op10.nearest(df, F.col("id") % 20 == 0))
    assert got == {0: [(20, 4.0), (8, -1.0)], 20: [(0, 4.0), (8, -2.0)]}
    assert op10.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_parts_are_balanced():
    x = np.random.default_rng(0).standard_normal((800, 8))
    own = op10.balanced_parts(x, op10.neighbour_graph(x, 10), 8)
    assert np.bincount(own, minlength=8).max() <= 111 and np.bincount(own, minlength=8).min() > 50


def test_queries_of_a_block_are_compared_together(monkeypatch):
    """A part asks numpy for one selection a block of queries, and ties, copies and products beyond all numbers keep their order."""
    calls, partition = [], np.partition
    monkeypatch.setattr(np, "partition", lambda *a, **b: calls.append(1) or partition(*a, **b))
    monkeypatch.setattr(op10, "PAIRS", 50, raising=False)
    x = np.random.default_rng(3).integers(-2, 3, (300, 4)).astype(float)
    x[7] = x[40] = 1e200
    frame = pd.DataFrame({"id": np.arange(300), "v": list(x)})
    asked = frame.iloc[:270]
    with np.errstate(over="ignore"):
        got = op10._compare((0,), asked, frame, 5)
        want = brute(list(range(300)), x, range(270), 5)
    assert {q: list(zip(r.vec_id, r.score, strict=True)) for q, r in got.groupby("query_id")} == want
    assert len(calls) <= 2
