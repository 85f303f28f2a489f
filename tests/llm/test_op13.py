"""Hard negatives: brute force over all pairs, blocks, ties, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapforge.llm import op13, queries

FOLDER = "/root/testdata/sf0.01"


def brute(rows, is_anchor, positives=5, negatives=5, low=80):
    """rows: {id: (label, integer vector)}"""
    out = []
    for a in filter(is_anchor, rows):
        label, v = rows[a]
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, m == label) for i, (m, w) in rows.items() if i != a)
        for s, p, _ in [x for x in scored if x[2]][:positives]:
            fit = [(i, -t) for t, i, same in scored if not same and low * -s <= 100 * -t <= 100 * -s]
            out += [(a, p, k + 1, i, -s, t) for k, (i, t) in enumerate(fit[:negatives])]
    return sorted(out)


def test_query_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op13, "ANCHORS", 2)
    monkeypatch.setattr(op13, "ROWS", 60)
    rows = {}
    for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect():
        if r.label is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding):
            label = (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
            rows[r.vec_id] = label, [int(np.floor(256 * x)) for x in r.embedding]
    got = sorted(tuple(r) for r in queries.op13_hard_negatives(spark, FOLDER).collect())
    assert got == brute(rows, lambda i: i % 100 == 0) and got


@pytest.mark.parametrize("seed,width", [(0, 2), (1, 1), (2, 5)])
def test_ties_and_hot_vectors(spark, monkeypatch, seed, width):
    """Few distinct vectors, so most scores tie; a third of the rows are one vector and one label."""
    monkeypatch.setattr(op13, "ANCHORS", 3)
    monkeypatch.setattr(op13, "ROWS", 40)
    r = random.Random(seed)
    rows = {i: (r.randrange(3), [r.randrange(-1, 4) for _ in range(width)]) for i in range(-60, 140)}
    rows |= {i: (1, [3] * width) for i in range(140, 240)}
    data = [(i, m, [x / 256 for x in v]) for i, (m, v) in rows.items()]
    r.shuffle(data)
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>")
    got = op13.mine(df, F.col("id") % 20 == 0, positives=4, negatives=3, low=60)
    assert sorted(tuple(x) for x in got.collect()) == brute(rows, lambda i: i % 20 == 0, 4, 3, 60)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.0]), (2, 2, [1.0, 0.8]), (2, 2, [1.0, 0.8]), (3, None, [1.0, 1.0]), (4, 2, None), (5, 2, [nan, 1.0]),
        (6, 2, [None, 1.0]), (7, 2, [inf, 1.0]), (8, 2, []), (9, 2, [1.0]), (None, 2, [1.0, 1.0]), (100, 7, [0.5, 0.5]), (200, 3, [-1.0, -1.0]), (201, 3, [1.0, 1.0]),
    ]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "vec_id long, label int, embedding array<double>, score int, anchor int")
    got = sorted(tuple(r) for r in op13.mine(df, F.col("id") % 100 == 0).collect())
    # floor(256 * 0.8) = 204: row 2 scores 256 * 256 + 512 * 204; row 201 ties with the positive, 0 has one positive
    assert got == [(0, 1, 1, 201, 196608, 196608), (0, 1, 2, 2, 196608, 169984)]
    assert op13.mine(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_keys_sort_as_their_parts():
    r = random.Random(4)
    ends = [-(1 << 63), (1 << 63) - 1, -1, 0, 1]
    parts = [(r.choice(ends), r.choice(ends), r.random() < 0.5, r.choice(ends)) for _ in range(400)]
    assert [op13.unpack(op13.pack(*p)) for p in parts] == parts
    assert sorted(parts, key=lambda p: op13.pack(*p)) == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))


def test_iterator_holds_no_anchor():
    """A million negatives of one anchor pass through; only open windows are kept."""
    keys = (op13.pack(1, s, n, i) for s, n, i in [(100, False, 5), *((99 - k // 20000, True, k) for k in range(1_000_000))])
    got = list(op13.stream(((k, None) for k in keys), 5, 80))
    assert got == [(1, 5, k + 1, k, 100, 99) for k in range(5)]


def test_products_stay_exact():
    big = np.array([[1 << 40, 3], [-(1 << 40), 1]])
    assert op13.products(big, np.array([[1 << 21, 7]])).tolist() == [[(1 << 61) + 21], [7 - (1 << 61)]]
    assert op13.products(big, big).tolist() == [[op13._TOP, op13._TOP * -1 - 1], [op13._TOP * -1 - 1, op13._TOP]]
    assert op13.products(np.array([[3, -4]]), np.array([[5, 6]])).tolist() == [[-9]]
