"""Toxicity chain: held-out accuracy, out-of-fold inputs, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapforge.llm import op7, queries

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = queries.op7_toxicity_chain(spark, FOLDER).toPandas()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    both = got.merge(labels, on="doc_id")
    held = both[[op7_held(i) for i in both.doc_id]]
    assert len(got) == 1000 and held.toxic.sum() > 5
    clean = held[held.toxic == 0]
    assert (clean.predicted == 0).mean() > 0.98 and (held[held.toxic == 1].predicted == 1).mean() > 0.6


def op7_held(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 5 == 0


def test_several_fits_at_once_equal_single_fits():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 4)).astype(np.float32)
    y = (x[:, 0] + 0.3 * rng.standard_normal(300) > 0).astype(float)
    use = (rng.random((300, 2)) > 0.3).astype(np.float32)
    both = op7._logistic(x, y, use, rounds=3000)
    for f in range(2):
        one = op7._logistic(x[use[:, f] > 0], y[use[:, f] > 0], np.ones((int(use[:, f].sum()), 1), np.float32), rounds=3000)
        assert np.allclose(both[:, f], one[:, 0], atol=2e-2)
    assert both[0].min() > 1


EDGE = [(1, None), (2, ""), (3, "w " * 60000), (4, "you idiot"), (4, "you idiot"), (None, "fine day"), (5, "fine day")]


@pytest.mark.parametrize("labels", [[], [(5, 0)], [(4, 1)], [(4, 1), (5, 0), (1, 0), (2, None), (3, 5)] + [(4, 1)] * 5 + [(5, 0)] * 5])
def test_edge_cases(spark, labels):
    docs = spark.createDataFrame([(*r, 1, 2) for r in EDGE], "doc_id long, text string, toxic int, insult int")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = op7.score(docs, known, F.lit(True)).collect()
    assert len(rows) == len(EDGE) and all(0 <= r[c] <= 1 for r in rows for c in ("insult", "contempt", "toxic"))
    assert op7.score(docs.limit(0), known, F.lit(True)).count() == 0
    if len(labels) > 5:
        by_id = {r.doc_id: r.toxic for r in rows}
        assert by_id[4] > 0.5 > by_id[5]


def test_earlier_probabilities_are_out_of_fold():
    """Every row's probability is that of a model fitted without the row's fold; changing its label does not change it."""
    rng = np.random.default_rng(5)
    x = rng.random((240, 6)).astype(np.float32)
    y = (x[:, 0] + rng.normal(0, 0.4, 240) > 0.5).astype(float)
    fold = np.arange(240) % op7.FOLDS
    weights, p = op7._out_of_fold(x, y, fold)
    for f in range(op7.FOLDS):
        rest, own = fold != f, fold == f
        w = op7._logistic(x[rest], y[rest], np.ones((rest.sum(), 1), np.float32))[:, 0]
        np.testing.assert_allclose(p[own], 1 / (1 + np.exp(-(x[own] @ w[:-1] + w[-1]))), atol=1e-2)
    flipped = np.where(fold == 2, 1 - y, y)
    again = op7._out_of_fold(x, flipped, fold)
    np.testing.assert_array_equal(again[1][fold == 2], p[fold == 2])
    assert np.abs(again[0] - weights).max() > 0.05 and np.abs(again[1][fold == 1] - p[fold == 1]).max() > 0.01
