"""Rule ensemble: held-out accuracy, compiled rules, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapforge.llm import op3, queries

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = queries.op3_quality_rules(spark, FOLDER).toPandas()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert len(got) == 1000 and got.score.between(0, 1).all() and (held.predicted == held.quality).mean() > 0.95


def test_compiled_rules_equal_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((400, len(op3.STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.7)).astype(float)
    rules = op3.fit(x, y)
    total = np.full(len(x), rules.intercept)
    for tests, weight in rules.rules:
        total += weight * np.all([(x[:, op3.STATISTICS.index(n)] > c) == above for n, c, above in tests], axis=0)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], list(op3.STATISTICS))
    got = np.array([r[0] for r in df.select(rules.score()).collect()])
    assert np.allclose(got, 1 / (1 + np.exp(-total)), atol=1e-9) and ((got > 0.5) == y).mean() > 0.97


EDGE = [(1, None, 0, "a"), (2, "", 1, "b"), (3, "word " * 50000, 2, "c"), (3, "word " * 50000, 2, "c"), (None, "x", 3, "d"), (4, "!!! AA\n\nAA", 4, "e")]


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 1), (2, 0), (3, None), (4, 7), (3, 1)]])
def test_edge_cases(spark, labels):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, score int, length string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got, _ = op3.score(docs, known, F.lit(True))
    rows = got.collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert op3.score(docs.limit(0), known, F.lit(True))[0].count() == 0


def test_statistics(spark):
    docs = spark.createDataFrame([("ab ab Cd.\nab ab Cd.",)], "text string")
    r = op3.statistics(docs, "text", []).first()
    assert r.distinct_words == pytest.approx(2 / 6) and r.repeats == pytest.approx(2 / 6) and r.distinct_lines == 0.5
    assert r.capitals == pytest.approx(2 / 19) and r.sentence_ends == pytest.approx(2 / 6)
