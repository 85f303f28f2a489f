"""Language model: base scores by brute force, normalisation, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapforge.llm import op5, queries

from .test_text_basics import plain

FOLDER = "/root/testdata/sf0.01"


def base(docs, held):
    tokens = {i: plain(t) + ["\0end"] for i, t in docs.items()}
    counts = Counter(w for i, ws in tokens.items() if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in tokens.items()
    }


def test_query_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op5, "TOP", 500)  # so that many words take the way of the rare ones
    got = queries.op5_maxent_scores(spark, FOLDER).toPandas()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    want = base(docs, lambda i: zlib.crc32(str(i).encode()) % 7 == 2)
    for r in got.itertuples():
        n, known, total, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and r.base_score == pytest.approx(score, rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum() + 0.05 * held.n_tokens.sum() and (held.score > held.base_score).mean() > 0.9


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([("a b c a b",), ("a a d",), (None,)], "text string").withColumn("part", F.lit(0).cast("long"))
    model, counts, tokens, types = op5.train(docs)
    assert (tokens, types) == (11, 5)
    context = op5._tokens(next(iter(op5.W.pieces(op5.pa.array(["a b c a b"])))))
    p = np.exp(model.log_odds(op5._features(context)))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
    # within a class: its words by count + 1, and one place for unknown words
    own = model.classes(context, model.top.find(context.code))
    mass = np.zeros(op5.CLASSES)
    seen = {}
    for c, code in zip(own, context.code.tolist(), strict=True):
        seen[code] = c
    n = dict(zip(model.top.codes.tolist(), model.counts.tolist(), strict=True))
    d = op5._tokens(next(iter(op5.W.pieces(op5.pa.array(["d"])))))
    seen[int(d.code[0])] = int(model.classes(d, model.top.find(d.code))[0])
    for code, c in seen.items():
        mass[c] += (n[code] + 1) / 10 ** model.log_total[c]
    mass += 1 / 10**model.log_total
    assert np.allclose(mass, 1)


EDGE = [(1, None), (2, ""), (3, "w " * 60000), (4, "A a É"), (4, "A a É"), (None, "a")]


def test_edge_cases(spark):
    docs = spark.createDataFrame([(*r, 1, "z") for r in EDGE], "doc_id long, text string, score int, code string")
    rows = op5.score(docs, F.lit(False)).collect()
    assert len(rows) == 6 and {r.n_tokens for r in rows} == {1, 60001, 4, 2} and len({r.score for r in rows if r.doc_id == 4}) == 1
    nothing = op5.score(docs, F.lit(True)).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.score) for r in nothing)
    assert op5.score(docs.limit(0), F.lit(False)).count() == 0
