"""Periodic runs: brute force over all lags, the rewritten tails of the query, long and odd texts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapforge.llm import op11, queries

FOLDER = "/root/testdata/sf0.001"


def brute(words, least=6, periods=4):
    """{(start, length): smallest period} by a scan of every lag."""
    out, n = {}, len(words)
    for q in range(1, n // periods + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            s = i
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - s + q >= max(least, periods * q):
                out.setdefault((s - q, i - s + q), q)
    return sorted((s, m, q) for (s, m), q in out.items())


def rewritten(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n or doc_id is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def wanted(doc_id, text):
    words = rewritten(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = brute(words)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    docs = [d for d in docs if len(d[1] or "") < 20000] + [d for d in docs if len(d[1] or "") >= 20000][:2]
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, FOLDER).collect()}
    assert all(got[d] == wanted(d, t) for d, t in docs)
    assert sum(got[d][1] > 0 for d, _ in docs) > 5


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_short_alphabets(seed):
    """Texts over two to four words are full of runs, nested and overlapping; several texts are scanned at once."""
    r = random.Random(seed)
    texts = [[r.randrange(2 + seed % 3) for _ in range(r.randrange(0, 90))] for _ in range(60)]
    for t in texts[::3]:
        t += (t[:7] or [0, 1, 1]) * r.randrange(2, 9) + [r.randrange(3)]
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = op11.runs_of(np.array([w for t in texts for w in t]), owner)
    want, at = [], 0
    for t in texts:
        want += [(s + at, m, q) for s, m, q in brute(t)]
        at += len(t)
    assert [tuple(x) for x in got.tolist()] == want and want


@pytest.mark.parametrize("periods,least", [(3, 1), (3, 12), (5, 6)])
def test_other_limits(periods, least):
    r = random.Random(periods)
    words = [r.randrange(2) for _ in range(700)] + [0, 1, 2, 3, 4] * 6 + [9] * 40
    got = op11.runs_of(np.array(words), np.zeros(len(words), int), least, periods)
    assert [tuple(x) for x in got.tolist()] == brute(words, least, periods)
    with pytest.raises(ValueError):
        op11.runs_of(np.array(words), np.zeros(len(words), int), 6, 2)


def test_long_texts_stay_cheap():
    """One word all over, and a long period: each would cost the square of its length pair by pair."""
    n = 400_000
    assert op11.runs_of(np.zeros(n, int), np.zeros(n, int)).tolist() == [[0, n, 1]]
    words = np.tile(np.random.default_rng(0).integers(0, 50, n // 5), 5)
    assert [0, n, n // 5] in op11.runs_of(words, np.zeros(n, int)).tolist()


def test_edge_cases(spark):
    texts = [None, "", " \t\r\n", "a", "a a a a a", "a a a a a a", "A a A a a A a A", "x y " * 9, "é ß " * 4, "w " * 60000, "a b " * 3 + "a"]
    docs = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "b b b b b b b", 2), (3, "a", 1), (3, "a", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, runs int")
    got = sorted((r.doc_id is not None, r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in op11.periodic_runs(df).collect())
    want = []
    for d, t, _ in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = brute(words) if len(words) < 1000 else [(0, 60000, 1)]
        drop = {i for s, m, q in runs for i in range(s + q, s + m)}
        want.append((d is not None, d, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in drop)))
    assert got == sorted(want)
    assert op11.periodic_runs(df.limit(0)).count() == 0


def test_pieces_do_not_matter(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    rows = [r.asDict()["text"].encode() for r in docs.collect()]
    one = op11._rows([t.split() for t in rows], 6, 4)
    each = [op11._rows([t.split()], 6, 4) for t in rows]
    assert all([x for e in each for x in e[k].to_pylist()] == one[k].to_pylist() for k in range(3))


def test_rewritten_words(spark):
    docs = [(i, " ".join(f"w{j}" for j in range(i % 37))) for i in range(200)] + [(None, "a b c")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.t or "").split() for r in df.select("doc_id", op11.repeated_tail(F.col("doc_id"), F.col("text")).alias("t")).collect()}
    assert got == {d: rewritten(d, t.split()) for d, t in docs}
