"""Decontamination: exact and changed passages, clean texts, brute force."""

import random

import numpy as np
import pytest

from lapforge.llm import op6, queries

from .test_text_basics import plain

FOLDER = "/root/testdata/sf0.01"


def test_query_against_exact_search(spark):
    got = {(r.doc_id, r.item_id): r.common for r in queries.op6_decontamination(spark, FOLDER).collect()}
    items = {r.item_id: " " + " ".join(plain(r.text)) + " " for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        text = " " + " ".join(plain(r.text)) + " "
        want |= {(r.doc_id, i) for i, t in items.items() if t in text}
    assert want and set(got) >= want and len(set(got) - want) <= 2 and all(got[w] == 1 for w in want)


def words(r, n):
    return ["".join(r.choice("aeioulnrst") for _ in range(r.randrange(2, 9))) for _ in range(n)]


def test_changed_passages(spark, monkeypatch):
    r = random.Random(4)
    bench = [(i, words(r, 20 + 2 * i)) for i in range(20)]
    docs = []
    for i, w in bench:
        filler = lambda: words(r, r.randrange(0, 300))
        few = [x if r.random() > 0.12 else words(r, 1)[0] for x in w]
        gone = [x for x in w if r.random() > 0.1]
        half = w[: len(w) // 2]
        for kind, piece in enumerate((w, few, gone, half, [x.upper() for x in w])):
            docs.append((10 * i + kind, " ".join(filler() + piece + filler())))
    docs += [(1000 + i, " ".join(words(r, 400))) for i in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in bench], "item_id long, text string")
    monkeypatch.setattr(op6, "SLICE", 8)  # several slices
    got = {(x.doc_id, x.item_id) for x in op6.leaks(d, b).collect()}
    assert {(10 * i + k, i) for i, _ in bench for k in (0, 4)} <= got
    assert sum((10 * i + k, i) in got for i, _ in bench for k in (1, 2)) >= 36
    assert not any(a >= 1000 or a % 10 == 3 or a // 10 != i for a, i in got)


def test_copies_of_many_long_items(spark):
    r = random.Random(8)
    bench = [(i, words(r, 600)) for i in range(60)]
    rich = [w for _, b in bench for w in b]
    docs = [(i, " ".join(r.sample(rich, 150) + b[120:180] + r.sample(rich, 150))) for i, b in bench]  # the third passage of ten
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in bench], "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.common for x in op6.leaks(d, b).collect()}
    assert got == {(i, i): 1.0 for i, _ in bench}


def test_short_items_among_words_of_others(spark):
    r = random.Random(9)
    bench = [(i, words(r, 3 + i % 3)) for i in range(100)]
    rich = [w for _, b in bench for w in b]
    docs = [(i, " ".join(r.sample(rich, 60) + b + r.sample(rich, 60))) for i, b in bench]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in bench], "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.common for x in op6.leaks(d, b).collect()}
    assert all(got.get((i, i)) == 1 for i, _ in bench)


@pytest.mark.parametrize("size", [256, 2])
def test_items_with_the_same_words(spark, monkeypatch, size):
    """Repeated items and variants of a question are found in small slices as well."""
    r = random.Random(10)
    first, second = words(r, 20), words(r, 20)
    bench = [(1, first), (2, first), (3, second), (4, [*second[:-1], "other"])]
    docs = [(i, " ".join(words(r, 30) + w + words(r, 30))) for i, w in enumerate([first, second])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in bench], "item_id long, text string")
    monkeypatch.setattr(op6, "SLICE", size)
    got = {(x.doc_id, x.item_id): x.cosine for x in op6.leaks(d, b).collect()}
    assert set(got) == {(0, 1), (0, 2), (1, 3), (1, 4)} and min(got.values()) > op6.COSINE


def test_subsequence_against_a_table():
    r = np.random.default_rng(0)
    for _ in range(50):
        a, b = r.integers(0, 6, r.integers(1, 70)), r.integers(0, 6, r.integers(0, 90))
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert op6._subsequence(op6._masks(a), len(a), b.tolist()) == t[-1, -1]


def test_lexicon():
    codes = np.arange(5, 4000, 7, dtype=np.uint64) << np.uint64(20)  # all in one slot at first
    lexicon = op6.Lexicon(codes[:300])
    assert (lexicon.find(codes[:400]) == np.where(np.arange(400) < 300, np.arange(400), -1)).all()


@pytest.mark.parametrize("bench", [[], [(1, None), (2, "")], [(1, "one two three four five six"), (1, "one two three four five six"), (None, "x y z")]])
def test_edge_cases(spark, bench):
    docs = [(1, None), (2, ""), (3, "zero one two three four five six seven"), (3, "zero one two three four five six seven"), (None, "one two three four five six"), (4, "w " * 50000 + "one two three four five six")]
    d = spark.createDataFrame([(*x, 9, 8) for x in docs], "doc_id long, text string, id int, item int")
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in op6.leaks(d, b).collect()}
    assert got == ({(3, 1), (4, 1)} if len(bench) == 3 else set())
    assert op6.leaks(d.limit(0), b).count() == 0
