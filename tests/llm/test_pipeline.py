"""Pipeline: every stage on its own input against plain Python, and the whole run."""

import re

import pytest

import corpus_pipeline
from lapforge.llm import op2

from .test_op8 import brute
from .test_text_basics import plain

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.parked(stage(spark, out[-1], FOLDER), name))
    return out


def by_id(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "mixing"]
    assert all(s.columns == steps[0].columns for s in steps[:-1]) and all(s.count() for s in steps)


def test_quality_keeps_clean_documents(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = by_id(steps[1])
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i, q in labels.items() if q == 0) <= 0.3 * sum(q == 0 for q in labels.values()) + 1


def test_near_duplicates(steps):
    docs = [(i, r["text"]) for i, r in by_id(steps[1]).items()]
    assert set(by_id(steps[2])) == {c for _, _, c in brute(docs)}


def test_near_duplicates_of_five_words_and_four_fifths(spark):
    """Copies whose similarity is 0.80 to 0.85 go, those below 0.8 stay."""
    base = [f"w{i}" for i in range(100)]
    changed = lambda at: [f"x{i}" if i in at else w for i, w in enumerate(base)]
    docs = [(i, " ".join(w)) for i, w in enumerate([base, changed({20, 50}), changed({20, 50, 80})])]
    alone = lambda i, k, share: dict((d, c) for d, _, c in brute([docs[0], docs[i]], k, share))[i] == i
    assert not alone(1, 5, 80) and alone(1, 5, 85) and alone(2, 5, 80)
    for i, left in ((1, {0}), (2, {0, 2})):
        df = spark.createDataFrame([docs[0], docs[i]], "doc_id long, text string")
        assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, FOLDER).collect()} == left


def test_decontamination(spark, steps):
    items = [" " + " ".join(plain(r.text)) + " " for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    holds = lambda t: any(i in " " + " ".join(plain(t)) + " " for i in items)
    before, after = by_id(steps[2]), by_id(steps[3])
    assert set(after) == {i for i, r in before.items() if not holds(r["text"])}


def test_secrets(steps):
    before, after = by_id(steps[3]), by_id(steps[4])
    assert set(before) == set(after)
    for i, r in after.items():
        assert not any(re.search(rule.pattern, r["text"]) for rule in op2.BASE[1:])
        if before[i]["text"] != r["text"]:
            assert "[secret]" in r["text"] and r["n_chars"] == len(r["text"])


def test_mixing_and_run(spark, steps):
    last = by_id(steps[5])
    assert set(last) == set(by_id(steps[4])) and all(0 <= r["taken"] <= 2 * r["size"] for r in last.values())
    again = by_id(corpus_pipeline.run(spark, FOLDER))
    assert {i: r["taken"] for i, r in again.items()} == {i: r["taken"] for i, r in last.items()}


EDGE = [(1, None, "en", "s", 0), (2, "", None, "s", 0), (3, "a b c", "en", None, 5), (3, "a b c", "en", None, 5), (None, "x secret=abcdefghijklmnop", "en", "s", None)]


@pytest.mark.parametrize("n", [0, len(EDGE)])
@pytest.mark.parametrize("stage", range(5))
def test_edge_cases(spark, stage, n):
    docs = spark.createDataFrame(EDGE[:n], "doc_id long, text string, lang string, source string, n_chars int")
    name, call = corpus_pipeline.STAGES[stage]
    rows = call(spark, docs, FOLDER).collect()
    assert len(rows) <= n and (name in ("near_duplicates", "quality") or len(rows) == n)
    if n and name == "secrets":
        assert {r.text for r in rows} == {None, "", "a b c", "x [secret]"}
