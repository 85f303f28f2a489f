"""Mixing: SQL, flows with overlapping sources, targets."""

import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lapforge.llm import op9, queries, sql


def compare(spark, folder):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    want = con.execute(f"select {', '.join(columns)} from ({sql.mixing()})").fetchall()
    got = queries.op9_mixture(spark, folder).select(columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    return got.toPandas()


def test_query_equals_sql(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, " ".join("w" * r.randrange(1, 3) for _ in range(r.choice((0, 1, 5, 40, 300)))), f"s{min(r.randrange(12), 5)}", 1) for i in range(600)]
    rows += [(None, "a b", None, 1), (1000, None, None, 1), (1001, "", "Z", 1), (1, "dup dup", "é", 1), (1, "dup dup", "é", 1), (1002, "w " * 20000, "s1", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, size int").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = compare(spark, tmp_path)
    assert (got.taken <= 2 * got["size"]).all()
    for (size, target), part in got.groupby(["source_size", "target"]):
        assert abs(part.taken.sum() - target) <= part["size"].max() + 1 and part["size"].sum() % max(size, 1) == 0


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op9_mixture(spark, str(tmp_path)).count() == 0


def test_overlapping_sources(spark):
    words = "w " * 10
    rows = [(i, words, ["a"] if i < 20 else ["a", "b"] if i < 60 else ["b", None]) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    got = op9.mix(docs, sources=F.col("sources"), weights=(1, 1, 1), budget=0.5).toPandas()
    # sources hold 600, 800 and 400 words; 900 are shared evenly, from 1000 documents' words
    assert abs(got.taken.sum() - 900) <= 30 and got.taken.max() == 10


def test_the_result_does_not_plan_the_search_for_the_cut_again(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 9), f"s{i % 3}") for i in range(90)], "doc_id long, text string, source string")
    plan = op9.mix(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Aggregate" not in plan


def test_targets():
    assert op9.targets([10, 10], [1, 1]) == [15, 15]
    assert op9.targets([1000, 10, 10], [1, 5, 5]) == pytest.approx([1490, 20, 20])
    assert op9.targets([0, 0], [5, 2]) == [0, 0] and op9.targets([], []) == []
    t = op9.targets([100, 7, 50, 3], [5, 2, 1, 5])
    assert sum(t) == pytest.approx(240) and all(x <= 2 * s for x, s in zip(t, [100, 7, 50, 3], strict=True))


def test_flow_is_a_cheapest_one():
    r = random.Random(5)
    for _ in range(40):
        patterns = [(sorted(r.sample(range(3), r.randrange(1, 4))), r.randrange(1, 4)) for _ in range(3)]
        quotas = [r.randrange(0, 4) for _ in range(3)]
        drawn = op9.flow(quotas, patterns, 2)
        used = [sum(d) for d in drawn]
        assert all(u <= 2 * w for u, (_, w) in zip(used, patterns, strict=True))
        assert all(drawn[p][s] == 0 or s in patterns[p][0] for p in range(3) for s in range(3))
        assert all(sum(drawn[p][s] for p in range(3)) <= quotas[s] for s in range(3))
        cost = lambda u: sum(min(x, w) + 3 * max(0, x - w) for x, (_, w) in zip(u, patterns, strict=True))
        best = None
        for u in itertools.product(*[range(2 * w + 1) for _, w in patterns]):
            if sum(u) == sum(used) and feasible(u, patterns, quotas):
                best = min(cost(u), best if best is not None else 10**9)
            assert sum(u) <= sum(used) or not feasible(u, patterns, quotas)
        assert cost(used) == best


def feasible(u, patterns, quotas):
    """Hall's condition: every set of patterns can be served by the quotas of their sources."""
    for k in range(1, 8):
        chosen = [i for i in range(3) if k >> i & 1]
        sources = set().union(*(patterns[i][0] for i in chosen))
        if sum(u[i] for i in chosen) > sum(quotas[s] for s in sources):
            return False
    return True
