"""Jaccard join: brute force over all pairs, groups of near copies, edge cases."""

import random

import pytest

from lapforge.llm import op8, queries

from .test_text_basics import plain

FOLDER = "/root/testdata/sf0.001"


def brute(docs, k=4, share=85):
    """{row number: (set size, component's smallest id)}"""
    sets = []
    for _, t in docs:
        w = plain(t)
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    up = list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= share * (len(a) + len(sets[j]) - both):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(sets[i]), least.get(top(i))) for i, (d, _) in enumerate(docs)), key=str)


def run(spark, docs, **more):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, class string, n int")
    return sorted((tuple(r) for r in op8.near_duplicates(df, **more).collect()), key=str)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op8_ngram_jaccard(spark, FOLDER).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == brute(docs)


def variants(seed, n, size, change):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(5))
    base = [word() for _ in range(size)]
    return [" ".join(word() if r.random() < change else w for w in base) for _ in range(n)]


@pytest.mark.parametrize("block", [op8.BLOCK, 4])
def test_near_copies_at_the_edge(spark, monkeypatch, block):
    """Groups in which some pairs link, some do not, and chains decide."""
    monkeypatch.setattr(op8, "BLOCK", block)
    texts = []
    for seed, (size, change) in enumerate([(8, 0.02), (30, 0.01), (60, 0.012), (120, 0.01), (400, 0.011), (1500, 0.01)]):
        texts += variants(seed, 14, size, change)
    docs = [(1000 - i, t) for i, t in enumerate(texts)]
    assert run(spark, docs) == brute(docs)


def test_edge_cases(spark):
    docs = [
        (1, None), (2, ""), (3, " \t"), (4, "a b"), (5, "A  B"), (6, "b a"), (7, "one two three four"), (7, "one two three four"),
        (None, "one two three four"), (9, "w " * 50000), (8, "w w w w w w"), (10, "one two three four five"), (11, None),
    ]
    assert run(spark, docs) == brute(docs)
    assert run(spark, docs, k=5, share=80) == brute(docs, 5, 80)
    assert op8.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_band_limits_cover_all_linking_sizes():
    low, high, differ = op8.bands(85, 3000)
    for a in range(1, 900):
        for b in range(a, a * 100 // 85 + 1):
            least = -(-85 * (a + b) // 185)  # the smallest overlap that links
            if least > a:
                continue
            band = [max(i for i in range(len(low)) if low[i] <= s) for s in (a, b)]
            assert band[1] - band[0] in (0, 1) and a + b - 2 * least <= differ[band[0]]


def test_links_through_documents_without_id(spark):
    """A and C link only through B, whose id is null; ids in bulk are null too."""
    texts = [" ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(3, 63)), " ".join(f"w{i}" for i in range(6, 66))]
    docs = [(1, texts[0]), (None, texts[1]), (2, texts[2]), (3, "quite another text of some length")]
    got = run(spark, docs, k=4, share=85)
    assert got == brute(docs) and sorted(c for _, _, c in got) == [1, 1, 1, 3]
    many = [(None, t) for t in variants(5, 40, 50, 0.01)] + [(7, "one two three four five")]
    assert run(spark, many) == brute(many)


def test_pairs_offered_stay_few(spark, monkeypatch):
    """A group of copies that nearly all link costs some pairs per class, not its pairs."""
    sizes = []
    decided = op8._decided

    def counted(offers, arrays, share):
        sizes.append(offers.count())
        return decided(offers, arrays, share)

    monkeypatch.setattr(op8, "_decided", counted)
    docs = [(i, t) for i, t in enumerate(variants(3, 160, 300, 0.004))]
    assert run(spark, docs) == brute(docs)
    assert sum(sizes) <= 5 * len(docs)


def test_arrays_only_of_classes_with_partners(spark, monkeypatch):
    """Texts that share a passage meet in tiles, but without a partner by bitmap their arrays are not stored."""
    rows = []
    arrays = op8.shingle_arrays

    def counted(docs, k):
        rows.append(docs.count())
        return arrays(docs, k)

    monkeypatch.setattr(op8, "shingle_arrays", counted)
    shared = " ".join(f"s{i}" for i in range(200))
    apart = [f"{shared} " + " ".join(f"d{n}x{i}" for i in range(120)) for n in range(20)]
    docs = list(enumerate(apart + variants(4, 3, 200, 0.003)))
    assert run(spark, docs) == brute(docs)
    assert rows == [3]
