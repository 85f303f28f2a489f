"""Words, shingles, components and the shared folder."""

import random
import re

import numpy as np
import pyarrow as pa

from lapforge.llm import words as W
from lapforge.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(text):
    return WORD.findall(lowered(text))


TEXTS = [None, "", " ", "a", "A a\tB\nb\x0bC\x0cd\re", "É é ñ", "x" * 5000, " lead and trail ", "  nbsp stays", "end\x1fword"]


def some_texts(n=200, seed=1):
    r = random.Random(seed)
    return TEXTS + ["".join(r.choice("abABé \t\n.") for _ in range(r.randrange(60))) for _ in range(n)]


def test_words_equal_a_plain_split():
    texts = some_texts()
    got, codes = [], {}
    for piece in W.pieces(pa.array(texts, pa.string())):
        for i in range(piece.n):
            span = range(piece.bounds[i], piece.bounds[i + 1])
            got.append([piece.text(j) for j in span])
            for j in span:
                assert codes.setdefault(piece.text(j), piece.code[j]) == piece.code[j]
    assert got == [plain(t) for t in texts]
    assert len(set(codes.values())) == len(codes)


def test_pieces_do_not_change_the_words(monkeypatch):
    texts = some_texts()
    whole = np.concatenate([p.code for p in W.pieces(pa.array(texts, pa.string()))])
    monkeypatch.setattr(W, "PIECE", 64)
    assert (np.concatenate([p.code for p in W.pieces(pa.chunked_array([texts[:50], texts[50:]], pa.string()))]) == whole).all()


def test_shingles_count_like_tuples():
    texts = some_texts()
    for piece in W.pieces(pa.array(texts, pa.string())):
        sets, bounds = W.shingles(piece, 4)
        for i in range(piece.n):
            w = plain(texts[piece.first + i])
            want = {tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} if w else set()
            own = sets[bounds[i] : bounds[i + 1]]
            assert len(own) == len(want) and (np.diff(own.astype(object)) > 0).all()


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(100, 130)] + [(1, j) for j in range(2, 9)] + [(50, 40), (40, 60), (60, 60)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert all(got[i] == 100 for i in range(100, 131)) and all(got[j] == 1 for j in range(1, 9))
    assert {got[40], got[50], got[60]} == {40}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
