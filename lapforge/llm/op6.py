"""Benchmark decontamination by latent semantic retrieval, decided by common subsequences.

1. *Vocabulary and document frequencies.*  The words of the benchmark passages are the terms; one pass over all
   documents counts the documents that contain each.
2. *Latent space.*  TF-IDF vectors of the benchmark passages are factored by a randomised SVD whose products
   with the matrix are summed over Spark partitions.
3. *Candidates.*  Every document is cut into blocks of ``BLOCK`` words; windows of ``SPAN`` blocks move by one block.  A
   window's latent vector is the sum of its terms' vectors, so all windows of a document come from sums of neighbouring
   blocks.  Windows whose cosine with a passage reaches ``COSINE`` are candidates; each passage is compared with each
   window in blocks, only hits are kept.  The rank is the number of passages of a slice, so nothing is truncated.
   A second key makes candidates safe whatever the cosine: of a passage's m words the decision wants ``t`` in common,
   so at least ``c`` of its ``m - t + c`` rarest ones; stretches with that many are candidates too.
4. *Decision.*  The longest common subsequence of the passage and the best stretch of text nearby that is half as long
   again, as a share of the passage.  From
   ``SURE`` on it is a leak; from ``LIKELY`` on only if the answer, the last third of the passage, is there too
   (subsequence share ``ANSWER``).

A benchmark of any size works: it is taken in slices of ``SLICE`` passages in the order of their ids, each of which is
a pass of its own, so what tasks hold is bounded.  A benchmark item longer than ``PASSAGE`` words is cut into passages,
which may lie in several slices.

Null or empty texts have no words and match nothing, nor do benchmark items without words; documents and
items without id are not used; repeated rows of a document are one result; of equal scores the smallest id of the passage counts; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W

BLOCK, SPAN, PASSAGE, SLICE = 16, 4, 64, 256
COSINE = 0.3
SURE, LIKELY, ANSWER = 0.75, 0.65, 0.7
#: Words of the stretch of text in which a passage of so many words is looked for.
STRETCH = np.arange(PASSAGE + 1) + np.arange(PASSAGE + 1) // 2 + 8
_SLOTS = 1 << 20


class Lexicon:
    """Index of known words by an open table: two array reads per word."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        size = _SLOTS
        while size < 4 * len(codes):
            size *= 2
        self.mask = np.uint64(size - 1)
        self.slots = np.full(size, -1, np.int32)
        for i, c in enumerate(codes.tolist()):
            at = c & (size - 1)
            while self.slots[at] >= 0:
                at = (at + 1) & (size - 1)
            self.slots[at] = i

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Index of each word, -1 for unknown ones."""
        out = np.full(len(codes), -1, np.int32)
        open_ = np.arange(len(codes))
        at = codes & self.mask
        while len(open_):
            got = self.slots[at]
            some = got >= 0
            open_, at, got = open_[some], at[some], got[some]
            hit = self.codes[got] == codes[open_]
            out[open_[hit]] = got[hit]
            open_, at = open_[~hit], (at[~hit] + np.uint64(1)) & self.mask
        return out


@dataclass
class Passages:
    """One slice of the benchmark: its terms and the passages as sequences of term numbers.

    Anchors by term: term t is one of passages ``anchored[first[t]:first[t + 1]]``, of which passage k needs ``needed[k]``.
    """

    items: list[int]
    sequences: list[np.ndarray]
    lexicon: Lexicon
    weight: np.ndarray | None = None
    terms: np.ndarray | None = None
    latent: np.ndarray | None = None
    first: np.ndarray | None = None
    anchored: np.ndarray | None = None
    needed: np.ndarray | None = None


def _passages(rows: list[tuple[int, str]]) -> Iterator[Passages]:
    """Slices of at most ``SLICE`` passages."""
    items, codes = [], []
    for piece in W.pieces(pa.array([t for _, t in rows], pa.large_string())):
        for i in range(piece.n):
            own = piece.code[piece.bounds[i] : piece.bounds[i + 1]]
            parts = max(1, -(-len(own) // PASSAGE))
            for part in np.array_split(own, parts):
                if len(part):
                    items.append(rows[piece.first + i][0])
                    codes.append(part)
    for at in range(0, len(codes), SLICE):
        own = codes[at : at + SLICE]
        lexicon = Lexicon(np.unique(np.concatenate(own)))
        yield Passages(items[at : at + SLICE], [lexicon.find(c) for c in own], lexicon)


def _least(m: int) -> int:
    """Fewest common words with which the decision may accept a passage of m words."""
    return max(1, math.ceil(LIKELY * m - 1e-9))


def _anchor(p: Passages, counts: np.ndarray) -> None:
    """Choose the rarest words of each passage as its anchors."""
    terms, passages, needed = [], [], []
    for k, seq in enumerate(p.sequences):
        least = _least(len(seq))
        needed.append(max(1, least // 8))
        rarest = np.unique(seq[np.argsort(counts[seq], kind="stable")[: len(seq) - least + needed[-1]]])
        terms.append(rarest)
        passages.append(np.full(len(rarest), k))
    term, passage = np.concatenate(terms), np.concatenate(passages)
    p.first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(counts)))])
    p.anchored, p.needed = passage[np.argsort(term, kind="stable")], np.array(needed)


def _anchored(p: Passages, term: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, passage, from, to): all words near enough anchors of a passage for the decision to accept it there."""
    hit = np.flatnonzero(term >= 0)
    fan = np.diff(p.first)[term[hit]]
    hit, fan = hit[fan > 0], fan[fan > 0]
    at = np.repeat(hit, fan)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(fan) - fan, fan)
    k = p.anchored[p.first[term[at]] + nth]
    text = np.searchsorted(bounds, at, side="right") - 1
    order = np.lexsort((at, k, text))
    at, k, text = at[order], k[order], text[order]
    size = STRETCH[np.array([len(s) for s in p.sequences])][k]
    # a stretch needs as many anchors: the last one it needs lies in it as well
    last = np.arange(len(at)) + p.needed[k] - 1
    far = np.minimum(last, len(at) - 1)
    use = np.flatnonzero((last < len(at)) & (text[far] == text) & (k[far] == k) & (at[far] - at < size))
    at, k, text, size = at[use], k[use], text[use], size[use]
    lo, hi = np.maximum(bounds[text], at - size), np.minimum(bounds[text + 1], at + size)
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (k[1:] != k[:-1]) | (lo[1:] > hi[:-1])]))[: len(at)]
    for a, b in zip(new.tolist(), np.append(new[1:], len(at)).tolist(), strict=False):
        yield int(text[a]), int(k[a]), int(lo[a]), int(hi[b - 1])


def _document_counts(docs: DataFrame, shared) -> np.ndarray:
    """Number of documents with each term, at the end the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value.lexicon
        counts = np.zeros(len(lexicon.codes) + 1, np.int64)
        for batch in batches:
            counts[-1] += batch.num_rows
            for piece in W.pieces(batch.column("text")):
                term = lexicon.find(piece.code)
                here = term >= 0
                pairs = np.unique(piece.owner[here] * len(counts) + term[here])
                counts[:-1] += np.bincount(pairs % len(counts), minlength=len(counts))[:-1]
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["term", "n"])

    out = np.zeros(len(shared.value.lexicon.codes) + 1, np.int64)
    summed = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for term, n in summed.toPandas().itertuples(index=False):  # a row per term of the slice
        out[term] = n
    return out


def _factors(spark: SparkSession, p: Passages) -> np.ndarray:
    """Terms by rank: right singular vectors of the TF-IDF matrix, by random projection and one power step."""
    terms, rng = len(p.weight), np.random.default_rng(7)
    width = min(len(p.items), terms)
    rows = spark.createDataFrame([(s.tolist(),) for s in p.sequences], "terms array<int>")

    def times(basis: np.ndarray) -> np.ndarray:
        """A'A basis, summed over the partitions of the passages."""
        sent = spark.sparkContext.broadcast((p.weight, basis.astype(np.float32)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weight, b = sent.value
            total = np.zeros((len(weight), b.shape[1]))
            for batch in batches:
                for seq in batch.column("terms").to_pylist():
                    t = np.array(seq)
                    row = weight[t] / max(np.linalg.norm(weight[t]), 1e-9)
                    np.add.at(total, t, np.outer(row, row @ b[t]))
            at = np.flatnonzero(np.abs(total).sum(axis=1))
            arrays = pa.FixedSizeListArray.from_arrays(pa.array(total[at].ravel()), b.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(at), arrays], ["term", "v"])

        out = np.zeros(basis.shape)
        for term, v in rows.mapInArrow(run, "term long, v array<double>").toPandas().itertuples(index=False):
            out[term] += v
        return out

    q, _ = np.linalg.qr(times(rng.standard_normal((terms, width))))
    q, _ = np.linalg.qr(times(q))
    image = times(q)
    values, turn = np.linalg.eigh(q.T @ image)
    return (q @ turn)[:, np.argsort(-values)]


def _subsequence(masks: dict[int, int], size: int, text: list[int]) -> int:
    """Length of the longest common subsequence, 64 and more positions at once in the bits of one integer."""
    full = (1 << size) - 1
    rows = full
    for term in text:
        m = masks.get(term)
        if m is not None:
            u = rows & m
            rows = ((rows + u) | (rows - u)) & full
    return size - rows.bit_count()


def _masks(seq: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, term in enumerate(seq.tolist()):
        out[term] = out.get(term, 0) | (1 << i)
    return out


def _held(passage: tuple[dict[int, int], int], end: tuple[dict[int, int], int], text: list[int]) -> tuple[float, float]:
    """Shares of the passage and of its end in the best stretch of the text about half as long again as the passage."""
    masks, m = passage
    best = _subsequence(masks, m, text)
    if best < LIKELY * m:
        return best / m, 0.0
    best, size = 0, int(STRETCH[m])
    stretch = text
    for start in range(0, max(1, len(text) - size + max(1, m // 4)), max(1, m // 4)):
        common = _subsequence(masks, m, text[start : start + size])
        if common > best:
            best, stretch = common, text[start : start + size]
    return best / m, _subsequence(end[0], end[1], stretch) / end[1]


def _matches(docs: DataFrame, shared) -> DataFrame:
    """(id, item, cosine, common, answer) of every document and passage that the decision accepts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Passages = shared.value
        whole = [(_masks(s), len(s)) for s in p.sequences]
        tails = [s[len(s) - max(1, len(s) // 3) :] for s in p.sequences]
        ends = [(_masks(s), len(s)) for s in tails]
        squared = p.weight**2
        member = np.zeros((len(whole), len(squared) + 1), bool)  # the last column stands for unknown words
        for i, s in enumerate(p.sequences):
            member[i, s] = True
        for batch in batches:
            ids = batch.column("id")
            found: list[tuple] = []
            for piece in W.pieces(batch.column("text")):
                if not len(piece.code):
                    continue
                term = p.lexicon.find(piece.code)
                owner = piece.owner
                # blocks start anew with every text, SPAN - 1 empty ones keep windows of two texts apart
                sizes = np.diff(piece.bounds)
                blocks = -(-sizes // BLOCK) + SPAN - 1
                base = np.concatenate([[0], np.cumsum(blocks)])
                block = base[owner] + (np.arange(len(term)) - piece.bounds[owner]) // BLOCK
                use = np.flatnonzero(term >= 0)
                if not len(use):
                    continue
                pair = np.unique(block[use] * len(squared) + term[use])
                in_block, t = pair // len(squared), pair % len(squared)
                at = np.flatnonzero(np.concatenate([[True], in_block[1:] != in_block[:-1]]))
                n = int(base[-1])
                vector = np.zeros((n + SPAN, p.terms.shape[1]), np.float32)
                norm = np.zeros(n + SPAN)
                vector[in_block[at]] = np.add.reduceat(p.terms[t], at, axis=0)
                norm[in_block[at]] = np.add.reduceat(squared[t], at)
                window = sum(vector[j : n + j] for j in range(SPAN))
                size = np.sqrt(sum(norm[j : n + j] for j in range(SPAN)))
                rows = np.flatnonzero(size > 0)
                whole_in: set[tuple[int, int]] = set()
                for part in np.array_split(rows, max(1, len(rows) // 4096)):
                    cosine = (window[part] @ p.latent.T) / size[part, None]
                    w, k = np.nonzero(cosine >= COSINE)
                    if not len(w):
                        continue
                    at_block = part[w]
                    doc = np.searchsorted(base, at_block, side="right") - 1
                    order = np.lexsort((at_block, k, doc))
                    done: dict[tuple[int, int], int] = {}
                    for j in order.tolist():
                        d, item = int(doc[j]), int(k[j])
                        # the window, half of one on either side
                        a = piece.bounds[d] + (int(at_block[j]) - base[d]) * BLOCK
                        lo, hi = max(piece.bounds[d], a - 2 * BLOCK), min(piece.bounds[d + 1], a + (SPAN + 2) * BLOCK)
                        if done.get((d, item), -1) >= a + SPAN * BLOCK:
                            continue  # inside what was read for the window before
                        done[(d, item)] = hi
                        text = term[lo:hi].tolist()
                        common, answer = _held(whole[item], ends[item], text)
                        if common >= SURE or (common >= LIKELY and answer >= ANSWER):
                            found.append((ids[piece.first + d].as_py(), p.items[item], float(cosine[w[j], k[j]]), common, answer))
                            if common == 1:
                                whole_in.add((d, item))
                for d, item, lo, hi in _anchored(p, term, piece.bounds):
                    words = term[lo:hi]
                    m = whole[item][1]
                    inside = np.concatenate([[0], np.cumsum(member[item][words])])
                    most = np.max(inside[STRETCH[m] :] - inside[: -STRETCH[m]], initial=0) if len(words) > STRETCH[m] else inside[-1]
                    if (d, item) in whole_in or most < _least(m):
                        continue
                    common, answer = _held(whole[item], ends[item], words.tolist())
                    if common >= SURE or (common >= LIKELY and answer >= ANSWER):
                        near = base[d] + np.arange(max(0, (lo - piece.bounds[d]) // BLOCK - SPAN + 1), (hi - 1 - piece.bounds[d]) // BLOCK + 1)
                        cosine = float(np.max(window[near] @ p.latent[item] / np.maximum(size[near], 1e-9)))
                        found.append((ids[piece.first + d].as_py(), p.items[item], cosine, common, answer))
            columns = list(zip(*found, strict=True)) if found else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "item", "cosine", "common", "answer"]
            )

    return docs.select("id", "text").mapInArrow(run, "id long, item long, cosine double, common double, answer double")


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, cosine, common, answer): the benchmark items that each document holds."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")
    bench = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    out = spark.createDataFrame([], "id long, item long, cosine double, common double, answer double")
    last = None
    while True:
        rest = bench if last is None else bench.where((F.col("id") > last[0]) | ((F.col("id") == last[0]) & (F.col("text") > last[1])))
        rows = [tuple(r) for r in rest.dropDuplicates().orderBy("id", "text").limit(SLICE).collect()]  # a bounded slice
        if not rows:
            break
        last = rows[-1]
        for passages in _passages(rows):
            out = out.unionByName(_slice_leaks(spark, docs, passages))
        if len(rows) < SLICE:
            break
    best = out.groupBy("id", "item").agg(F.max(F.struct("common", "answer", "cosine")).alias("x"))
    return best.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "x.cosine", "x.common", "x.answer"
    )


def _slice_leaks(spark: SparkSession, docs: DataFrame, p: Passages) -> DataFrame:
    send = spark.sparkContext.broadcast
    counts = _document_counts(docs, send(p))
    idf = np.log((counts[-1] + 1) / (counts[:-1] + 1)) + 1e-3
    p.weight = idf  # of the documents alone: the same in every slice, and never 0
    _anchor(p, counts[:-1])
    basis = _factors(spark, p)
    p.terms = (p.weight[:, None] * basis).astype(np.float32)
    latent = np.stack([p.terms[np.unique(s)].sum(axis=0) for s in p.sequences])
    size = np.array([np.linalg.norm(p.weight[np.unique(s)]) for s in p.sequences])
    p.latent = (latent / np.maximum(size, 1e-9)[:, None]).astype(np.float32)
    return _matches(docs, send(p))
