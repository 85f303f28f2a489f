"""Log probabilities of texts under a hashed maximum-entropy model with class-factored softmax.

``P(word | context) = P(class | context) * P(word | class)``.

*Counts.*  One pass over the training texts counts every word (and one end per text) and the neighbours of word endings.
*Classes.*  The ``SINGLES`` most frequent tokens are classes of their own; all other words belong to the cluster
of their ending (last three bytes, hashed to ``ENDINGS``), endings being clustered by what stands beside them.
``P(word | class)`` is the add-one estimate within the class, with one more place for unknown words.
*Maximum entropy.*  ``P(class | context)`` is a softmax over weights of three hashed features: the previous word, the word
before it (a skip), and both together.  Training takes ``ROUNDS`` gradient updates; each uses another part of the
training texts, so that together they cover all of them.  Tasks sum gradient and curvature over their texts, Spark adds
them up, the weights (a fixed number) are updated and sent out again.
*Scoring.*  Words beyond the (at most) ``TOP`` most frequent are looked up by a join: a text names each of its rare words once.

Words are compared by 64-bit hashes of their lowered bytes; two of the 10**7 words of a corpus share one with a
probability below 10**-5, and the effect would be one wrong count.

A null or empty text is one end token; repeated rows count and are scored each; documents without id belong to fold 0;
without training texts all probabilities are those of an empty count; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .op6 import Lexicon
from .tables import parked

TOP, SINGLES, CLUSTERS, ENDINGS = 1 << 16, 12, 20, 256
BINS, ROUNDS = 2048, 4
CLASSES = SINGLES + CLUSTERS
END = np.uint64(0xE0D0E0D0E0D0E0D1)
_START = (np.uint64(0x51A275), np.uint64(0x51A276))


@dataclass
class Tokens:
    """Codes of a piece with an end after each text, their endings, the two codes before each, and each text's first index."""

    code: np.ndarray
    ending: np.ndarray
    before: np.ndarray
    skip: np.ndarray
    first: np.ndarray


def _tokens(piece: W.Words) -> Tokens:
    size = np.diff(piece.bounds) + 1
    last = np.cumsum(size) - 1
    first = last - size + 1
    total = int(size.sum())
    is_end = np.zeros(total, bool)
    is_end[last] = True
    code = np.full(total, END)
    code[~is_end] = piece.code
    ending = np.zeros(total, np.uint64)
    if len(piece.code):
        lower = np.arange(256, dtype=np.uint64)
        lower[65:91] += np.uint64(32)
        tail = np.zeros(len(piece.code), np.uint64)
        for back in (1, 2, 3):
            at = piece.end - back
            byte = np.where(at >= piece.start, lower[piece.data[np.maximum(at, 0)]], np.uint64(0))
            tail = tail * np.uint64(256) + byte
        ending[~is_end] = W.mix(tail) & np.uint64(ENDINGS - 1)
    before, skip = np.empty_like(code), np.empty_like(code)
    before[1:], skip[2:] = code[:-1], code[:-2]
    second = first[size > 1] + 1
    before[first], skip[first], skip[second] = _START[0], _START[1], _START[0]
    return Tokens(code, ending.astype(np.int64), before, skip, first)


def _features(t: Tokens) -> list[np.ndarray]:
    low = np.uint64(BINS - 1)
    both = W.mix(t.before * np.uint64(0x9E3779B97F4A7C15) + t.skip)
    return [
        (W.mix(t.before) & low).astype(np.int64),
        (W.mix(t.skip + np.uint64(1)) & low).astype(np.int64) + BINS,
        (both & low).astype(np.int64) + 2 * BINS,
    ]


def token_counts(docs: DataFrame) -> DataFrame:
    """(code, ending, n) of all tokens of ``docs`` (text), and (left * ENDINGS + right, -1, n) of neighbouring endings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(ENDINGS * ENDINGS, np.int64)
        for batch in batches:
            parts = []
            for piece in W.pieces(batch.column("text")):
                t = _tokens(piece)
                codes, at, n = np.unique(t.code, return_index=True, return_counts=True)
                parts.append((codes, np.where(codes == END, 0, t.ending[at]), n))
                inner = (t.code[1:] != END) & (t.code[:-1] != END)
                pairs += np.bincount(t.ending[:-1][inner] * ENDINGS + t.ending[1:][inner], minlength=len(pairs))
            if parts:
                codes, ending, n = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.argsort(codes, kind="stable")
                codes, ending, n = codes[order], ending[order], n[order]
                at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
                yield _batch(W.signed(codes[at]), ending[at], np.add.reduceat(n, at))
        at = np.flatnonzero(pairs)
        yield _batch(at, np.full(len(at), -1), pairs[at])

    def _batch(code, ending, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(ending.astype(np.int32)), pa.array(n)], ["code", "ending", "n"])

    return docs.select("text").mapInArrow(run, "code long, ending int, n long").groupBy("code", "ending").agg(F.sum("n").alias("n"))


def _clusters(pairs: np.ndarray, k: int) -> np.ndarray:
    """Cluster of each ending, by the endings found left and right of it: k-means on a reduced log-ratio matrix."""
    both = np.concatenate([pairs, pairs.T], axis=1).astype(float)
    row, col, total = both.sum(1, keepdims=True), both.sum(0, keepdims=True), max(both.sum(), 1.0)
    ratio = np.log1p(np.maximum(both * total / np.maximum(row * col, 1e-9) - 0, 0)) - np.log(2)
    ratio[row[:, 0] == 0] = 0
    u, s, _ = np.linalg.svd(ratio * np.sqrt(row / total), full_matrices=False)
    x = (u * s)[:, :12] / np.maximum(np.sqrt(row / total), 1e-9)
    weight = row[:, 0] / total
    chosen = [int(np.argmax(weight))]
    for _ in range(k - 1):  # farthest by weight times squared distance
        far = np.min(((x[:, None] - x[chosen][None]) ** 2).sum(2), axis=1) * weight
        chosen.append(int(np.argmax(far)))
    centres = x[chosen]
    for _ in range(30):
        own = np.argmin(((x[:, None] - centres[None]) ** 2).sum(2), axis=1)
        for c in range(k):
            if weight[own == c].sum() > 0:
                centres[c] = np.average(x[own == c], axis=0, weights=weight[own == c])
    return own


@dataclass
class Model:
    """What a task needs: the frequent words with counts and classes, class totals, and the weights."""

    top: Lexicon
    counts: np.ndarray
    single: np.ndarray
    cluster: np.ndarray
    log_total: np.ndarray
    bias: np.ndarray
    weights: np.ndarray

    def classes(self, t: Tokens, place: np.ndarray) -> np.ndarray:
        own = self.cluster[t.ending] + SINGLES
        known = place >= 0
        own[known] = np.where(self.single[place[known]] >= 0, self.single[place[known]], own[known])
        return own

    def log_odds(self, features: list[np.ndarray]) -> np.ndarray:
        """Natural logarithm of the class probabilities of each token's context."""
        z = self.weights[features[0]]
        z += self.weights[features[1]]
        z += self.weights[features[2]]
        z += self.bias
        z -= z.max(axis=1, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        return z


def _gradient(docs: DataFrame, shared) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all tokens of (observed - expected) and of a curvature, per feature bin and class."""
    wide = 16
    names = [f"x{i}" for i in range(wide)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        total = np.zeros((2, 3 * BINS, CLASSES), np.float64)
        for batch in batches:
            for piece in W.pieces(batch.column("text")):
                t = _tokens(piece)
                own = m.classes(t, m.top.find(t.code))
                features = _features(t)
                p = np.exp(m.log_odds(features))
                for f in features:
                    order = np.argsort(f.astype(np.int16), kind="stable")
                    at = np.flatnonzero(np.concatenate([[True], f[order][1:] != f[order][:-1]]))
                    expected = np.add.reduceat(p[order], at, axis=0)
                    bins = f[order][at]
                    total[0, bins] -= expected
                    total[1, bins] += expected
                    seen = np.bincount(f * CLASSES + own, minlength=3 * BINS * CLASSES).reshape(3 * BINS, CLASSES)
                    total[0] += seen
                    total[1] += 0.5 * seen
        flat = total.reshape(-1, wide)
        at = np.flatnonzero(flat.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), *[pa.array(flat[at, i].astype(np.float32)) for i in range(wide)]], ["row", *names]
        )

    parts = docs.select("text").mapInArrow(run, "row long, " + ", ".join(f"{n} float" for n in names))
    summed = parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toPandas()  # as many rows as the model has
    out = np.zeros((2 * 3 * BINS * CLASSES // wide, wide))
    out[summed["row"].to_numpy()] = summed[names].to_numpy()
    return tuple(out.reshape(2, 3 * BINS, CLASSES))


def _frequent(counts: DataFrame) -> pd.DataFrame:
    """The most frequent tokens, at most ``TOP``, in order of frequency.

    A histogram over fine steps of the frequency (some thousand rows at most) gives the least frequency, so that
    only the tokens wanted leave the tasks.
    """
    step = F.floor(F.log2("n") * 64)
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).toPandas().sort_values("step", ascending=False)
    fits = sizes["step"][sizes["words"].cumsum() <= TOP]
    if not len(fits):
        return counts.limit(0).toPandas()
    return counts.where(step >= int(fits.min())).toPandas().sort_values(["n", "code"], ascending=[False, True], ignore_index=True)


def train(docs: DataFrame) -> tuple[Model, DataFrame, int, int]:
    """(model, token counts, tokens, distinct tokens) of the training texts ``docs`` (text, part)."""
    spark = docs.sparkSession
    found = parked(token_counts(docs), "counts")
    counts = found.where("ending >= 0")
    pairs = np.zeros(ENDINGS * ENDINGS, np.int64)
    for code, n in found.where("ending < 0").select("code", "n").toPandas().itertuples(index=False):  # at most ENDINGS ** 2
        pairs[code] = n
    per_ending = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()
    tokens, types = int(per_ending["n"].sum()), int(per_ending["v"].sum())
    top = _frequent(counts)

    cluster = _clusters(pairs.reshape(ENDINGS, ENDINGS), CLUSTERS)
    code, n, ending = top["code"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(), top["ending"].to_numpy(np.int64)
    frequent = np.argsort(code == END, kind="stable")[::-1][:1].tolist() if (code == END).any() else []
    frequent += [i for i in range(len(code)) if i not in frequent][: SINGLES - len(frequent)]
    single = np.full(len(code), -1)
    single[frequent] = np.arange(len(frequent))
    size, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    np.add.at(size, cluster[per_ending["ending"]] + SINGLES, per_ending["n"])
    np.add.at(kinds, cluster[per_ending["ending"]] + SINGLES, per_ending["v"])
    for i in frequent:
        home = cluster[ending[i]] + SINGLES
        size[home] -= n[i]
        kinds[home] -= 1
        size[single[i]], kinds[single[i]] = n[i], 1
    bias = np.log((size + 1) / (size.sum() + CLASSES)).astype(np.float32)
    model = Model(
        Lexicon(code), n, single, cluster, np.log10(size + kinds + 1), bias, np.zeros((3 * BINS, CLASSES), np.float32)
    )
    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast(model)
        gradient, curvature = _gradient(docs.where(F.col("part") == r), sent)
        model.weights += np.clip(0.5 * gradient / (curvature + 4), -2, 2).astype(np.float32)
        sent.destroy()
    return model, counts.select("code", "n"), tokens, types


_SCORED = "id long, held_out boolean, text_key long, n_tokens long, known long, base double, score double"


def _frequent_part(docs: DataFrame, shared) -> DataFrame:
    """Per row: the sums that need only the frequent words; rare words lack their log10(count + 1) and are named apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        gain = np.log10(m.counts + 1.0)
        for batch in batches:
            for piece in W.pieces(batch.column("text")):
                t = _tokens(piece)
                place = m.top.find(t.code)
                known = place >= 0
                own = m.classes(t, place)
                unigram = np.zeros(len(place))
                unigram[known] = gain[place[known]]
                odds = m.log_odds(_features(t))[np.arange(len(own)), own] / np.log(10)
                sums = lambda x: np.add.reduceat(x, t.first)  # noqa: E731,B023
                base = sums(unigram)
                rows = slice(piece.first, piece.first + piece.n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(rows.start, piece.n),
                        batch.column("held_out").slice(rows.start, piece.n),
                        pa.array(W.signed(_text_keys(t))),
                        pa.array(np.diff(np.append(t.first, len(t.code)))),
                        pa.array(sums(known.astype(np.int64))),
                        pa.array(base),
                        pa.array(base + sums(odds - m.log_total[own])),
                    ],
                    ["id", "held_out", "text_key", "n_tokens", "known", "base", "score"],
                )

    return docs.select("id", "held_out", "text").mapInArrow(run, _SCORED)


def _text_keys(t: Tokens) -> np.ndarray:
    """One number per text, from its tokens in their order."""
    size = np.diff(np.append(t.first, len(t.code)))
    place = np.arange(len(t.code)) - np.repeat(t.first, size)
    return W.mix(np.add.reduceat(W.mix(t.code + W.mix(place.astype(np.uint64))), t.first))


def _rare_words(docs: DataFrame, shared) -> DataFrame:
    """(text_key, task, code, times) of the words beyond the frequent ones; a task names each text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        task, seen = TaskContext.get().partitionId(), set()
        for batch in batches:
            for piece in W.pieces(batch.column("text")):
                t = _tokens(piece)
                keys = _text_keys(t)
                fresh = np.zeros(len(keys), bool)
                for i, k in enumerate(keys.tolist()):
                    if k not in seen:
                        seen.add(k)
                        fresh[i] = True
                owner = np.repeat(np.arange(len(keys)), np.diff(np.append(t.first, len(t.code))))
                use = (m.top.find(t.code) < 0) & fresh[owner]
                owner, code = owner[use], t.code[use]
                order = np.lexsort((code, owner))
                owner, code = owner[order], code[order]
                at = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])])) if len(code) else []
                times = np.diff(np.append(at, len(code))).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(W.signed(keys[owner[at]] if len(code) else keys[:0])),
                        pa.array(np.full(len(times), task, np.int32)),
                        pa.array(W.signed(code[at] if len(code) else code)),
                        pa.array(times),
                    ],
                    ["text_key", "task", "code", "times"],
                )

    return docs.select("text").mapInArrow(run, "text_key long, task int, code long, times long")


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; learns where not held out."""
    part = F.pmod(F.xxhash64(doc_id, F.length(F.col(text)), F.lit(11)), F.lit(ROUNDS))
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), held_out.alias("held_out"), part.alias("part"))
    model, counts, tokens, types = train(docs.where(~F.col("held_out")))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rare = _rare_words(docs, sent).join(counts, "code").groupBy("text_key", "task").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").alias("more_known")
    )
    rare = rare.groupBy("text_key").agg(F.min(F.struct("task", "more", "more_known")).alias("x"))
    # written out, so that the join below is one that AQE can split at a text with very many copies
    rare = parked(rare.select("text_key", "x.more", "x.more_known"), "rare")
    more = F.coalesce("more", F.lit(0.0))
    least = float(np.log10(tokens + types + 1.0))
    return (
        _frequent_part(docs, sent)
        .join(rare, "text_key", "left")
        .select(
            F.col("id").alias("doc_id"),
            "held_out",
            "n_tokens",
            (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            (F.col("base") + more - F.col("n_tokens") * F.lit(least)).alias("base_score"),
            (F.col("score") + more).alias("score"),
        )
    )
