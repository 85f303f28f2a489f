"""Toxicity categories predicted by a chain of linear classifiers.

The categories come in a fixed order; each has a logistic regression over word and word-beginning features *and* the
probabilities of the categories before it.  For training these are out-of-fold predictions: a row never sees a
probability from a model that was fitted on it, so later models learn to use probabilities as good as they will get.

Only one label exists in the data, so the earlier categories are weak labels: rows marked toxic that hold one of the
category's words.  The last category is the label itself.

Features are chosen over all labelled training rows: the words and word beginnings (4 and 5 bytes) whose document
frequency differs most between the labels.  The models are fitted to a bounded sample of ``FIT_ROWS`` labelled rows (by the
hash of their ids); all documents are scored over their whole texts.

A null or empty text has no features and gets the intercepts' probabilities; repeated rows are scored each; labels other
than 0 and 1 are not used; without rows of both labels every probability is the share of toxic rows, or 0 without any; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .op6 import Lexicon

FIT_ROWS, FEATURES, FOLDS, LEAST_ROWS = 10_000, 1024, 4, 5
#: Labels (16 bytes each) sent to all tasks at most.
SENT_LABELS = 1_000_000
PREFIXES = (4, 5)

# English words of the weak categories.
CATEGORIES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("insult", ("idiot", "moron", "loser", "clown", "stupid", "fool", "imbecile", "dumb")),
    ("contempt", ("pathetic", "worthless", "disgusting", "trash", "scum", "vermin", "garbage", "filth")),
)


def _features(piece: W.Words) -> np.ndarray:
    """Feature numbers of a piece: words first, then their beginnings, each kind with a salt of its own."""
    kinds = [piece.code] + [W.mix(piece.prefix(k) + np.uint64(k)) for k in PREFIXES]
    return np.stack(kinds)


def _frequencies(rows: DataFrame) -> DataFrame:
    """(feature, n0, n1): rows of each label with the feature; feature 0 stands for all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            parts = [(np.zeros(1, np.uint64), np.array([[np.sum(label == 0), np.sum(label == 1)]]))]
            for piece in W.pieces(batch.column("text")):
                for codes in _features(piece):
                    order = np.lexsort((codes, piece.owner))
                    own, codes = piece.owner[order], codes[order]
                    if not len(codes):
                        continue
                    new = np.concatenate([[True], (own[1:] != own[:-1]) | (codes[1:] != codes[:-1])])
                    marks = label[piece.first + own[new]]
                    value, at = np.unique(codes[new], return_inverse=True)
                    n1 = np.bincount(at, marks, len(value)).astype(np.int64)
                    parts.append((value, np.stack([np.bincount(at, minlength=len(value)) - n1, n1], axis=1)))
            codes, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            value, at = np.unique(codes, return_inverse=True)
            n0, n1 = (np.bincount(at, n[:, j], len(value)).astype(np.int64) for j in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(W.signed(value)), pa.array(n0), pa.array(n1)], ["feature", "n0", "n1"])

    counts = rows.select("label", "text").mapInArrow(run, "feature long, n0 long, n1 long")
    return counts.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _vectors(lexicon: Lexicon, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse log(1 + count) vectors of texts: (row, feature, value)."""
    rows, columns, values = [], [], []
    for piece in W.pieces(texts):
        codes = _features(piece)
        place = lexicon.find(codes.ravel())
        owner = np.tile(piece.owner, len(codes))
        use = place >= 0
        cell, n = np.unique(owner[use] * len(lexicon.codes) + place[use], return_counts=True)
        rows.append(piece.first + cell // max(len(lexicon.codes), 1))
        columns.append(cell % max(len(lexicon.codes), 1))
        values.append(np.log1p(n))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(values)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, use: np.ndarray, rounds: int = 150, penalty: float = 1e-4) -> np.ndarray:
    """Weights (intercept last) of several ridge logistic regressions at once: column f of ``use`` masks the rows of fit f."""
    a = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    n = np.maximum(use.sum(axis=0), 1)
    v = np.ones(a.shape[1], np.float32)
    for _ in range(15):
        v = a.T @ (a @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1 / (0.25 * float(np.linalg.norm(a @ v)) ** 2 / n.min() + penalty)
    w = np.zeros((a.shape[1], use.shape[1]), np.float32)
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        gradient = a.T @ (((_sigmoid(a @ ahead) - y[:, None]) * use) / n).astype(np.float32)
        gradient[:-1] += penalty * ahead[:-1]
        new = ahead - np.float32(step) * gradient
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + np.float32((t - 1) / t_new) * (new - w), new, t_new
    return w


@dataclass
class Chain:
    """Names and weights of the chain: features, earlier probabilities, intercept."""

    names: list[str]
    lexicon: Lexicon
    weights: list[np.ndarray]

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        row, column, value = _vectors(self.lexicon, texts)
        out = np.zeros((len(texts), len(self.names)))
        size = len(self.lexicon.codes)
        for c, w in enumerate(self.weights):
            z = np.bincount(row, value * w[column], len(texts)) + w[-1]
            for earlier in range(c):
                z += w[size + earlier] * out[:, earlier]
            out[:, c] = _sigmoid(z)
        return out


def _out_of_fold(inputs: np.ndarray, y: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights fitted to all rows, and for every row the probability by the weights fitted to the rows of other folds."""
    # the last column is the fit to all rows, the others leave a fold out
    use = np.concatenate([fold[:, None] != np.arange(FOLDS), np.ones((len(fold), 1), bool)], axis=1).astype(np.float32)
    w = _logistic(inputs, y, use)
    return w[:, -1], _sigmoid((inputs @ w[:-1] + w[-1])[np.arange(len(fold)), fold])


def fit(rows: DataFrame, categories=CATEGORIES, fit_rows: int = FIT_ROWS) -> Chain:
    """A chain from labelled rows (id, text, label)."""
    found = _frequencies(rows)
    total = found.where("feature = 0").toPandas()
    n0, n1 = (int(total[c].sum()) if len(total) else 0 for c in ("n0", "n1"))
    names = [name for name, _ in categories] + ["toxic"]
    if not n0 or not n1:
        w = np.array([0.0] * len(names) + [30.0 if n1 else -30.0])
        return Chain(names, Lexicon(np.zeros(0, np.uint64)), [np.append(w[:c], w[-1]) for c in range(len(names))])
    apart = F.col("n1") / n1 - F.col("n0") / n0
    pooled = (F.col("n0") + F.col("n1") + 1) / (n0 + n1)
    best = (
        found.where((F.col("feature") != 0) & (F.col("n0") + F.col("n1") >= LEAST_ROWS))
        .orderBy((apart * apart / pooled).desc(), "feature")
        .limit(FEATURES)
        .select("feature")
        .toPandas()
    )
    lexicon = Lexicon(best["feature"].to_numpy(np.int64).view(np.uint64))

    share = min(1.0, fit_rows / (n0 + n1))
    # by row and not by id, so that an id that repeats is no more than its share; the limit holds for equal rows in bulk
    chosen = rows.where(F.pmod(F.xxhash64("id", "text", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20))).limit(2 * fit_rows)
    holds = [F.lower("text").rlike(r"\b(" + "|".join(words) + r")\b").cast("int").alias(name) for name, words in categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, column, value = _vectors(lexicon, batch.column("text"))
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in (column, value)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("id", "label", *names[:-1])] + lists, ["id", "label", *names[:-1], "column", "value"]
            )

    weak = "".join(f"{name} int, " for name in names[:-1])
    sample = chosen.select("id", "label", *holds, "text").mapInArrow(
        run, f"id long, label int, {weak}column array<long>, value array<double>"
    )
    sample = sample.toPandas()  # about fit_rows rows of the chosen features only
    order = np.lexsort((sample["value"].map(len).to_numpy(), sample["label"].to_numpy(), sample["id"].to_numpy()))
    sample = sample.iloc[order]
    x = np.zeros((len(sample), len(lexicon.codes)), np.float32)
    for i, (columns, values) in enumerate(zip(sample["column"], sample["value"], strict=True)):
        x[i, columns] = values
    label = sample["label"].to_numpy(float)
    fold = np.arange(len(sample)) % FOLDS
    weights, earlier = [], np.zeros((len(sample), 0), np.float32)
    for name in names:
        y = label if name == "toxic" else label * sample[name].fillna(0).to_numpy(float)
        inputs = np.concatenate([x, earlier], axis=1)
        w, p = _out_of_fold(inputs, y, fold)
        earlier = np.concatenate([earlier, p[:, None].astype(np.float32)], axis=1)
        weights.append(w.astype(float))
    return Chain(names, lexicon, weights)


def score(
    docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", categories=CATEGORIES
) -> DataFrame:
    """(doc_id, train, one probability per category) of every row; learns from the labelled rows where ``train`` holds."""
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), train.alias("train"))
    known = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    # up to a checked size the labels go to the texts; beyond it both sides are shuffled
    if known.limit(SENT_LABELS + 1).count() <= SENT_LABELS:
        known = F.broadcast(known)
    chain = fit(docs.where("train").join(known, "id").select("id", "text", "label"), categories)
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    names = chain.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = sent.value.probabilities(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("train"), *[pa.array(p[:, c]) for c in range(len(names))]], ["doc_id", "train", *names]
            )

    return docs.mapInArrow(run, "doc_id long, train boolean, " + ", ".join(f"{n} double" for n in names))
