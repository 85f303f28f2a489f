"""Quality classifier: a sparse ensemble of rules over text statistics, compiled into Spark column expressions.

1. Each text is described by statistics (``STATISTICS``), Spark expressions over the whole text.
2. Boosted trees of depth ``DEPTH`` are fitted to a bounded sample of labelled rows; every path from a root to a node,
   that is a conjunction of comparisons, becomes a rule.
3. A logistic regression with an L1 penalty weighs the rules; most get weight zero and go.
4. The rules left are sums of ``when(condition, weight)`` columns, so all rows are scored inside Spark.

The sample is the labelled training rows whose id hashes below a share that makes ``FIT_ROWS`` rows on average; beyond
that many labelled rows the fit sees no more, while statistics and scores always cover every row.

A null or empty text has statistics 0 and gets the score of such a text; rows without a label are only scored; a label
other than 0 and 1 is not used; documents or labels that occur repeatedly count each time; without rows of both labels
every score is the share of label 1, or 0.5 without any; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import WORD, parked

FIT_ROWS = 20_000
TREES, DEPTH, BINS, RATE, PENALTY = 24, 3, 32, 0.3, 2e-3


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def statistics(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The kept columns and one double per statistic for every row."""
    content = F.coalesce(F.col(text), F.lit(""))
    first = docs.select(*keep, content.alias("__text"), F.regexp_extract_all(content, F.lit(WORD), F.lit(0)).alias("__words"))
    t, w = F.col("__text"), F.col("__words")
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    chars, words = F.length(t), F.size(w)
    lines = F.split(t, "\n", -1)
    pairs = F.zip_with(F.slice(w, 1, F.greatest(words - 1, F.lit(0))), F.slice(w, 2, F.greatest(words - 1, F.lit(0))), lambda a, b: a == b)
    return first.select(
        *keep,
        F.log1p(chars).alias("length"),
        F.log1p(words).alias("words"),
        _ratio(chars, words).alias("word_length"),
        _ratio(F.size(F.array_distinct(w)), words).alias("distinct_words"),
        _ratio(F.size(F.filter(pairs, lambda same: same)), words).alias("repeats"),
        _ratio(F.size(F.array_distinct(lines)), F.size(lines)).alias("distinct_lines"),
        _ratio(words, F.size(lines)).alias("line_words"),
        _ratio(count(r"\p{Lu}"), chars).alias("capitals"),
        _ratio(count(r"[^\p{L}\p{M}\p{N}\s]"), chars).alias("symbols"),
        _ratio(count(r"\p{N}"), chars).alias("digits"),
        _ratio(count(r"[.!?](?=\s|$)"), words).alias("sentence_ends"),
        _ratio(count(r"(?<!\S)[^\p{L}\p{N}\s]+(?!\S)"), words).alias("bare_symbols"),
    )


STATISTICS = (
    "length",
    "words",
    "word_length",
    "distinct_words",
    "repeats",
    "distinct_lines",
    "line_words",
    "capitals",
    "symbols",
    "digits",
    "sentence_ends",
    "bare_symbols",
)

#: A comparison: statistic, threshold, whether the value lies above it.
Test = tuple[str, float, bool]


@dataclass(frozen=True)
class Rules:
    """An intercept and weighted conjunctions; empty conjunctions do not occur."""

    intercept: float
    rules: tuple[tuple[tuple[Test, ...], float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for tests, weight in self.rules:
            holds = F.lit(True)
            for name, limit, above in tests:
                holds = holds & ((F.col(name) > limit) if above else (F.col(name) <= limit))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _paths(x: np.ndarray, y: np.ndarray) -> list[tuple[tuple[int, float, bool], ...]]:
    """Conjunctions at the nodes of boosted trees: second-order splits on quantile bins."""
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
    codes = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)], axis=1)
    margin = np.full(len(y), np.log((y.mean()) / (1 - y.mean())))
    found: dict[tuple, None] = {}
    for _ in range(TREES):
        p = _sigmoid(margin)
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        nodes = [((), np.arange(len(y)))]
        for _ in range(DEPTH):
            deeper = []
            for path, rows in nodes:
                best = (1e-3, None, None)
                G, H = g[rows].sum(), h[rows].sum()
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    gs = np.bincount(codes[rows, j], g[rows], len(c) + 1).cumsum()[:-1]
                    hs = np.bincount(codes[rows, j], h[rows], len(c) + 1).cumsum()[:-1]
                    gain = gs**2 / (hs + 1) + (G - gs) ** 2 / (H - hs + 1) - G**2 / (H + 1)
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (gain[k], j, k)
                if best[1] is None:
                    margin[rows] -= RATE * G / (H + 1)
                    continue
                _, j, k = best
                low = codes[rows, j] <= k
                for above, part in ((False, rows[low]), (True, rows[~low])):
                    longer = (*path, (j, float(cuts[j][k]), above))
                    found[longer] = None
                    deeper.append((longer, part))
            nodes = deeper
        for _, rows in nodes:
            if len(rows):
                margin[rows] -= RATE * g[rows].sum() / (h[rows].sum() + 1)
    return list(found)


def _lasso(z: np.ndarray, y: np.ndarray, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient steps; the intercept is free."""
    n = len(y)
    a = np.concatenate([np.ones((n, 1), np.float32), z.astype(np.float32)], axis=1)
    v = np.random.default_rng(0).standard_normal(a.shape[1]).astype(np.float32)
    for _ in range(20):
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    step = 1 / (0.25 * float(np.linalg.norm(a @ v)) ** 2 / n * 1.05 + 1e-9)
    w = np.zeros(a.shape[1])
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        grad = a.T @ (_sigmoid(a @ ahead.astype(np.float32)) - y).astype(np.float32) / n
        new = ahead - step * grad
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * PENALTY, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray) -> Rules:
    """Rules for label 1 from rows of statistics."""
    if not len(y) or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
        return Rules(float(np.log(share / (1 - share))), ())
    paths = _paths(x, y)
    if not paths:
        return Rules(float(np.log(y.mean() / (1 - y.mean()))), ())
    z = np.stack([np.all([(x[:, j] > c) == above for j, c, above in path], axis=0) for path in paths], axis=1)
    intercept, weights = _lasso(z, y)
    kept = [
        (tuple((STATISTICS[j], c, above) for j, c, above in path), float(w))
        for path, w in zip(paths, weights, strict=True)
        if abs(w) > 1e-6
    ]
    return Rules(intercept, tuple(kept))


def score(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> tuple[DataFrame, Rules]:
    """((doc_id, train, score) of every row of ``docs``, the rules); rules are learned where ``train`` holds."""
    narrow = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__content"), train.alias("__train"))
    stats = parked(statistics(narrow, "__content", ["__id", "__train"]), "statistics")
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label")).where("__label in (0, 1)")
    rows = stats.where("__train").join(known, "__id")
    total = rows.count()
    share = min(1.0, fit_rows / max(total, 1))
    # by row and not by id, so that an id that repeats is no more than its share; the limit holds for equal rows in bulk
    chosen = rows.where(F.pmod(F.xxhash64("__id", *STATISTICS, F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20))).limit(2 * fit_rows)
    sample = chosen.orderBy("__id", "__label", *STATISTICS).select("__label", *STATISTICS).toPandas()
    rules = fit(sample[list(STATISTICS)].to_numpy(float), sample["__label"].to_numpy(float))
    scored = stats.withColumn("score", rules.score())
    return scored.select(F.col("__id").alias("doc_id"), F.col("__train").alias("train"), "score"), rules
