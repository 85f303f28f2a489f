"""Hard negatives for contrastive training, mined by a secondary-sort shuffle.

For every anchor the other rows with its label, best scores first, give its positives; rows with another label whose
score lies between ``low`` percent of a positive's score and that score are the positive's negatives.  Scores are integer
inner products of the vectors, whose components become ``floor(scale * x)``; equal scores go by id.

1. Anchors meet all rows in blocks: every block of about ``ANCHORS`` anchors and every block of about ``ROWS`` rows are
   one group with one matrix product.  Scores never leave the group as a whole: first it keeps each anchor's best rows of
   the same label, as many as positives are wanted, then, once the positives are known, for each of their windows the
   best rows of other labels.  Both are exact, as what is best of all rows is among the best of its block.
2. What is kept is packed into keys (anchor, descending score, positive or negative, id) whose bytes sort in this order, and goes
   through ``repartitionAndSortWithinPartitions`` by anchor.
3. An iterator walks the sorted keys: a positive opens its window, a negative goes to all open windows it fits, a
   window closes when it has enough or the scores have left it.  It holds the open windows of one anchor and nothing else.

Defined results: rows with a null id, label or vector, with a null or non-finite component, an empty vector or one of
another length than most take no part; of rows that share an id the least (label, vector) counts, so copies are one row; a
row is never its own positive; anchors with fewer positives or negatives give what there is, without any no row; a
positive of negative score has an empty window; an empty table gives no rows; other columns are not read.  Scores beyond a
long are held at its ends.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import parked

ANCHORS, ROWS = 1024, 4096
SCALE, LOW = 256, 80

_KEY = struct.Struct(">QQBQ")
_ZERO, _TOP = 1 << 63, (1 << 63) - 1


def pack(anchor: int, score: int, negative: bool, other: int) -> bytes:
    """A key whose bytes sort by anchor, falling score, positives first, id."""
    return _KEY.pack(anchor + _ZERO, _TOP - score, negative, other + _ZERO)


def unpack(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, negative, other = _KEY.unpack(key)
    return anchor - _ZERO, _TOP - score, bool(negative), other - _ZERO


def clean(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, v) with v an array of whole numbers, for the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
    rows = rows.withColumn("v", F.transform(v, lambda x: F.floor(scale * x).cast("long")))
    rows = parked(rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v"), "vectors")
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").limit(1).collect()
    return rows.where(F.size("v") == (usual[0]["n"] if usual else 0))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in doubles where they fit, else in longs, else in Python's numbers."""
    most = lambda x: max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    bound = most(a) * most(b) * a.shape[1]
    if bound < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -_ZERO, _TOP).astype(np.int64)


def best(scores: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Of ``rows`` (ascending) the k with the highest scores, ties to the earlier row."""
    if len(rows) > k:
        own = scores[rows]
        least = np.partition(own, len(own) - k)[len(own) - k]
        rows = rows[own >= least]
    return rows[np.argsort(~scores[rows], kind="stable")][:k]  # ~x falls as x grows, without overflow


def _kept(anchors: pa.Table, rows: pa.Table, k: int, low: int | None) -> pa.Table:
    """(anchor, score, other): the best positives of a block, or with ``low`` the best negatives of each window."""
    if not anchors.num_rows or not rows.num_rows:
        return pa.table([pa.array([], pa.int64())] * 3, names=["anchor", "score", "other"])
    rows = rows.sort_by("id")
    ids, named = rows.column("id").to_numpy(), rows.column("label").to_numpy(zero_copy_only=False)
    x = _matrix(rows.column("v"), rows.num_rows)
    own, wanted = anchors.column("id").to_pylist(), anchors.column("label").to_pylist()
    windows = anchors.column("scores").to_pylist() if low is not None else [None] * len(own)
    scores = products(_matrix(anchors.column("v"), anchors.num_rows), x)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for s, a, label, opened in zip(scores, own, wanted, windows, strict=True):
        if opened is None:
            at = best(s, np.flatnonzero((named == label) & (ids != a)), k)
        else:
            other = np.flatnonzero(named != label)
            own_s = s[other]
            each = [best(s, other[(own_s >= -(-low * p // 100)) & (own_s <= p)], k) for p in set(opened)]
            at = np.unique(np.concatenate(each)) if each else other[:0]
        out.append((np.full(len(at), a, np.int64), s[at], ids[at]))
    return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], names=["anchor", "score", "other"])


def in_blocks(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, k: int, low: int | None) -> DataFrame:
    """What every block of anchors keeps of every block of rows."""
    a, b = -(-n_anchors // ANCHORS) or 1, -(-n_rows // ROWS) or 1
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = anchors.withColumn("ab", dealt(a)).withColumn("rb", every(b))
    fresh = [F.col(c).alias(c) for c in ("id", "label", "v")]  # columns of their own, as anchors are rows too
    right = rows.select(*fresh).withColumn("rb", dealt(b)).withColumn("ab", every(a))
    return (
        left.groupBy("ab", "rb")
        .cogroup(right.groupBy("ab", "rb"))
        .applyInArrow(lambda l, r: _kept(l, r, k, low), "anchor long, score long, other long")
    )


def stream(keys: Iterator[tuple[bytes, None]], negatives: int, low: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, positive score, negative score) from sorted keys; holds open windows only."""
    anchor, windows = None, []
    for key, _ in keys:
        own, score, negative, other = unpack(key)
        if own != anchor:
            anchor, windows = own, []
        if not negative:
            windows.append([other, score, 0])
            continue
        windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]
        for w in windows:
            if score <= w[1]:
                w[2] += 1
                yield own, w[0], w[2], other, w[1], score


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = LOW,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` is a condition on column ``id``."""
    spark = vectors.sparkSession
    rows = clean(vectors, vec_id, vector, label, scale)
    n_rows, anchors = rows.count(), rows.where(is_anchor)
    n_anchors = anchors.count()
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "other")
    first = in_blocks(anchors, rows, n_anchors, n_rows, positives, None)
    chosen = parked(first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives).drop("rank"), "positives")
    scores = chosen.groupBy(F.col("anchor").alias("id")).agg(F.collect_set("score").alias("scores"))  # at most ``positives`` each
    second = in_blocks(anchors.join(scores, "id"), rows, n_anchors, n_rows, negatives, low)

    pairs = chosen.withColumn("negative", F.lit(False)).unionByName(second.withColumn("negative", F.lit(True)))
    keys = pairs.select("anchor", "score", "negative", "other").rdd.map(lambda r: (pack(*r), None))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # only the anchor, the first eight bytes, decides on the partition
    sorted_keys = keys.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8]))
    return spark.createDataFrame(
        sorted_keys.mapPartitions(lambda part: stream(part, negatives, low)),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )
