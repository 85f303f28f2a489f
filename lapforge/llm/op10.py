"""Approximate nearest neighbours by learned partitions.

1. A bounded sample gets its exact neighbour graph: ``PER_PART`` vectors a part, at least ``LEAST_SAMPLE`` and at most ``SAMPLE``.
2. The graph is cut into balanced parts: a recursive median split, then rounds in which every vertex moves to the part
   most of its neighbours are in, as far as the parts' capacity allows.
3. A small neural network learns, from the vector alone, in which parts its neighbours lie.
   There are about as many parts as the square root of the rows, from the smallest tables on, up to what ``SAMPLE`` can teach.
4. Every row is indexed under its most probable part.  A query goes to its ``probes`` most probable parts, and to more
   until they hold enough candidates; ``probes`` is the least number that finds ``RECALL`` of the neighbours of the sample's
   held-out vectors.
5. Parts are compared with their queries in blocks: a part of any size is dealt into blocks of about ``ROWS`` rows
   and its queries into blocks of about ``QUERIES``, every pair of blocks being a group of its own.

Nearness is the inner product in double precision, summed in the same order for every pair, so equal vectors tie exactly;
ties go to the smaller id.  Ids that are null and vectors that are null, zero, of another length than most, or that
hold a null or non-finite component take no part; of rows that share an id the smallest vector counts; a query is
never its own neighbour; with fewer candidates than ``k`` all are returned; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import parked

LEAST_SAMPLE, SAMPLE, PER_PART, RECALL = 6000, 65_536, 8, 0.98
ROWS, QUERIES, PAIRS, HIDDEN = 8192, 2048, 65_536, 128


def clean(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v) with v an array of doubles, for the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0))
    rows = parked(rows.groupBy("id").agg(F.min("v").alias("v")), "vectors")
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").limit(1).collect()
    return rows.where(F.size("v") == (usual[0]["n"] if usual else 0))


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    return np.argpartition(-scores, min(k, scores.shape[1] - 1), axis=1)[:, :k]


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest other rows of each row, by inner product."""
    out = np.zeros((len(x), min(k, len(x) - 1)), np.int64)
    for lo in range(0, len(x), 1024):
        s = x[lo : lo + 1024] @ x.T
        s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
        out[lo : lo + 1024] = _top(s, out.shape[1])
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Part of each vertex, at most a tenth above the mean size."""
    own = np.zeros(len(x), np.int64)
    done, rng = 1, np.random.default_rng(1)
    while done < parts:
        for p in range(done):
            rows = np.flatnonzero(own == p)
            if len(rows) < 2:
                continue
            y = x[rows] - x[rows].mean(axis=0)
            d = rng.standard_normal(x.shape[1])
            for _ in range(8):
                d = y.T @ (y @ d)
                d /= max(np.linalg.norm(d), 1e-12)
            own[rows[np.argsort(y @ d, kind="stable")[len(rows) // 2 :]]] = p + done
        done *= 2
    room = int(np.ceil(1.1 * len(x) / parts))
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        for j in range(graph.shape[1]):
            votes[np.arange(len(x)), own[graph[:, j]]] += 1
            np.add.at(votes, (graph[:, j], own), 1)
        best = np.argmax(votes, axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), own]
        size = np.bincount(own, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[own[i]] -= 1
                size[best[i]] += 1
                own[i] = best[i]
                moved += 1
        if not moved:
            break
    return own


@dataclass
class Router:
    """Two dense layers and the scale of their input."""

    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train_router(x: np.ndarray, wanted: np.ndarray, epochs: int = 30) -> Router:
    """Network whose softmax fits the rows of ``wanted``, by Adam on batches."""
    rng = np.random.default_rng(2)
    scale = 1 / max(float(np.sqrt((x**2).mean())), 1e-12)
    d, parts = x.shape[1], wanted.shape[1]
    params = [
        rng.standard_normal((d, HIDDEN)) * np.sqrt(2 / d),
        np.zeros(HIDDEN),
        rng.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN),
        np.zeros(parts),
    ]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            a = x[rows] * scale
            h = np.maximum(a @ params[0] + params[1], 0)
            z = h @ params[2] + params[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = (z / z.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
            back = (g @ params[2].T) * (h > 0)
            step += 1
            for i, grad in enumerate((a.T @ back, back.sum(0), h.T @ g, g.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.99 * second[i] + 0.01 * grad**2
                move = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
                params[i] -= 3e-3 * (1 - epoch / epochs) * move
    return Router(scale, *params)


def learn(x: np.ndarray, parts: int, k: int) -> tuple[Router, int]:
    """(router, probes) from a sample of vectors."""
    graph = neighbour_graph(x, 10)
    own = balanced_parts(x, graph, parts)
    wanted = np.zeros((len(x), parts))
    wanted[np.arange(len(x)), own] += 1
    for j in range(graph.shape[1]):
        wanted[np.arange(len(x)), own[graph[:, j]]] += 1
    wanted /= wanted.sum(axis=1, keepdims=True)
    held = np.arange(len(x)) % 5 == 0
    router = train_router(x[~held], wanted[~held])
    order = np.argsort(-router.logits(x), axis=1, kind="stable")
    near = neighbour_graph(x, k)[held]
    home = order[:, 0][near]
    for probes in range(1, parts + 1):
        found = (home[:, :, None] == order[held][:, None, :probes]).any(axis=2).mean()
        if found >= RECALL:
            return router, probes
    return router, parts


def _compare(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype=float)})
    if not len(queries) or not len(rows):
        return empty
    rows = rows.sort_values("id", kind="stable")
    ids, x = rows["id"].to_numpy(), np.stack(rows["v"].to_list())
    # of equal vectors only the k + 1 smallest ids can be among the k nearest
    _, same = np.unique(x.view(f"V{8 * x.shape[1]}").ravel(), return_inverse=True)
    order = np.argsort(same, kind="stable")
    rank = np.empty(len(x), np.int64)
    begin = np.concatenate([[True], same[order][1:] != same[order][:-1]])
    rank[order] = np.arange(len(x)) - np.maximum.accumulate(np.where(begin, np.arange(len(x)), 0))
    ids, x = ids[rank <= k], x[rank <= k]
    asked = np.stack(queries["v"].to_list())
    own, out = queries["id"].to_numpy(), []
    for lo in range(0, len(asked), 256):
        block = asked[lo : lo + 256]
        rough = block @ x.T
        near = np.ones(rough.shape, bool)
        if len(x) > k + 1:
            # a query with a product beyond all numbers is compared exactly with every row
            sound = np.flatnonzero(np.isfinite(rough).all(axis=1))
            least = np.partition(rough[sound], len(x) - k - 1, axis=1)[:, len(x) - k - 1]
            near[sound] = rough[sound] >= (least - 1e-9 * np.maximum(1.0, np.abs(least)))[:, None]
        q, at = np.nonzero(near & (ids != own[lo : lo + 256, None]))
        # the same order of additions for every pair
        exact = np.concatenate([(x[at[i : i + PAIRS]] * block[q[i : i + PAIRS]]).sum(axis=1) for i in range(0, max(1, len(q)), PAIRS)])
        best = np.lexsort((ids[at], -exact, q))
        q, at, exact = q[best], at[best], exact[best]
        use = np.arange(len(q)) - np.searchsorted(q, q) < k
        out.append(pd.DataFrame({"query_id": own[lo + q[use]], "vec_id": ids[at[use]], "score": exact[use]}))
    return pd.concat(out, ignore_index=True)


def parts_for(rows: int) -> int:
    """The power of two next below the square root of the rows, and no more than the largest sample can teach."""
    parts = 1
    while 4 * parts * parts <= rows and 2 * parts * PER_PART <= SAMPLE:
        parts *= 2
    return parts


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every query; ``is_query`` is a condition on column ``id``."""
    spark = vectors.sparkSession
    rows = clean(vectors, vec_id, vector)
    total = rows.count()
    parts = parts_for(total)
    sample = max(LEAST_SAMPLE, PER_PART * parts)
    share = min(1.0, sample / max(total, 1))
    chosen = rows.where(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * sample).toPandas()
    if parts > 1 and len(chosen) > 4 * parts:
        chosen = chosen.sort_values("id")
        router, probes = learn(np.unique(np.stack(chosen["v"].to_list()), axis=0), parts, k)
    else:
        parts, router, probes = 1, None, 1
    sent = spark.sparkContext.broadcast(router)

    def routed(rows: DataFrame, sizes: np.ndarray | None = None) -> DataFrame:
        """(id, v, parts): the most probable part; given the rows of each, as many parts as asked for and further ones
        until they hold k candidates besides the query."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = np.stack(batch.column("v").to_numpy(zero_copy_only=False))
                order = np.zeros((len(x), 1), np.int64) if sent.value is None else np.argsort(-sent.value.logits(x), axis=1, kind="stable")
                use = np.broadcast_to(np.arange(parts) < (1 if sizes is None else probes), order.shape)
                if sizes is not None:
                    use = use | (np.cumsum(sizes[order], axis=1) - sizes[order] < k + 1)
                ends = np.concatenate([[0], np.cumsum(use.sum(axis=1))])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(order[use]))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), lists], ["id", "v", "parts"])

        return rows.mapInArrow(run, "id long, v array<double>, parts array<long>").select("id", "v", F.explode("parts").alias("part"))

    index = parked(routed(rows), "index")
    sizes = {r["part"]: r["count"] for r in index.groupBy("part").count().collect()}  # a row per part
    queries = routed(rows.where(is_query), np.array([sizes.get(p, 0) for p in range(parts)]))
    queries = parked(queries, "queries")
    asked = {r["part"]: r["count"] for r in queries.groupBy("part").count().collect()}
    blocks = lambda count, size: F.create_map(*[F.lit(x).cast("long") for p in range(parts) for x in (p, -(-count.get(p, 0) // size))])
    row_blocks, query_blocks = blocks(sizes, ROWS), blocks(asked, QUERIES)
    part = F.col("part")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    left = queries.where(row_blocks[part] > 0).withColumn("qb", F.pmod(F.xxhash64("id"), query_blocks[part])).withColumn("rb", every(row_blocks[part]))
    right = index.where(query_blocks[part] > 0).withColumn("rb", F.pmod(F.xxhash64("id"), row_blocks[part])).withColumn("qb", every(query_blocks[part]))
    key = ["part", "rb", "qb"]
    found = (
        left.groupBy(*key)
        .cogroup(right.groupBy(*key))
        .applyInPandas(lambda key, q, r: _compare(key, q, r, k), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
