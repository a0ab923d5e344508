"""Approximate nearest neighbours from low-dimensional stable projections.

Largest inner product is made a nearest-neighbour search by one more component (the root of what a vector lacks to
the block's largest squared norm; a query has 0 there). Vectors are projected by a fixed Gaussian matrix on
``DIMS`` axes; a kd-tree over the projections gives a query its projected neighbours leaf by leaf, nearest box
first, and each leaf's vectors are verified on the original components. For a vector at distance r the squared
projected distance over r^2 follows a chi-square distribution with ``DIMS`` degrees of freedom, so the search stops
once the next box is so far that a vector nearer than the k-th found would lie there with probability at most
``1 - SURE``.

Candidates are dealt into blocks of about ``BLOCK`` distinct vectors and queries into blocks of about ``QUERIES``;
each pair of blocks is one task's group, and a window keeps each query's best. Equal vectors are one candidate
that carries its k + 1 smallest ids: no query can return more of them.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows
without vec_id; vectors of another length than the query's are no candidates; with fewer than k candidates all are returned; equal
scores go to the smaller vec_id; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch, read_table
from fleetlake.llm.vectors import as_bytes, matrix

K = 20
EVERY = 20
DIMS = 8
LEAF = 64
SURE = 0.9
BLOCK = 8192
QUERIES = 2048
SEED = 23


def chi_square_quantile(p: float, dof: int) -> float:
    """For an even number of degrees of freedom, by bisection of the closed form."""
    def cdf(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dof // 2))
    lo, hi = 0.0, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


class KdTree:
    """Leaves of at most ``leaf`` points by halving along the widest axis; each with its box."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        todo, self.leaves = [np.arange(len(points))], []
        while todo:
            at = todo.pop()
            if len(at) <= leaf:
                self.leaves.append(at)
                continue
            p = points[at]
            axis = int((p.max(0) - p.min(0)).argmax())
            half = len(at) // 2
            order = np.argpartition(p[:, axis], half)
            todo += [at[order[:half]], at[order[half:]]]
        self.low = np.array([points[at].min(0) for at in self.leaves])
        self.high = np.array([points[at].max(0) for at in self.leaves])

    def nearest_first(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves in the order of their box's squared distance to ``q``, and those distances."""
        gap = np.maximum(0, np.maximum(self.low - q, q - self.high))
        dist = (gap * gap).sum(1)
        order = np.argsort(dist)
        return order, dist[order]


def search_block(x: np.ndarray, queries: np.ndarray, k: int, sure: float = SURE, dims: int = DIMS):
    """For each query the numbers and scores of (about) the k best rows of ``x`` by inner product."""
    norms = (x * x).sum(1)
    top = norms.max()
    g = np.random.Generator(np.random.PCG64([SEED, x.shape[1]])).standard_normal((x.shape[1] + 1, dims))
    tree = KdTree(np.column_stack([x, np.sqrt(np.maximum(0, top - norms))]) @ g)
    projected = np.column_stack([queries, np.zeros(len(queries))]) @ g
    limit = chi_square_quantile(sure, dims)
    order = np.concatenate(tree.leaves)
    starts = np.cumsum([0, *map(len, tree.leaves)])
    laid = x[order]
    for q, p in zip(queries, projected):
        leaves, dist = tree.nearest_first(p)
        qq, far = float(q @ q), np.inf
        got, score, i = [], [], 0
        while i < len(leaves) and dist[i] < limit * far:
            # what the same bound still admits, a few leaves at a time
            step = leaves[i:i + 4]
            i += len(step)
            for leaf in step:
                got.append(np.arange(starts[leaf], starts[leaf + 1]))
                score.append(laid[starts[leaf]:starts[leaf + 1]] @ q)
            if sum(map(len, got)) >= k:
                n, s = np.concatenate(got), np.concatenate(score)
                if len(n) > k:
                    kth = np.partition(s, len(s) - k)[len(s) - k]
                    keep = s >= kth  # all that tie with the k-th stay
                    n, s = n[keep], s[keep]
                got, score = [n], [s]
                far = max(0.0, qq + top - 2 * float(s.min()))
        yield (order[np.concatenate(got)], np.concatenate(score)) if got else (np.zeros(0, int), np.zeros(0))


def _pairs(k: int):
    def run(cands: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(cands) and len(queries):
            x, q = matrix(cands["vec"]), matrix(queries["vec"])
            ids = list(cands["ids"])
            for own, vec, (at, _) in zip(queries["vec_id"], q, search_block(x, q, k + 1)):
                # the measure itself, the same way for every row
                for i, s in zip(at, (x[at] * vec).sum(1)):
                    some = [v for v in ids[i] if v != own]
                    out["query_id"] += [own] * len(some)
                    out["vec_id"] += some
                    out["score"] += [s] * len(some)
        got = pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        got = got.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return got.groupby("query_id").head(k)
    return run


def nearest(table: DataFrame, queries: DataFrame, scratch: Scratch, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``table`` for each of ``queries`` (same columns)."""
    rows = scratch.cut(as_bytes(table.withColumn("label", F.lit(0))).where("key IS NOT NULL AND vec_id IS NOT NULL")
                       .select("vec_id", "vec", "key").distinct())
    n = F.row_number().over(W.partitionBy("key").orderBy("vec_id"))
    few = rows.select("key", "vec_id").withColumn("rn", n).where(F.col("rn") <= k + 1)
    ids = few.groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # at most k + 1
    cands = scratch.cut(rows.groupBy("key").agg(F.max("vec").alias("vec")).join(ids, "key"))
    asked = scratch.cut(as_bytes(queries.withColumn("label", F.lit(0))).where("key IS NOT NULL AND vec_id IS NOT NULL")
                        .select("vec_id", "vec").distinct())
    blocks, groups = max(1, math.ceil(cands.count() / BLOCK)), max(1, math.ceil(asked.count() / QUERIES))
    cands = (cands.withColumn("dim", F.octet_length("vec")).withColumn("cb", F.pmod(F.xxhash64("key"), F.lit(blocks)))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    asked = (asked.withColumn("dim", F.octet_length("vec")).withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
             .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    found = (cands.groupBy("dim", "cb", "qb").cogroup(asked.groupBy("dim", "cb", "qb"))
             .applyInPandas(_pairs(k), "query_id long, vec_id long, score double"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: rows whose vec_id is divisible by 20; candidates: all rows."""
    table = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(table, table.where(F.col("vec_id") % EVERY == 0), Scratch(spark, "ann"))
