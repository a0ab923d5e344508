"""Embedding near-dedup by spherical-cap filters.

Vectors are turned by a fixed random rotation and cut into two halves; each half has a code of ``B`` random unit
vectors, and every pair of code words is a filter direction. A vector is decoded to the list of all directions
whose inner product with it exceeds ``alpha`` (and to its best one, should none do so); vectors of one label that
share a filter are compared by cosine in double precision. Equal vectors are one class before that.

``B`` grows with the square root of the number of classes, so a filter's expected load stays level. ``alpha`` is what
lets a pair at the cosine asked for share a filter with probability ``RECALL``: it is read off random pairs at that
cosine under the code itself, for any ``B`` and length (a pair's best common filter is as good as for any other
pair, as the rotation is random). The lists get longer with ``B`` then: about 40 filters of 2,500 and 130 of 10 million.
The filters decide which pairs are seen: nearer pairs are missed more seldom. A filter with
more than ``TILE`` members is cut into blocks, and every pair of blocks is a tile of its own. A pair seen in
several filters counts in the smallest one both have.

Defined cases: a vector that is null, empty, zero, or has null or non-finite components, or a null label, links
with nothing and stands for itself; vectors of different length never link; copies link with each other; rows
with a null vec_id come back with a null component; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch, components, read_table
from fleetlake.llm.vectors import as_bytes, matrix

COSINE = 0.93
RECALL = 0.994
TRIALS = 3000  # random pairs that alpha is read off
TILE = 1024
SEED = 17


class ProductCode:
    """``B * B`` filter directions for vectors of length ``d``."""

    def __init__(self, d: int, size: int, cosine: float = COSINE, recall: float = RECALL, seed: int = SEED):
        rng = np.random.Generator(np.random.PCG64([seed, d]))
        self.turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
        self.cut = (d + 1) // 2
        halves = [rng.standard_normal((size, k)) for k in (self.cut, d - self.cut)]
        self.codes = [c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300) for c in halves]
        self.size = size
        x, z = (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300) for v in rng.standard_normal((2, TRIALS, d)))
        z -= (z * x).sum(1, keepdims=True) * x
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-300)
        self.alpha = float(np.quantile(self.best_common(x, cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * z), 1 - recall))

    def parts(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products with the code words of both halves; a filter's is the sum of its two."""
        y = x @ self.turn
        return (y[:, :self.cut] @ self.codes[0].T) / math.sqrt(2), (y[:, self.cut:] @ self.codes[1].T) / math.sqrt(2)

    def best_common(self, x: np.ndarray, y: np.ndarray, words: int = 128) -> np.ndarray:
        """The largest alpha at which each pair still shares a filter (of the best ``words`` of each half, so it may come out too low)."""
        (a, b), (c, d) = self.parts(x), self.parts(y)
        out = np.empty(len(x))
        for i in range(len(x)):
            f, s = np.argsort(-(a[i] + c[i]))[:words], np.argsort(-(b[i] + d[i]))[:words]
            out[i] = np.minimum(a[i, f][:, None] + b[i, s], c[i, f][:, None] + d[i, s]).max()
        return out

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """Sorted filter numbers of each row of ``x`` (unit vectors)."""
        one, two = self.parts(x)
        out = []
        for a, b in zip(one, two):
            order = np.argsort(-b)
            b = b[order]
            # only words of the first half that reach alpha with the best of the second are followed
            rows = np.flatnonzero(a + b[0] >= self.alpha)
            if len(rows):
                n = np.searchsorted(-b, a[rows] - self.alpha, side="right")
                got = np.concatenate([r * self.size + order[:k] for r, k in zip(rows, n)])
            else:
                got = np.array([int(a.argmax()) * self.size + order[0]])
            out.append(np.sort(got).astype(np.int32))
        return out


def short(vec: bytes) -> bytes:
    """The doubles as 4-byte floats where these are the same numbers; tiles get half the bytes then."""
    x = np.frombuffer(vec, "<f8")
    with np.errstate(over="ignore"):
        y = x.astype("<f4")
    return y.tobytes() if (y == x).all() else vec


def doubles(vecs, dim: int) -> np.ndarray:
    return np.array([np.frombuffer(v, "<f4" if len(v) == 4 * dim else "<f8") for v in vecs], np.float64)


def _filters(size: int, cosine: float, recall: float):
    codes: dict[int, ProductCode] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vecs = b.column("vec").to_pylist()
            dims = np.array([len(v) // 8 for v in vecs])
            lists: list = [None] * len(vecs)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = matrix(vecs[i] for i in at)
                if d not in codes:
                    codes[d] = ProductCode(int(d), size, cosine, recall)
                for i, f in zip(at, codes[d].decode(x / np.abs(x).max(1, keepdims=True) /
                                                np.linalg.norm(x / np.abs(x).max(1, keepdims=True), axis=1, keepdims=True))):
                    lists[i] = f
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(dims, pa.int32()), b.column("id"), b.column("m"),
                                              pa.array([short(v) for v in vecs], pa.binary()), pa.array(lists, pa.list_(pa.int32()))],
                                             ["label", "dim", "id", "m", "vec", "filters"])
    return run


def _tile(pdf: pd.DataFrame, cosine: float) -> tuple[list, list, list]:
    """Links of one tile, each pair in its smallest common filter: (id, other links, smallest linked id here)."""
    f, bi, bj = (int(pdf[k].iloc[0]) for k in ("filter", "bi", "bj"))
    x = doubles(pdf["vec"], int(pdf["dim"].iloc[0]))
    norm = np.sqrt((x * x).sum(1))
    ids, m, block = pdf["id"].to_numpy(), pdf["m"].to_numpy(), pdf["block"].to_numpy()
    link = (x @ x.T) / (norm[:, None] * norm[None, :]) >= cosine
    np.fill_diagonal(link, False)
    if bi != bj:  # pairs within a block have a tile of their own
        link &= block[:, None] != block[None, :]
    some = np.flatnonzero(link.any(1))
    if not len(some):
        return [], [], []
    link, ids, m = link[np.ix_(some, some)], ids[some], m[some]
    mine = [q[:np.searchsorted(q, f)] for q in (pdf["filters"].iloc[i] for i in some)]
    smaller = np.unique(np.concatenate(mine))
    if len(smaller):
        has = np.zeros((len(some), len(smaller)), np.float32)
        for r, q in enumerate(mine):
            has[r, np.searchsorted(smaller, q)] = 1
        link &= (has @ has.T) == 0
    root = ids.copy()
    while True:
        low = np.minimum(root, np.where(link, root[None, :], root[:, None]).min(1))
        if (low == root).all():
            break
        root = low
    count = (link * m[None, :]).sum(1)
    at = np.flatnonzero(count)
    return list(ids[at]), list(count[at]), list(root[at])


def _tiles(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held = ["label", "dim", "filter", "bi", "bj"], None
        out: tuple[list, list, list] = ([], [], [])

        def flush():
            r = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["id", "n", "root"])
            for c in out:
                c.clear()
            return r

        for b in batches:
            pdf = b.to_pandas()
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            k = pdf[keys].to_numpy()
            cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo > 1:
                    for c, v in zip(out, _tile(pdf.iloc[lo:hi], cosine)):
                        c += v
            held = pdf.iloc[cuts[-1]:]
            yield flush()
        if held is not None and len(held) > 1:
            for c, v in zip(out, _tile(held, cosine)):
                c += v
            yield flush()
    return run


def near_duplicates(table: DataFrame, scratch: Scratch, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept, for every row of (vec_id, embedding, label)."""
    rows = scratch.cut(as_bytes(table))
    classes = scratch.cut(rows.where("key IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL").groupBy("label", "key").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("m"), F.max("vec").alias("vec")))
    size = max(32, math.ceil(math.sqrt(classes.count() / 4)))
    listed_in = scratch.cut(classes.select("label", "id", "m", "vec").mapInArrow(
        _filters(size, cosine, recall), "label int, dim int, id long, m long, vec binary, filters array<int>"))
    # which tiles each vector goes to, on (id, filter) rows without vectors
    pairs = listed_in.select("label", "dim", "id", F.explode("filters").alias("filter"))
    load = (pairs.groupBy("label", "dim", "filter")
            .agg(F.ceil(F.count("*") / F.lit(TILE)).cast("int").alias("blocks"), F.count("*").alias("c")).where("c > 1").drop("c"))
    at = pairs.join(load, ["label", "dim", "filter"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    at = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    at = at.groupBy("label", "id").agg(F.collect_list(F.struct(
        "filter", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block")).alias("tiles"))
    # vectors are shuffled once, to their tiles
    member = listed_in.join(at, ["label", "id"]).select("label", "dim", F.explode("tiles").alias("t"), "id", "m", "vec", "filters")
    member = member.select("label", "dim", "t.*", "id", "m", "vec", "filters")
    tiles = member.repartition("label", "dim", "filter", "bi", "bj").sortWithinPartitions("label", "dim", "filter", "bi", "bj")
    part = scratch.cut(tiles.mapInArrow(_tiles(cosine), "id long, n long, root long"))
    comp = components(part.select(F.col("id").alias("a"), F.col("root").alias("b")), scratch)
    links = part.groupBy("id").agg(F.sum("n").alias("n"))
    found = scratch.cut(classes.select("label", "key", "id", "m").join(links, "id", "left").join(comp, "id", "left").select(
        "label", "key", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    out = rows.select("vec_id", "label", "key").join(found, ["label", "key"], "left")
    comp_id = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.when(F.col("vec_id").isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
                      comp_id.alias("component_id"), F.col("vec_id").eqNullSafe(comp_id).alias("kept"))


def op4_cap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"), Scratch(spark, "caps"))
