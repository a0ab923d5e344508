"""Centroid clustering on bit planes.

A component x becomes the integer floor(``SCALE`` * x). Plane b of a vector holds bit b of its 64 integers in one
unsigned 64-bit word; with two's complement of ``planes`` bits the last plane weighs -2^b, the others 2^b. The dot
product of two vectors is the sum over plane pairs of weight * weight * popcount(word AND word), a whole number
without rounding, and |v|^2 + |c|^2 - 2 v.c is the exact squared distance.

How many planes are needed follows from the largest and smallest component (one aggregation). The planes are
written once; every round is one pass over them with the few centroid planes in the task's closure. A task adds up
its vectors by cluster (bit counts per plane) before anything is shuffled, so a cluster that holds a third of all
rows costs one row per task; the driver receives ``K`` rows a round. Rounds stop early once the centroids stay as
they are, since every later round would give them again.

Defined cases: only vectors of exactly 64 components, none null or non-finite, are kept, the zero vector among
them; rows with a null vec_id are clustered, but are no starting centroid; rows that share a vec_id are clustered
each on its own, and as starting centroids go in the order of their planes, rows repeated in full counting once
each; with fewer than ``K`` kept rows there are that many centroids; an empty table gives an empty table. Integers
of ``2**LIMIT_BITS`` and more would leave 64-bit distances and raise an error. Columns other than vec_id and
embedding are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch, read_table

DIM = 64
SCALE = 1024
K = 8
ROUNDS = 10
SALT = "3"
LIMIT_BITS = 26
CHUNK = 4096  # vectors of one round of popcounts


def kept_vectors(table: DataFrame) -> DataFrame:
    """vec_id and the components as doubles, of the rows that take part."""
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
            .where(F.size("e") == DIM).where(fine))


def weights(planes: int) -> np.ndarray:
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def pack_planes(v: np.ndarray, planes: int) -> np.ndarray:
    """(n, planes) words of (n, 64) integers."""
    bits = (v[:, None, :] >> np.arange(planes, dtype=np.int64)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def plane_counts(words: np.ndarray) -> np.ndarray:
    """(planes, 64): in how many of the vectors each bit of each plane is set."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(len(words), words.shape[1], 8), axis=2, bitorder="little")
    return bits.sum(0, dtype=np.int64)


def dots(words: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact dot products of vectors with one centroid, both as planes."""
    w = weights(words.shape[1])
    out = np.zeros(len(words), np.int64)
    for cw, plane in zip(weights(len(centroid)), centroid):
        if plane:
            out += cw * (np.bitwise_count(words & plane).astype(np.int64) @ w)
    return out


def nearest(words: np.ndarray, norms: np.ndarray, centroids: np.ndarray, planes: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the squared distance, for each vector."""
    packed = pack_planes(centroids, planes)
    cluster, best = np.zeros(len(words), np.int32), None
    for i, (c, p) in enumerate(zip(centroids, packed)):
        d = norms + int(c @ c) - 2 * dots(words, p)
        if best is None:
            best = d
        else:
            less = d < best
            cluster[less], best[less] = i, d[less]
    return cluster, best


def _to_planes(planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = np.floor(SCALE * b.column("e").flatten().to_numpy().reshape(-1, DIM)).astype(np.int64)
            raw = np.ascontiguousarray(pack_planes(v, planes).astype("<u8"))
            off = np.arange(len(v) + 1, dtype=np.int32) * 8 * planes
            words = pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(off), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), words, pa.array((v * v).sum(1))], ["vec_id", "planes", "norm"])
    return run


def _read(b: pa.RecordBatch, planes: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    words = np.frombuffer(b"".join(b.column("planes").to_pylist()), "<u8").reshape(-1, planes)
    norms = b.column("norm").to_numpy()
    for lo in range(0, len(words), CHUNK):
        at = slice(lo, lo + CHUNK)
        yield at, words[at], norms[at]


def _sums(centroids: np.ndarray, planes: int):
    """Per task and cluster: how many vectors, and the sum of each component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, counts = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), planes, DIM), np.int64)
        for b in batches:
            for _, words, norms in _read(b, planes):
                cluster, _ = nearest(words, norms, centroids, planes)
                for c in np.unique(cluster):
                    mine = words[cluster == c]
                    n[c] += len(mine)
                    counts[c] += plane_counts(mine)
        total = np.einsum("cpd,p->cd", counts, weights(planes))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at]), *(pa.array(total[at, d]) for d in range(DIM))],
                                         ["cluster", "n", *(f"s{d}" for d in range(DIM))])
    return run


def _assign(centroids: np.ndarray, planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [nearest(words, norms, centroids, planes) for _, words, norms in _read(b, planes)]
            if got:
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), *(pa.array(np.concatenate(x)) for x in zip(*got))], ["vec_id", "cluster", "distance"])
    return run


def _components(planes_blob: bytes, planes: int) -> np.ndarray:
    return weights(planes) @ plane_counts(np.frombuffer(planes_blob, "<u8").reshape(1, planes))


def planes_needed(kept: DataFrame) -> int | None:
    """Two's-complement bits that hold every integer; None without vectors."""
    low, high = kept.agg(F.min(F.array_min("e")), F.max(F.array_max("e"))).first()
    if low is None:
        return None
    bits = max(int(np.floor(x * SCALE)).bit_length() if x >= 0 else (-int(np.floor(x * SCALE)) - 1).bit_length() for x in (low, high)) + 1
    if bits > LIMIT_BITS:
        raise OverflowError(f"components of {low} to {high} need {bits} bits; {LIMIT_BITS} keep distances in 64 bits")
    return bits


def cluster(table: DataFrame, scratch: Scratch, k: int = K, rounds: int = ROUNDS, salt: str = SALT) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector, written, and the final centroids."""
    kept = kept_vectors(table)
    planes = planes_needed(kept)
    if planes is None:
        return scratch.cut(kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))), np.zeros((0, DIM), np.int64)
    laid = scratch.cut(kept.mapInArrow(_to_planes(planes), "vec_id long, planes binary, norm long"))
    start = (laid.where("vec_id IS NOT NULL").select("planes", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256).alias("h"))
             .orderBy("h", "planes").limit(k).collect())
    if not start:  # every vec_id is null
        start = laid.orderBy("planes").limit(k).collect()
    centroids = np.array([_components(bytes(r.planes), planes) for r in start])
    sums = [F.sum(c).alias(c) for c in ("n", *(f"s{d}" for d in range(DIM)))]
    schema = "cluster int, n long, " + ", ".join(f"s{d} long" for d in range(DIM))
    for _ in range(rounds):
        new = centroids.copy()
        for r in laid.mapInArrow(_sums(centroids, planes), schema).groupBy("cluster").agg(*sums).collect():  # k rows
            new[r.cluster] = [r[f"s{d}"] // r.n for d in range(DIM)]
        if (new == centroids).all():
            break
        centroids = new
    return scratch.cut(laid.mapInArrow(_assign(centroids, planes), "vec_id long, cluster int, distance long")), centroids


def op12_bit_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings."""
    found, centroids = cluster(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), Scratch(spark, "kmeans"))
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    names = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    named = spark.createDataFrame(names, "cluster int, centroid_sha256 string")
    # K rows at most on each of the small sides
    per = per.join(F.broadcast(named), "cluster")
    total = per.agg(F.sum("cluster_inertia").alias("inertia")).first()[0]
    return found.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")


def oracle(k: int = K, rounds: int = ROUNDS, salt: str = SALT) -> str:
    """The same rounds in SQL, one pair of tables a round."""
    parts = [f"""kept as materialized (select vec_id, row_number() over (order by vec_id) as r, embedding as e from embeddings
  where len(embedding) = {DIM} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
             f"""v as materialized (select r, unnest(range({DIM})) as d,
  cast(floor({SCALE} * cast(unnest(e) as double)) as bigint) as x from kept)""",
             f"""s as (select r, row_number() over (order by h) - 1 as c from (select r, sha256('{salt}:' || vec_id) as h from kept order by h limit {k}))""",
             "m0 as materialized (select c, d, x as y from s join v using (r))"]
    for i in range(rounds + 1):
        parts.append(f"""a{i} as materialized (select r, c, w from (select r, c, w, row_number() over (partition by r order by w, c) as n
  from (select r, c, cast(sum((x - y) * (x - y)) as bigint) as w from v join m{i} using (d) group by r, c)) where n = 1)""")
        if i < rounds:
            parts.append(f"""m{i + 1} as materialized (select c, d, coalesce((t - ((t % n) + n) % n) // n, y) as y from m{i}
  left join (select c, d, cast(sum(x) as bigint) as t, count(*) as n from a{i} join v using (r) group by c, d) using (c, d))""")
    parts.append(f"g as (select c, sha256(string_agg(cast(y as varchar), ',' order by d)) as centroid_sha256 from m{rounds} group by c)")
    return "with " + ",\n".join(parts) + f"""
select vec_id, cast(c as integer) as cluster, w as distance, cast(sum(w) over (partition by c) as bigint) as cluster_inertia,
  cast(sum(w) over () as bigint) as inertia, centroid_sha256
from a{rounds} join kept using (r) join g using (c)"""


ORACLE = oracle()
