"""Shared helpers: scratch tables, Arrow slicing, word hashing, connected components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import scratch_path

CHUNK_BYTES = 1 << 20  # text handled by one round of vectorised work (one longer text still goes whole)
FILE_BYTES = 4 << 20  # of a table that is written like another


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def unused_name(name: str, columns: Iterable[str]) -> str:
    """A helper column's name that no column of the input has, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


class Scratch:
    """Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names.

    ``cut`` writes a frame as Parquet and rereads it, so that later work does not depend on the executors
    that made it; ``drop`` deletes such a table early; what is left goes when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}"), 0
        path, fs = self._fs(self.root)
        fs.deleteOnExit(path)

    def _fs(self, where: str):
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(conf)

    def path(self) -> str:
        self.n += 1
        return f"{self.root}/{self.n}"

    def cut(self, df: DataFrame, *like: DataFrame, group_rows: int | None = None) -> DataFrame:
        """``like``: written tables, together about as large as ``df`` at least. It is then written in files of about
        ``FILE_BYTES`` of theirs, one per core at least, not in one per shuffle partition: on a local file system
        each file costs processes that change its mode.

        ``group_rows``: rows of a row group at most, for rows of some MB: a writer and a reader hold a row group of each file."""
        if like:
            size = 0
            for x in like:
                path, fs = self._fs(x._scratch)
                size += fs.getContentSummary(path).getLength()
            df = df.coalesce(max(self.spark.sparkContext.defaultParallelism, -(-size // FILE_BYTES)))
        where = self.path()
        (df.write.option("parquet.block.row.count.limit", group_rows) if group_rows else df.write).parquet(where)
        gc.collect()  # frames that nothing names any more free their shuffle files
        self.spark._jvm.System.gc()
        out = self.spark.read.schema(df.schema).parquet(where)
        out._scratch = where
        return out

    def write_bytes(self, name: str, data: bytes) -> None:
        """A file of its own in this folder."""
        path, fs = self._fs(f"{self.root}/{name}")
        out = fs.create(path)
        for lo in range(0, len(data), 8 << 20):
            out.write(bytearray(data[lo:lo + (8 << 20)]))
        out.close()

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path, fs = self._fs(df._scratch)
            fs.delete(path, True)


def row_ids(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """``docs`` and the name of a column in it that tells its rows apart, in the order of doc_id (null last).

    That is doc_id where it does; with null or repeated ones the rows are written with a column of their own, so that
    none of them is passed over or taken for another.
    """
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if repeated.isEmpty():
        return docs, "doc_id"
    key = unused_name("row_id", docs.columns)
    order = [F.asc_nulls_last("doc_id"), F.xxhash64("text").asc()]
    ordered = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch.cut(ordered.withColumn(key, F.monotonically_increasing_id())), key


@contextmanager
def small_batches(spark: SparkSession, limit: int = CHUNK_BYTES) -> Iterator[None]:
    """What is run inside sends its Python workers Arrow batches of about ``limit`` bytes (a larger row goes alone); as
    many rows as Spark sends otherwise can be any size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_LIBC = ctypes.CDLL(None)
_kept: dict = {}


def worker_cache(key, make):
    """What ``make`` gives, kept in a Python worker until a task asks for another or frees it: workers outlive stages."""
    if key not in _kept:
        free_caches()
        _kept[key] = make()
    return _kept[key]


def free_caches() -> None:
    """Frees what an earlier stage's tasks left in this Python worker."""
    if _kept:
        _kept.clear()
        gc.collect()
    release_memory()


def release_memory() -> None:
    """Gives freed memory, which Arrow's pool and the C library would keep, back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def arrow_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of ``column`` (never less than one row)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        col = b.column(b.schema.get_field_index(column))
        size = np.nan_to_num(np.asarray(pc.binary_length(col).to_numpy(zero_copy_only=False), dtype=np.float64))
        group = (np.cumsum(size) // limit).astype(np.int64)
        cuts = np.flatnonzero(np.diff(group)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
            yield b.slice(lo, hi - lo)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(0, 2**64, 256, dtype=_U, endpoint=False) | _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_pow: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_pow[0]) < n:
        size = max(n, CHUNK_BYTES)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _pow[i] = np.cumprod(steps, dtype=_U)
    return _pow


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(raw: np.ndarray, off: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text: A-Z lower-cased, cut at the bytes that ``gap`` marks (ASCII white space).

    Returns (64-bit hash, first byte, end byte) of every word and, per text, the index of its first word
    (one more entry closes the last text).
    """
    low = _LOWER[raw]
    n = len(low)
    solid = np.zeros(n + 1, bool)
    solid[:n] = ~gap[low]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.zeros(n + 1, bool)
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | edge))
    end = np.flatnonzero(before & (~solid | edge))
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, _U)
    np.cumsum(_TABLE[low] * up[:n], out=total[1:])
    h = mix64((total[end] - total[start]) * down[start] + (end - start).astype(_U))
    return h, start, end, np.searchsorted(start, off)


def byte_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes from each start to its end."""
    up, down = _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, _U)
    np.cumsum(_TABLE[raw] * up[:len(raw)], out=total[1:])
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(_U))


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... size[0] of them, then those of start[1], and so on."""
    return np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(size) else np.zeros(0, np.int64)


def sequence_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k neighbouring words (runs over a text's end are the caller's to leave out)."""
    if len(h) < k:
        return np.zeros(0, _U)
    n = len(h) - k + 1
    x = np.full(n, _U(k))
    for i in range(k):
        x = mix64(x * _U(0x2545F4914F6CDD1D) + h[i:i + n])
    return x


def shingle_sets(raw: np.ndarray, off: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (under k words: the whole sequence as one; none: empty)."""
    h, _, _, first = word_hashes(raw, off)
    runs = sequence_hashes(h, k)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= k:
            out.append(np.unique(runs[a:b - k + 1]))
        elif b > a:
            out.append(sequence_hashes(h[a:b], b - a))
        else:
            out.append(runs[:0])
    return out


def components(edges: DataFrame, scratch: Scratch, *like: DataFrame, rounds: int = 50) -> DataFrame:
    """(id, component): smallest id reachable over undirected ``edges`` (a, b), for every id on an edge.

    ``like``: written tables that hold the edges. Alternating star contraction: each round hangs every node's neighbours under the smallest one. Rounds
    are written tables; the driver sees one count per round.
    """
    star = scratch.cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .where("u <> v").distinct(), *like)
    for _ in range(rounds):
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = scratch.cut(low, star)
        # large star: neighbours above u hang under the smallest around u
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.cut(large.where("u <> v").distinct(), star)
        # small star: u and its neighbours below hang under the smallest of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        small = scratch.cut(small, large)
        nxt = (large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        nxt = scratch.cut(nxt, large, small)
        # done when every u has one v and no v is itself a u
        done = (nxt.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
                and nxt.join(nxt.select(F.col("u").alias("v")), "v", "left_semi").isEmpty())
        scratch.drop(star, low, large, small)
        star = nxt
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return (star.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(star.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
