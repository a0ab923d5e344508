"""Vectors as bytes: which rows take part, and one row per distinct vector."""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec (little-endian doubles) and key (its MD5); null where a vector is null, zero, or not finite throughout."""
    for b in batches:
        col = b.column("embedding")
        off = col.offsets.to_numpy()
        flat = col.values.cast(pa.float64())
        val = np.asarray(flat.to_numpy(zero_copy_only=False), np.float64)  # a null component reads as NaN
        fine = np.isfinite(val)
        vec = []
        for ok, lo, hi in zip(col.is_valid().to_pylist(), off[:-1], off[1:]):
            x = val[lo:hi]
            with np.errstate(over="ignore"):
                ok = ok and hi > lo and fine[lo:hi].all() and np.isfinite(n := x @ x) and n > 0
            vec.append((x + 0.0).astype("<f8").tobytes() if ok else None)
        key = [None if v is None else hashlib.md5(v).digest() for v in vec]
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(vec, pa.binary()), pa.array(key, pa.binary())],
                                         ["vec_id", "label", "vec", "key"])


SCHEMA = "vec_id long, label int, vec binary, key binary"


def as_bytes(table):
    return table.selectExpr("cast(vec_id as long) vec_id", "cast(label as int) label", "embedding").mapInArrow(_bytes, SCHEMA)


def matrix(vecs) -> np.ndarray:
    vecs = list(vecs)
    return np.frombuffer(b"".join(vecs), "<f8").reshape(len(vecs), -1)
