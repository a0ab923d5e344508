"""Lexical search: what a task holds does not grow with its share of the input."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from fleetlake.llm import common, lexsearch
from fleetlake.llm.common import Scratch


def texts(n, words=300, seed=0):
    rng = np.random.default_rng(seed)
    return [" ".join(f"w{x}" for x in rng.zipf(1.3, words) % 50_000) for _ in range(n)]


def in_process(monkeypatch):
    monkeypatch.setattr(lexsearch, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))


def test_segments_do_not_depend_on_batches(monkeypatch):
    in_process(monkeypatch)
    t = [*texts(400), None, ""]
    whole = pa.record_batch([pa.array(range(len(t)), pa.int64()), pa.array(t)], ["doc_id", "text"])
    size = sum(len(x or "") for x in t)
    runs = {}
    for rows in (1, 7, 50, 1000):
        out = list(lexsearch._segments(100_000)(whole.slice(i, rows) for i in range(0, len(t), rows)))
        runs[rows] = len(out)
        assert [b.column("seg")[0].as_py() for b in out] == [(3 << 32) + i for i in range(len(out))]
        assert [d for b in out for d in b.column("docs")[0].as_py()] == list(range(len(t)))
        assert sum(sum(b.column("tf")[0].as_py()) for b in out) == 400 * 300
    assert max(runs.values()) <= size / 100_000 + 1


def test_cutting_words_takes_bounded_memory(monkeypatch):
    """Four MB of text were hashed at a time: 169 MB."""
    in_process(monkeypatch)
    t = texts(400) * 12
    b = pa.record_batch([pa.array(range(len(t)), pa.int64()), pa.array(t)], ["doc_id", "text"])
    assert b.nbytes > 5_000_000
    common._powers(common.CHUNK_BYTES + 1)  # kept by the worker, not by the segment
    tracemalloc.start()
    for _ in lexsearch._segments(lexsearch.SEGMENT_BYTES)(iter([b])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 130_000_000, peak


def test_workers_get_a_segment_at_a_time(spark, monkeypatch, tmp_path):
    docs = spark.createDataFrame(list(enumerate(texts(600))), "doc_id long, text string").coalesce(1)
    scratch = Scratch(spark, "t")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    index = lexsearch.build_index(docs, scratch, segment_bytes=30_000)
    n = index.segments.count()
    assert n > 10
    files = [f.removeprefix("file:") for f in index.segments.inputFiles()]
    assert sum(pq.ParquetFile(f).num_row_groups for f in files) == n
    with common.small_batches(spark, 50_000):
        rows = index.segments.coalesce(1).mapInArrow(lambda bs: (pa.record_batch([pa.array([b.num_rows])], ["n"]) for b in bs if b.num_rows), "n long").collect()
    assert sum(r.n for r in rows) == n and max(r.n for r in rows) <= 3
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_small_batches_are_restored_after_a_failure(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        with common.small_batches(spark):
            assert spark.conf.get(key) == str(common.CHUNK_BYTES)
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(key) == before
