"""Token ids as ORC files: integer run lengths, row indexes and Bloom filters on doc_id.

Texts are range-partitioned and sorted by doc_id, encoded in their partitions, and written as one ORC file per
partition whose stripes carry run-length encoded ids, a row index every ``ROW_INDEX`` rows and a Bloom filter
on doc_id: readers split at stripes, and a lookup by doc_id skips files, stripes and row groups from metadata.

Defined cases: a special token's string in a text gets that token's id, as the library's own call does;
a null or empty text is the end id alone; a null doc_id comes first; rows that share a doc_id
follow each other in the order of their text's hash; an empty table gives no rows; columns of the input other
than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch, arrow_slices, read_table, worker_cache
from fleetlake.llm.segments import WordCache

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
ROW_INDEX = 1000
AT_ONCE = 500  # segments encoded at a time: bounds the library's objects
FILE_SCHEMA = "part int, slot long, doc_id long, ids array<int>"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_cache(path: str) -> WordCache:
    """One per Python worker and vocabulary."""
    def make() -> WordCache:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)

        def alone(words: list[str]) -> list[bytes]:
            return [array("i", e.ids).tobytes() for lo in range(0, len(words), AT_ONCE)
                    for e in tok.encode_batch_fast(words[lo:lo + AT_ONCE], add_special_tokens=False)]

        size = np.zeros(tok.get_vocab_size(), np.int64)  # bytes of each token: its characters stand for bytes
        for token, i in tok.get_vocab().items():
            size[i] = len(token)

        def encode(words: list[str]) -> list[bytes]:
            out: list[bytes | None] = [None] * len(words)
            # words with a space in front stay whole behind each other: far fewer calls than one a word
            spaced = [i for i, w in enumerate(words) if w[0] == " " and w[-1].isalnum()]
            for lo in range(0, len(spaced), AT_ONCE):
                some = spaced[lo:lo + AT_ONCE]
                ids = np.array(tok.encode_batch_fast(["".join([words[i] for i in some])], add_special_tokens=False)[0].ids, np.int32)
                ends, want = np.cumsum(size[ids]), np.cumsum([len(words[i].encode()) for i in some])
                at = np.searchsorted(ends, want) + 1
                if at[-1] == len(ids) and (ends[at - 1] == want).all():
                    raw = ids.tobytes()
                    for i, a, b in zip(some, [0, *(4 * at[:-1]).tolist()], (4 * at).tolist()):
                        out[i] = raw[a:b]
            rest = [i for i, x in enumerate(out) if x is None]
            for i, x in zip(rest, alone([words[i] for i in rest])):
                out[i] = x
            return out

        return WordCache(encode)

    return worker_cache(("token files", path), make)


def _encoder(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, slot = word_cache(path), 0
        part = TaskContext.get().partitionId()
        for b in arrow_slices(batches):
            ids, off = cache.encode_column(b.column("text"))
            n = b.num_rows
            ids, off = np.insert(ids, off[1:], end_id), off + np.arange(n + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(slot, slot + n)), b.column("doc_id"),
                 pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))], ["part", "slot", "doc_id", "ids"])
            slot += n
    return run


def write_tokens(docs: DataFrame, out: str, path: str, end_id: int = END_ID) -> None:
    """Encode every text and write the ids under ``out`` in ascending doc_id order."""
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    body = body.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    (body.mapInArrow(_encoder(path, end_id), FILE_SCHEMA).write.option("compression", "zstd")
     .option("orc.row.index.stride", ROW_INDEX).option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", 0.01).orc(out))


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).orc(out)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("ids")
        off = ids.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False))).cast("B")
        crc = [zlib.crc32(raw[4 * lo:4 * hi]) for lo, hi in zip(off[:-1], off[1:])]
        yield pa.RecordBatch.from_arrays([b.column("part"), b.column("slot"), b.column("doc_id"),
                                          pa.array(np.diff(off).astype(np.int64)), pa.array(crc, pa.int64())],
                                         ["part", "slot", "doc_id", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, out: str, scratch: Scratch) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files: ``start`` counts all ids before it."""
    rows = scratch.cut(read_tokens(spark, out).mapInArrow(
        _checksums, "part int, slot long, doc_id long, n_tokens long, ids_crc32 long"))
    # one row per file
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file0"))
    within = W.partitionBy("part").orderBy("slot").rowsBetween(W.unboundedPreceding, 0)
    return (rows.withColumn("upto", F.sum("n_tokens").over(within)).join(F.broadcast(files), "part")
            .select("doc_id", (F.col("file0") + F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as ORC, read back."""
    scratch = Scratch(spark, "tokens")
    out = scratch.path()
    write_tokens(read_table(spark, sf_dir, "documents", "doc_id", "text"), out, vocabulary_path(VOCABULARY))
    return token_index(spark, out, scratch)
