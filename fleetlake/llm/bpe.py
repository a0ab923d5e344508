"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece there is one token that can end its encoding; the encoder stores just that token
per prefix. A token may follow the last token of the prefix before it exactly if merging the bytes of the two
by rank gives the same two tokens back, so a piece is encoded in one pass, appending bytes costs only the new
prefixes, and after an edit only the prefixes behind it are made anew. Texts are cut by the public pattern
first, and a piece that is itself a token is that token, as rank-based BPE has it.

Defined cases: a null or empty text has no ids; rows repeated in full give repeated rows; an empty table gives
an empty table; columns of the input other than doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from fleetlake.llm.common import arrow_slices, ranges, read_table, release_memory, worker_cache
from fleetlake.llm.segments import WordCache
from fleetlake.llm.tokenfiles import vocabulary_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
SLICE = 1 << 19  # bytes of text encoded at a time: bounds what a task holds
PAIRS_KEPT = 400_000  # what a worker remembers; changes no result


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[int, bool] = {}  # a << 32 | b
        self.whole: dict[int, bool] = {}
        size = np.zeros(max(self.tokens) + 1, np.int64)
        for r, t in self.tokens.items():
            size[r] = len(t)
        self.size, self.begin = size, np.concatenate([[0], np.cumsum(size)[:-1]])
        self.flat = np.frombuffer(b"".join(self.tokens.get(r, b"") for r in range(len(size))), np.uint8)

    def merged(self, data: bytes) -> list[int]:
        """Merging by lowest rank, first place first. Used on pairs of tokens only."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def follows(self, a: int, b: int) -> bool:
        ok = self.pairs.get(a << 32 | b)
        if ok is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            ok = self.pairs[a << 32 | b] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return ok

    def reachable(self, t: int) -> bool:
        ok = self.whole.get(t)
        if ok is None:
            ok = self.whole[t] = self.merged(self.tokens[t]) == [t]
        return ok

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Fill ``last`` (last token of each prefix of ``data``, from the empty one's -1) up to all of ``data``."""
        get, pairs = self.ranks.get, self.pairs
        for i in range(len(last), len(data) + 1):
            for j in range(max(0, i - self.longest), i):
                t = get(data[j:i])
                if t is not None:
                    if j == 0:
                        if self.reachable(t):
                            break
                    else:
                        ok = pairs.get(last[j] << 32 | t)
                        if self.follows(last[j], t) if ok is None else ok:
                            break
            else:
                raise ValueError("a byte has no token")
            last.append(t)
        return last

    def back(self, last: list[int]) -> list[int]:
        out, i = [], len(last) - 1
        while i:
            out.append(last[i])
            i -= len(self.tokens[last[i]])
        return out[::-1]

    def piece(self, data: bytes) -> list[int]:
        t = self.ranks.get(data)
        return [t] if t is not None else self.back(self.extend(data, [-1]))

    def encode(self, text: str) -> list[int]:
        return [t for p in self.pattern.findall(text) for t in self.piece(p.encode())]

    def decode_all(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts whose ids stand at their offsets."""
        n = self.size[ids]
        return self.flat[ranges(self.begin[ids], n)], np.append(0, np.cumsum(n))[off]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.decode_all(ids, np.array([0]))[0].tobytes()


class Editable:
    """One piece with its prefix table: exact appends and edits that redo only what lies behind them."""

    def __init__(self, bpe: Bpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, data, bpe.extend(data, [-1])

    def append(self, more: bytes) -> Editable:
        return self.replace(len(self.data), len(self.data), more)

    def replace(self, start: int, end: int, new: bytes) -> Editable:
        self.data = self.data[:start] + new + self.data[end:]
        del self.last[start + 1:]
        self.bpe.extend(self.data, self.last)
        return self

    def ids(self) -> list[int]:
        t = self.bpe.ranks.get(self.data)
        return [t] if t is not None else self.bpe.back(self.last)


def load(path: str) -> tuple[Bpe, WordCache]:
    """Encoder and word cache of a rank file, one per Python worker."""
    def make() -> tuple[Bpe, WordCache]:
        import public_tokenizers

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        bpe = Bpe(ranks, public_tokenizers.PATTERN)

        def encode(segments: list[str]) -> list[bytes]:
            return [array("i", bpe.encode(s)).tobytes() for s in segments]

        return bpe, WordCache(encode)

    return worker_cache(("bpe", path), make)


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = load(path)
        for b in arrow_slices(batches, limit=SLICE):
            ids, off = cache.encode_column(b.column("text"))
            back, ends = bpe.decode_all(ids, off)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(off), pa.int64()), _sha256(ids.astype("<u4", copy=False), off), _sha256(back, ends)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            release_memory()
    return run


def _sha256(values: np.ndarray, off: np.ndarray) -> pa.Array:
    raw, at = memoryview(np.ascontiguousarray(values)).cast("B"), (off * values.itemsize).tolist()
    return pa.array([hashlib.sha256(raw[lo:hi]).hexdigest() for lo, hi in zip(at[:-1], at[1:])], pa.string())


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cache = load(path)
        for b in arrow_slices(batches, limit=SLICE):
            ids, off = cache.encode_column(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])
    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = load(path)
        for b in batches:
            back = [bpe.decode(np.array(x or [], np.int64)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(back, pa.binary())], ["doc_id", "bytes"])
    return run


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text."""
    return _body(docs).mapInArrow(_encode(path or vocabulary_path(VOCABULARY)), "doc_id long, ids array<int>")


def decode(ids: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, bytes) of every row of ids."""
    return ids.select("doc_id", "ids").mapInArrow(_decode(path or vocabulary_path(VOCABULARY)), "doc_id long, bytes binary")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Count and SHA-256 of each text's ids, and of what they decode to."""
    return _body(docs).mapInArrow(_digests(path or vocabulary_path(VOCABULARY)), SCHEMA)


def _body(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return digests(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digests(docs)
