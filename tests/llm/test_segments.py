"""Segments, the worker's cache of their ids, and what a worker gives back."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fleetlake.llm import bpe, common, segments, tokenfiles

PIECES = ["word", "a", "é", "Éa", "×", ".", ",", "!", "'s", "'", "12", " ", "  ", "\n", "\r\n", "\t", " ", " ", "　", " ", "\u0085",
          "᠎", "​", "﻿", "\x1c", "\x0b", "\x00", "<", "<|endoftext|>", "<|endof", "中文", "🙂", "’", "-", "é", "º", "…"]


def _texts(seed, n=3000):
    rng = random.Random(seed)
    return [None, ""] + ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def _library():
    from tokenizers import Tokenizer
    path = tokenfiles.vocabulary_path(tokenfiles.VOCABULARY)
    tok = Tokenizer.from_file(path)
    return tokenfiles.word_cache(path), lambda t: tok.encode(t, add_special_tokens=False).ids


def _ranks():
    import public_tokenizers
    import tiktoken
    enc, cache = bpe.load(tokenfiles.vocabulary_path(bpe.VOCABULARY))
    return cache, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=enc.ranks, special_tokens={}).encode_ordinary


@pytest.mark.parametrize("make", [_library, _ranks])
def test_cut_texts_have_the_ids_of_whole_texts(make, monkeypatch):
    monkeypatch.setattr(segments, "CACHE_WORDS", 700)  # shrinks on the way
    cache, whole = make()
    for seed in range(6):
        texts = _texts(seed % 4)
        ids, off = cache.encode_column(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert ids[off[i]:off[i + 1]].tolist() == list(whole(t or "")), repr(t)


def test_segments_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(segments, "byte_hashes", lambda raw, start, end: (end - start).astype(np.uint64))
    cache = segments.WordCache(lambda words: [np.array([*w.encode()], np.int32).tobytes() for w in words])
    for texts in (["ab cd ef", "xy"], ["ab cd ef", "xy", "a\n\n b"], ["pq"]):
        ids, off = cache.encode_column(pa.array(texts))
        assert [bytes(ids[a:b].tolist()).decode() for a, b in zip(off[:-1], off[1:])] == texts


def test_a_full_cache_keeps_the_words_met_again(monkeypatch):
    """It lost all of them: each word was encoded again and again, and a mark behind it made it another word."""
    monkeypatch.setattr(segments, "CACHE_WORDS", 1000)
    asked = []
    cache = segments.WordCache(lambda words: asked.extend(words) or [b"\0\0\0\0"] * len(words))
    often = " ".join(f"often{i}" for i in range(100))
    for k in range(30):
        cache.encode_column(pa.array([often, often.replace(" ", ", "), " ".join(f"once{k}x{i}" for i in range(200))]))
    assert max(asked.count(f" often{i}") for i in range(1, 100)) == 1 and len(cache.keys) == len(cache.place) == cache.again.n <= 1500


def _anonymous():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read()).group(1)) // 1024


def test_freed_memory_goes_back_to_the_machine():
    """A worker kept some 170 MB of what the BPE stage had freed, beside toxicity's index."""
    common.free_caches()
    before = _anonymous()
    left = [bytes(9000) for _ in range(20_000)]  # too small for pages of their own
    kept = left[::4000]
    del left
    common.free_caches()
    assert _anonymous() - before < 60 and len(kept) == 5
