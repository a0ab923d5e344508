"""Recall of cap filters at every size, special tokens in texts, shard sizes."""

import math
import zlib
from array import array

import numpy as np
import pytest

from fleetlake.llm import capjoin, sharding, tokenfiles
from fleetlake.llm.common import Scratch


@pytest.mark.parametrize("size", [50, 500, 3163])
@pytest.mark.parametrize("d", [16, 64])
def test_pairs_share_a_filter_at_every_code_size(size, d):
    code = capjoin.ProductCode(d, size)
    rng = np.random.default_rng([size, d])
    x, z = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.standard_normal((2, 1000, d)))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * z
    shared = [len(np.intersect1d(a, b)) > 0 for a, b in zip(code.decode(x), code.decode(y))]
    assert np.mean(shared) >= 0.98


def test_special_tokens_in_texts_as_the_library_has_them(spark):
    from tokenizers import Tokenizer
    texts = ["a<|endoftext|>b", "a <|endoftext|> b", "<|endoftext|>\n<|endoftext|>", "x  <|endoftext|>", "<|endoftext", None, "", "a\nb c\nd", "a\n\nb", " \n"]
    tok = Tokenizer.from_file(tokenfiles.vocabulary_path(tokenfiles.VOCABULARY))
    s = Scratch(spark, "t")
    out = s.path()
    tokenfiles.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), out, tokenfiles.vocabulary_path(tokenfiles.VOCABULARY))
    got = {r.doc_id: r for r in tokenfiles.token_index(spark, out, s).collect()}
    for i, t in enumerate(texts):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, tokenfiles.END_ID]
        assert (got[i].n_tokens, got[i].ids_crc32) == (len(ids), zlib.crc32(array("I", ids).tobytes())), t


def test_shards_hold_equal_bytes(spark):
    rng = np.random.default_rng(4)
    texts = ["x" * int(n) for n in rng.integers(0, 400, 3000)] + ["copy " * 30] * 1000 + [None, ""]
    rows = sharding.shard_by_bytes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), Scratch(spark, "t")).collect()
    assert {r.doc_id: r.size for r in rows} == {i: len(t or "") + 16 for i, t in enumerate(texts)}
    size, slots = {}, {}
    for r in rows:
        size[r.shard] = size.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    target, most = sum(size.values()) / 40, max(r.size for r in rows)
    assert set(size) == set(range(40)) and all(abs(n - target) <= most for n in size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
