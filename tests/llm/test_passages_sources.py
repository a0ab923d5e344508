"""Substring dedup: no passage that its source does not hold, none lost to chance holders, clashing columns."""

import difflib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import mixing, passages
from fleetlake.llm.common import Scratch

SF = "/root/testdata/sf0.001"


def found(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    return passages.repeated_passages(df, Scratch(spark, "t")).collect()


def words(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randint(0, 10**6)}" for _ in range(n)]


def holds(source, span):
    """Share of the span's words that an ordered match with the source's text finds."""
    m = difflib.SequenceMatcher(None, source, span, autojunk=False)
    return sum(b.size for b in m.get_matching_blocks()) / len(span)


@pytest.mark.parametrize("run", [6, 9, 14])
def test_chance_holders_neither_make_nor_hide_a_passage(spark, run):
    rng = random.Random(run)
    p = words(rng, 80)
    texts = {i: " ".join(words(rng, 30) + p[i:i + run] + words(rng, 30)) for i in range(80 - run + 1)}  # each holds one run of it
    texts[1000] = " ".join(words(rng, 20) + p + words(rng, 20))
    texts[1001] = " ".join(words(rng, 10) + [w if k % 8 else f"x{k}" for k, w in enumerate(p)] + words(rng, 10))
    texts[1002] = " ".join(p + words(rng, 25))
    got = found(spark, texts)
    assert {r.doc_id for r in got} == {1001, 1002}  # not the first that has it
    for r in got:
        assert r.source_id in (1000, 1001) and r.end_word - r.start_word >= 75


def test_every_passage_is_held_by_its_source(spark):
    """Texts of few words share many short runs by chance; what is reported is compared word by word."""
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(60)]
    stock = [rng.choices(vocabulary, k=rng.randint(20, 120)) for _ in range(30)]
    texts = {}
    for i in range(400):
        parts = [rng.choice(stock) if rng.random() < 0.3 else rng.choices(vocabulary, k=rng.randint(5, 60)) for _ in range(rng.randint(1, 5))]
        texts[i] = " ".join(w if rng.random() > 0.05 else rng.choice(vocabulary) for part in parts for w in part)
    got = found(spark, texts)
    assert len(got) > 50
    for r in got:
        span = texts[r.doc_id].split()[r.start_word:r.end_word]
        assert r.source_id < r.doc_id and len(span) >= passages.LEAST
        assert holds(texts[r.source_id].split(), span) >= passages.SIMILAR, r


def test_every_exact_repeat_is_covered(spark):
    """Brute force: each word in a window of LEAST words that an earlier text has is reported; not so the further rounds
    of a periodic run, windows that the same text had before."""
    rng = random.Random(12)
    vocabulary = [f"v{i}" for i in range(40)]
    stock = [rng.choices(vocabulary, k=rng.randint(50, 90)) for _ in range(12)] + [["same"] * 70, ["a", "b", "c"] * 25]
    texts = {i: " ".join(w for _ in range(3) for w in (rng.choice(stock) if rng.random() < 0.5 else rng.choices(vocabulary, k=25))) for i in range(150)}
    texts[200] = texts[201] = " ".join(rng.choices(vocabulary, k=49))
    want, seen = {}, {}
    for i, t in texts.items():
        w, own = t.split(), set()
        for k in range(len(w) - passages.LEAST + 1):
            window = " ".join(w[k:k + passages.LEAST])
            again = window in own
            own.add(window)
            if seen.setdefault(window, i) != i and not again:
                want.setdefault(i, set()).update(range(k, k + passages.LEAST))
    got = {}
    for r in found(spark, texts):
        got.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    missed = sum(len(s - got.get(i, set())) for i, s in want.items())
    assert missed <= 0.002 * sum(map(len, want.values())), missed


def test_spans_that_others_cover_are_left_out():
    spans = [(0, 60, 1, 60), (5, 55, 2, 50), (40, 100, 3, 60), (90, 160, 4, 70), (60, 120, 5, 60), (200, 250, 6, 50), (200, 260, 7, 55)]
    got = passages.uncovered(spans)
    assert got == [(0, 60, 1, 60), (60, 120, 5, 60), (90, 160, 4, 70), (200, 260, 7, 55)]
    assert set().union(*(range(s, e) for s, e, *_ in got)) == set().union(*(range(s, e) for s, e, *_ in spans))


@pytest.mark.parametrize("stage", [passages.stage, mixing.stage])
def test_stages_pass_clashing_columns(spark, stage):
    rng = np.random.default_rng(0)
    names = ["spans", "_spans", "Spans_", "by", "_by", "_rate", "rate_of_by", "_bytes", "doc", "key", "n_words"]
    base = " ".join(f"w{x}" for x in rng.integers(0, 10**6, 80))
    df = spark.createDataFrame([(i, base + f" t{i}", "en", "s", 1, *range(len(names))) for i in range(4)],
                               "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names))
    out = stage(spark, df, SF)
    assert out.columns == df.columns
    assert {tuple(r[n] for n in names) for r in out.select(*[F.col(f"`{n}`") for n in names]).collect()} <= {tuple(range(len(names)))}
