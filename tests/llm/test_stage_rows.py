"""The pipeline's stages work on every row: those without a doc_id or with one of several rows too."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetlake.llm import common, mixing, passages, setjoin, toxicity
from fleetlake.llm.common import Scratch

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n=120):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)


def left(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")


def test_row_ids_are_doc_ids_where_those_tell_rows_apart(spark, documents):
    rows, key = common.row_ids(documents, Scratch(spark, "t"))
    assert key == "doc_id" and rows is documents
    odd = documents.withColumn("row_id", F.lit(1)).unionByName(documents.limit(3).withColumn("row_id", F.lit(2))).unionByName(
        documents.limit(5).withColumn("doc_id", F.lit(None).cast("long")).withColumn("row_id", F.lit(3)))
    rows, key = common.row_ids(odd.repartition(5), Scratch(spark, "t"))
    got = rows.orderBy(key).collect()
    assert key not in odd.columns and len({r[key] for r in got}) == len(got) == 208
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: (d is None, d))


def test_duplicates_without_a_doc_id_go(spark):
    a, b, c, d, e = (words(i) for i in range(5))
    near = " ".join(["x", *a.split()[1:]])
    docs = frame(spark, [(1, a), (None, a), (None, near), (None, b), (None, b), (5, c), (5, c), (5, d), (8, d), (8, e), (None, None), (9, "")])
    got = left(setjoin.stage(spark, docs, SF))
    assert got == Counter([(1, a), (None, b), (5, c), (5, d), (8, e), (None, None), (9, "")])


def test_repeated_passages_without_a_doc_id_are_cut(spark):
    p, q = words(10, 80), words(11, 80)
    own = [words(i, 40) for i in range(20, 26)]
    docs = frame(spark, [(1, f"{own[0]} {p}"), (None, f"{own[1]} {p}"), (None, f"{own[2]} {q}"), (None, f"{own[3]} {q}"),
                         (7, f"{own[4]} {p}"), (7, own[5])])
    got = passages.stage(spark, docs, SF).collect()
    assert len(got) == 6 and {r.text.split()[0] for r in got} == {o.split()[0] for o in own}
    assert sum(p in r.text for r in got) == 1 == sum(q in r.text for r in got)
    assert all(r.n_chars == len(r.text) for r in got)
    assert next(r for r in got if p in r.text).doc_id == 1


def test_toxic_rows_without_a_doc_id_go(spark, documents):
    scored = toxicity.op10_toxicity(spark, SF).select("doc_id", "predicted")
    bad = {r.doc_id for r in scored.where("predicted = 1").collect()}
    assert bad
    texts = {r.doc_id: r.text for r in documents.collect()}
    good = sorted(set(texts) - bad)[0]
    odd = documents.unionByName(frame(spark, [*((None, texts[i]) for i in bad), (None, texts[good]), (good, texts[min(bad)])]))
    got = left(toxicity.stage(spark, odd, SF))
    assert got[(None, texts[good])] == 1 and got[(good, texts[good])] == 1
    assert not [k for k in got if k[1] in {texts[i] for i in bad}]
    assert sum(got.values()) == len(texts) - len(bad) + 1


def test_rows_without_a_doc_id_draw_their_own_counts(spark):
    docs = frame(spark, [(None, words(i, 30)) for i in range(300)])
    got = Counter(r.text for r in mixing.stage(spark, docs, SF).collect())
    assert 120 < len(got) < 260 and max(got.values()) > 1  # Poisson with mean 1 leaves about 190 of 300
