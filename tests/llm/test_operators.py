"""Each operator against a brute-force version, a library or a round trip, on small tables with awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import annsearch, bpe, capjoin, common, langid, mixing, passages, setjoin, sharding, tokenfiles, toxicity
from fleetlake.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score int, fp string"
SF = "/root/testdata/sf0.001"


def words(rng, n):
    return [rng.choice("abcdefgh") + str(rng.randint(0, 400)) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base, out = words(rng, 120), []
    out += [" ".join(base)] * 4
    for _ in range(25):  # near copies of one text, none equal
        w = list(base)
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(len(w))] = "x" + str(rng.randint(0, 9))
        out.append(" ".join(w))
    passage = words(rng, 60)
    out += [" ".join(words(rng, 40) + passage + words(rng, 30)) for _ in range(8)]
    out += [" ".join(words(rng, rng.randint(1, 90))) for _ in range(30)]
    out += ["", None, "  \n\t ", "one two", "one two", "ONE two", "Café  über\n\nalles ", "z " * 3000, "日本 語 text", "a" * 5000]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 3 else None, "src0" if i % 3 else None, None if t is None else len(t), i, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def shingles(t):
    w = (t or "").encode().lower().split()
    return {b" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_jaccard_join_equals_brute_force(spark, docs, texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    got = {r.doc_id: r for r in setjoin.jaccard_components(docs, Scratch(spark, "t")).collect()}
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in enumerate(sets)}
    assert {i: r.component_id for i, r in got.items()} == dict(enumerate(root))


def test_copies_that_only_link_with_their_original_are_one_class_and_few_pairs(spark):
    rng = random.Random(9)
    base = words(rng, 100)
    texts = []
    for i in range(60):  # two changed words: 86 of 106 shingles shared with the original, 76 of 116 with each other
        w = list(base)
        for k in rng.sample(range(5, 95, 6), 2):
            w[k] = f"own{i}"
        texts.append(" ".join(w))
    texts.insert(30, " ".join(base))
    join = setjoin.JaccardJoin(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), Scratch(spark, "t"))
    assert {r.component_id for r in join.result().collect()} == {0}
    assert join.labelled.select("label").distinct().count() == 1  # the links to the hub leave no pairs to ask


def test_rows_of_one_document_with_unlike_texts_keep_all_their_links(spark):
    rng = random.Random(4)
    x, y, z = (words(rng, 80) for _ in range(3))
    near = lambda w: " ".join([*w[:-1], "other"])
    rows = [(5, " ".join(x)), (8, " ".join(y)), (8, near(x)), (8, ""), (9, near(y)), (10, " ".join(z)), (11, None), (12, near(z)), (8, near(x))]
    got = setjoin.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t")).collect()
    want = {5: 5, 8: 5, 9: 5, 10: 10, 11: 11, 12: 10}
    assert sorted((r.doc_id, r.n_shingles) for r in got) == sorted((i, len(shingles(t))) for i, t in rows)
    assert all(r.component_id == want[r.doc_id] for r in got if r.n_shingles)


def test_bitmap_bound_never_undercuts_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 2**63, 400).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in "ab")
        bound = setjoin.overlap_bound(setjoin.signature(a), setjoin.signature(b), len(a), len(b))
        assert bound >= len(np.intersect1d(a, b))


def test_tile_pairs_find_all_links_between_labels():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    sets = [np.unique(np.concatenate([rng.choice(base, 290 - 4 * i, replace=False), rng.integers(0, 2**63, i).astype(np.uint64)])) for i in range(30)]
    n, label = np.array([len(s) for s in sets]), np.arange(30) % 3
    i, j = setjoin.tile_pairs(n, label, [setjoin.signature(s) for s in sets], None)
    found = {(min(p), max(p)) for p in zip(i.tolist(), j.tolist())}
    largest = np.bincount(label).argmax()
    for a in range(30):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if label[a] != label[b] and 100 * both >= 80 * (n[a] + n[b] - both):
                assert (b, a) in found, (a, b, largest)


def test_passages(spark, docs, texts):
    got = {}
    for r in passages.repeated_passages(docs, Scratch(spark, "t")).collect():
        got.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
        assert r.source_id < r.doc_id and r.end_word - r.start_word >= passages.LEAST
    assert set(got) == {*range(1, 29), *range(30, 37)}  # copies, near copies, and all but the first with the passage
    for d in range(30, 37):
        assert set(range(40, 100)) <= got[d] and len(got[d]) <= 64
    left = {r.doc_id: r for r in passages.stage(spark, docs, SF).collect()}
    assert left[0].text == texts[0] and left[29].text == texts[29] and 1 not in left and None is left[texts.index(None)].text
    assert left[30].text.split() == texts[30].split()[:40] + texts[30].split()[100:] and left[30].score == 30


def test_mixing_counts_follow_poisson(spark):
    u = spark.range(20000).select(mixing.poisson_quantile(mixing.uniform(F.lit("t"), F.col("id").cast("string")), F.lit(2.5)).alias("n"))
    n = np.array([r.n for r in u.collect()])
    assert abs(n.mean() - 2.5) < 0.05 and abs(n.var() - 2.5) < 0.12


def changed(rng, passage, share, insert):
    """The passage with a share of its words replaced, or as many new ones put in."""
    w = list(passage)
    for k in sorted(rng.sample(range(1, len(w) - 1), round(share * len(w))), reverse=True):
        w[k:k + (not insert)] = ["n" + str(rng.randint(0, 10**6))]
    return w


def test_fuzzy_passages_are_found(spark):
    rng, texts, where = random.Random(21), [], {}
    for share in (0.05, 0.08, 0.1, 0.125, 0.15):
        for insert in (False, True):
            for _ in range(12):
                p = words(rng, 70)
                texts.append(words(rng, 45) + p + words(rng, 40))
                q = changed(rng, p, share, insert)
                where[len(texts)] = (50, 50 + len(q), share)
                texts.append(words(rng, 50) + q + words(rng, 30))
    p = words(rng, 80)  # every 8th word replaced
    texts += [words(rng, 30) + p, words(rng, 30) + [w if k % 8 else f"r{k}" for k, w in enumerate(p)]]
    where[len(texts) - 1] = (31, 110, 0.125)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {}
    for r in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t")).collect():
        got.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    assert set(got) <= set(where)
    found = {d: len(got.get(d, set()) & set(range(s, e))) / (e - s) for d, (s, e, _) in where.items()}
    for share in sorted({w[2] for w in where.values()}):
        part = [found[d] for d in where if where[d][2] == share]
        assert sum(f >= 0.8 for f in part) >= (0.95 if share <= 0.1 else 0.85) * len(part)


@pytest.mark.parametrize("rate", [0.0, 2.5, 600.3, 720.6, 5000.7, 1000000.5])
def test_mixing_draws_large_means_from_poisson(spark, rate):
    us = [0.0001, 0.02, 0.3, 0.5, 0.77, 0.99, 0.9999]
    got = [r.n for r in spark.createDataFrame([(u,) for u in us], "u double").select(
        mixing.poisson_quantile(F.col("u"), F.lit(rate)).alias("n"), "u").orderBy("u").collect()]
    low, c, want = max(0, int(rate - 14 * rate ** 0.5 - 40)), 0.0, []
    n = low - 1
    for u in us:
        while c <= u:
            n += 1
            c += math.exp(n * math.log(rate) - rate - math.lgamma(n + 1)) if rate else 1.0
        want.append(n)
    assert got == want


def test_mixing(spark, docs):
    rows = mixing.mix(docs, Scratch(spark, "t"), weights={"src0": 3.0, None: 1.0}, epochs=4.0).collect()
    again = mixing.mix(docs, Scratch(spark, "t"), weights={"src0": 3.0, None: 1.0}, epochs=4.0).collect()
    assert sorted((r.doc_id, r.copy_no) for r in rows) == sorted((r.doc_id, r.copy_no) for r in again)
    size = {None: 0, "src0": 0}
    for r in rows:
        size[r.source] += max(1, len((r.text or "").encode()))
    assert 1.5 < size["src0"] / size[None] < 6


def test_sharding(spark, docs, texts):
    rows = sharding.shard_by_bytes(docs, Scratch(spark, "t"), shards=5).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_token_files(spark, docs, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenfiles.vocabulary_path(tokenfiles.VOCABULARY))
    scratch, start = Scratch(spark, "t"), 0
    out = scratch.path()
    tokenfiles.write_tokens(docs, out, tokenfiles.vocabulary_path(tokenfiles.VOCABULARY))
    got = {r.doc_id: r for r in tokenfiles.token_index(spark, out, scratch).collect()}
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_bpe_equals_tiktoken_and_decodes(spark, docs, texts):
    import public_tokenizers
    import tiktoken
    enc, _ = bpe.load(tokenfiles.vocabulary_path(bpe.VOCABULARY))
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=enc.ranks, special_tokens={})
    for r in bpe.digests(docs).collect():
        t = texts[r.doc_id] or ""
        ids = np.array(ref.encode_ordinary(t), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode(bpe.encode(docs)).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}


def test_bpe_appends_and_edits_are_exact():
    enc, _ = bpe.load(tokenfiles.vocabulary_path(bpe.VOCABULARY))
    rng = random.Random(3)
    for _ in range(300):
        data = bytes(rng.choice(b"aeinrsthl ") for _ in range(rng.randint(0, 25)))
        e = bpe.Editable(enc, data[:7]).append(data[7:])
        assert e.ids() == enc.merged(data) or len(e.ids()) == 1
        i = rng.randint(0, len(data))
        e.replace(i, min(len(data), i + 2), b"he")
        assert e.ids() == enc.piece(e.data)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 16))
    for i in range(100):
        x[200 + i] = x[i % 40] + 0.05 * rng.standard_normal(16)
    rows = [(i, [float(v) for v in x[i]], int(i % 40) % 3) for i in range(300)]
    rows += [(300 + i, rows[7][1], rows[7][2]) for i in range(30)]
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 16, 1), (403, [float("nan")] * 16, 1), (404, [None] + [1.0] * 15, 1), (405, rows[7][1], None)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def fine(v):
    return v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v)


def test_cap_join_finds_the_links(spark, vectors):
    rows, table = vectors
    links = {r[0]: 0 for r in rows}
    for a in rows:
        for b in rows:
            if a[0] != b[0] and fine(a[1]) and fine(b[1]) and a[2] is not None and a[2] == b[2]:
                x, y = np.array(a[1]), np.array(b[1])
                links[a[0]] += x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93
    got = {r.vec_id: r for r in capjoin.near_duplicates(table, Scratch(spark, "t")).collect()}
    assert all(got[i].n_links <= n for i, n in links.items()) and len(got) == len(rows)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(links.values()) > 0
    assert got[307].component_id == min(7, *(r.component_id for r in [got[7]])) and got[405].kept and got[400].kept


def test_ann_recall(spark, vectors):
    rows, table = vectors
    out = annsearch.nearest(table, table.where("vec_id % 20 = 0"), Scratch(spark, "t")).collect()
    ok = [(r[0], np.array(r[1])) for r in rows if fine(r[1])]
    hit = total = 0
    for q, v in ok:
        if q % 20 == 0:
            best = sorted(((-(x @ v), i) for i, x in ok if i != q))[:20]
            mine = [r.vec_id for r in sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])]
            assert len(mine) == 20
            hit, total = hit + len(set(mine) & {i for _, i in best}), total + 20
    assert hit >= 0.95 * total


def test_toxicity_held_out(spark):
    from fleetlake.llm.common import read_table
    rng, rows, labels = random.Random(8), [], []
    for i in range(600):
        bad = i % 4 == 0
        rows.append((i, " ".join(words(rng, 40) + (["scum", "idiot"] if bad else ["the", "and"])), None, "s", 1, 0, ""))
        labels.append((i, int(bad)))
    rows += [(None, None, None, None, None, None, None), (900, "", None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.score_documents(docs, toxicity.learnable(lab), Scratch(spark, "t")).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all((r.score >= toxicity.THRESHOLD) == (r.doc_id is not None and r.doc_id < 900 and r.doc_id % 4 == 0) for r in out)
    assert read_table(spark, SF, "labels").count() > 0


def test_toxicity_learns_a_rare_word_from_few_labels(spark):
    rng, rows, labels = random.Random(11), [], []
    for i in range(400):
        bad = i % 5 == 0  # each of eight slurs is in a tenth of the toxic texts
        rows.append((i, " ".join(words(rng, 12) + (['abcdefgh'[i // 5 % 8] + "slur"] * 2 if bad else [])), None, "s", 1, 0, ""))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, SCHEMA)
    out = toxicity.score_documents(docs, toxicity.learnable(spark.createDataFrame(labels, "doc_id long, toxic int")), Scratch(spark, "t"))
    held = out.withColumn("held", toxicity.held_out()).where("held").collect()
    assert {r.doc_id for r in held if r.score >= toxicity.THRESHOLD} == {r.doc_id for r in held if r.doc_id % 5 == 0}
    assert all(r.nearest_id is not None for r in held)


def plain_toxicity(rows, labels):
    """(score, cosine of the nearest example) of each text by the docstring, over dictionaries."""
    def terms(t):
        return Counter(re.findall(r"[a-z\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in t or "")))
    bags = {i: terms(t) for i, t in rows}
    example = {i: y for i, y in sorted(labels.items()) if i in bags}
    words = {t for i in example for t in bags[i]}
    df = Counter(t for b in bags.values() for t in b)
    idf = {t: math.log((1 + len(rows)) / (1 + (df[t] if t in words else 0))) + 1 for t in df}

    def unit(b):
        v = {t: math.log1p(n) * idf[t] for t, n in b.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    vectors = {i: unit(bags[i]) for i in example}

    def vote(bag, me=None):
        v, mass, best = unit(bag), [0, 0], 0
        others = [i for i in example if i != me]
        share = sum(example[i] for i in others) / max(1, len(others))
        voice = {}
        for t in v:
            every = sum(t in bags[i] for i in others)
            toxic = sum(t in bags[i] and example[i] for i in others)
            voice[t] = max(0, toxic - every * share) ** 2 / (every * share + 1)
        for label in (0, 1):
            near = sorted(((-sum(x * vectors[i].get(t, 0) for t, x in v.items()), i) for i in others if example[i] == label))
            near = [(-c, i) for c, i in near if c < 0][:toxicity.NEIGHBOURS]
            best = max([best, *(c for c, _ in near)])
            if near:
                mass[label] = sum(c * sum(voice[t] for t in v if t in bags[i]) for c, i in near) / sum(c for c, _ in near)
        return mass[1] / (mass[0] + mass[1] + 1), best

    own = [vote(bags[i], i)[0] for i in example]
    steps, values = toxicity.pooled(np.array(own), np.array(list(example.values())), np.ones(len(own)))
    return {i: (float(values[max(0, np.searchsorted(steps, v + 1e-12, side="right") - 1)]), cos) for i, (v, cos) in ((i, vote(bags[i])) for i, _ in rows)}


def test_toxicity_equals_brute_force(spark):
    rng, rows, labels = random.Random(12), [], {}
    for i in range(260):
        bad = i % 3 == 0
        w = ["".join(rng.choice("abcde") for _ in range(rng.choice((1, 2, 3, 6)))) for _ in range(rng.randint(1, 40))]
        rows.append((i, " ".join(w + (["slur", "Slur"] if bad and i % 2 else []))))
        if i < 200:
            labels[i] = int(bad)
    rows += [(300, rows[3][1]), (301, rows[3][1]), (302, ""), (303, None), (304, "123 -- !"), (305, "zzzzzz yyyyyy"), (306, "É é slur")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(list(labels.items()), "doc_id long, y int")
    want = plain_toxicity(rows, labels)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, lab, Scratch(spark, "t")).collect()}
    assert got.keys() == want.keys()
    assert all(abs((r.nearest_cosine or 0) - want[i][1]) < 1e-9 for i, r in got.items())
    assert all(abs(r.score - want[i][0]) < 1e-9 for i, r in got.items())


@pytest.mark.parametrize("rows, labels", [
    ([], []), ([], [(1, 1), (2, 0)]), ([(1, "a b"), (2, None)], []), ([(1, "a b"), (2, "c")], [(1, 1)]),
    ([(1, ""), (2, None), (3, "a")], [(1, 1), (2, 0)]), ([(1, "a"), (1, "a"), (2, "b")], [(1, 1), (2, 0)]),
])
def test_toxicity_of_few_rows(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = toxicity.score_documents(docs, spark.createDataFrame(labels, "doc_id long, y int"), Scratch(spark, "t")).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)


def test_block_max_search_is_exact():
    rng = np.random.default_rng(6)
    n, k = 700, toxicity.NEIGHBOURS
    bags = [np.sort(rng.choice(300, rng.integers(1, 30), replace=False)) for _ in range(n)]
    first = np.append(0, np.cumsum([len(b) for b in bags]))
    term, tf, y = np.concatenate(bags), rng.integers(1, 5, first[-1]), rng.integers(0, 2, n)
    idf, vocabulary = rng.random(300) + 0.5, np.arange(300).astype(np.uint64) * np.uint64(3)
    x = toxicity.BlockMaxIndex(vocabulary, idf, 2.0, range(n), y, first, term, tf)
    dense = np.zeros((n, 300))
    row = np.repeat(np.arange(n), np.diff(first))
    dense[row, term] = np.log1p(tf) * idf[term]
    dense /= np.linalg.norm(dense, axis=1)[:, None]
    found, cosine = x.search(row, vocabulary[term], tf, n, np.arange(n))
    every = dense @ dense.T
    np.fill_diagonal(every, 0)
    for label in (0, 1):
        best = -np.sort(-every[:, y == label], axis=1)[:, :k]
        assert np.allclose(cosine[:, label], best)
        assert all(np.allclose(every[i, found[i, label][found[i, label] >= 0]], best[i][best[i] > 0][:k]) for i in range(n))


def test_language_held_out(spark):
    from fleetlake.llm.common import read_table
    out = langid.op7_language_id(spark, SF).where("doc_id IS NOT NULL")
    truth = read_table(spark, SF, "documents").select("doc_id", F.col("lang").alias("truth"))
    rows = out.join(truth, "doc_id").collect()
    assert sum(r.lang == r.truth for r in rows) >= 0.97 * len(rows)


def test_language_of_every_one_that_documents_name(spark, tmp_path):
    rng, rows = random.Random(3), []
    for i in range(70):  # the last six have the fewest documents
        own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)]
        rows += [(100 * i + k, " ".join(rng.choices(own, k=30)), f"l{i:02d}", "s") for k in range(3 if i < 64 else 2)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.doc_id: r for r in langid.op7_language_id(spark, str(tmp_path)).collect()}
    assert {i: r.lang for i, r in got.items()} == {r[0]: r[2] for r in rows} and all(r.text_lang == r.lang for r in got.values())


@pytest.mark.parametrize("stage", [toxicity.stage, setjoin.stage, passages.stage, mixing.stage, bpe.stage])
def test_stages_take_empty_and_null_rows(spark, docs, stage):
    assert stage(spark, docs.limit(0), SF).count() == 0
    odd = spark.createDataFrame([(None,) * 7, (1, None, None, None, None, None, None), (None, "a b", None, None, None, None, None)], SCHEMA)
    stage(spark, odd, SF).collect()


def test_empty_tables(spark, docs):
    s = Scratch(spark, "t")
    none = docs.limit(0)
    vec = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    out = s.path()
    tokenfiles.write_tokens(none, out, tokenfiles.vocabulary_path(tokenfiles.VOCABULARY))
    for df in (sharding.shard_by_bytes(none, s), tokenfiles.token_index(spark, out, s), capjoin.near_duplicates(vec, s), annsearch.nearest(vec, vec, s)):
        assert df.count() == 0


def test_near_copies_that_do_not_link_make_no_pair_rows_but_lose_no_link(spark, monkeypatch):
    """A group of near copies under the threshold: tiles gave a row per pair that its bitmaps let link."""
    rng, base = random.Random(14), words(random.Random(13), 60)
    texts = []
    for i in range(160):  # three words of their own, so two copies rarely link; every fourth has a partner that does
        w = list(base)
        for k in rng.sample(range(5, 55, 5), 3):
            w[k] = f"own{i}x{k}"
        texts.append(" ".join(w))
        if i % 4 == 0:
            texts.append(" ".join([*w[:-1], f"last{i}"]))
    sets = [shingles(t) for t in texts]
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for tile, elements in ((setjoin.TILE, setjoin.ELEMENTS), (50, 2000)):  # also in several blocks
        monkeypatch.setattr(setjoin, "TILE", tile)
        monkeypatch.setattr(setjoin, "ELEMENTS", elements)
        got = setjoin.jaccard_components(frame, Scratch(spark, "t")).collect()
        assert {r.doc_id: r.component_id for r in got} == dict(enumerate(root))
    assert len(set(root)) > 100


def test_a_tile_gives_fewer_rows_than_twice_its_members():
    import pyarrow as pa
    rng = np.random.default_rng(15)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 280, replace=False), rng.integers(0, 2**63, 20).astype(np.uint64)])) for _ in range(120)]
    n, sig, label = [len(s) for s in sets], [setjoin.signature(s) for s in sets], np.arange(120)
    assert len(setjoin.tile_pairs(np.array(n), label, sig, None)[0]) > 5000
    one = pa.array([0] * 120, pa.int32())
    b = pa.RecordBatch.from_arrays([pa.array([7] * 120), one, one, one, pa.array(label), pa.array(n, pa.int64()), pa.array(label), pa.array(sig, pa.binary())],
                                   ["tok", "bi", "bj", "block", "fp", "n", "label", "sig"])
    rows = [r for out in setjoin._tiles(iter([b.slice(0, 70), b.slice(70)])) for r in out.to_pylist()]
    assert len(rows) < 240 and {r["fp"] for r in rows if r["fp"] is not None} == set(range(120))
    assert sum(r["a_"] is not None for r in rows) == 119


def test_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(16)
    for _ in range(50):
        n = int(rng.integers(2, 40))
        i, j, part = rng.integers(0, n, 30), rng.integers(0, n, 30), rng.integers(0, n, n)

        def joined(pairs):
            p = part.copy()
            for a, b in pairs:
                p[p == p[a]] = p[b]
            return {frozenset(np.flatnonzero(p == x)) for x in p}
        p, q = setjoin.forest(i, j, part)
        assert joined(zip(i, j)) == joined(zip(p, q)) and len(p) == len(set(part)) - len(joined(zip(i, j)))


def test_a_worker_frees_what_another_stage_left():
    """The BPE stage's dictionaries stayed in a reused Python worker beside the next stage's index."""
    import weakref

    from fleetlake.llm import common
    enc, cache = bpe.load(tokenfiles.vocabulary_path(bpe.VOCABULARY))
    assert bpe.load(tokenfiles.vocabulary_path(bpe.VOCABULARY))[1] is cache
    left = weakref.ref(cache)
    del enc, cache
    assert list(toxicity._example_terms(iter([]))) == [] and left() is None and not common._kept


def test_a_large_tile_is_not_held_as_all_its_pairs():
    """1,500 members that may all link: their 2.2 million pairs took 108 MB; now a slice of them is held."""
    import tracemalloc

    import pyarrow as pa
    rng = np.random.default_rng(17)
    base, k = rng.integers(0, 2**63, 60).astype(np.uint64), 1500
    sets = [np.unique(np.append(rng.choice(base, 57, replace=False), rng.integers(0, 2**63, 1).astype(np.uint64))) for _ in range(k)]
    one, ids, n = pa.array([0] * k, pa.int32()), pa.array(range(k)), pa.array([len(s) for s in sets], pa.int64())
    tile = pa.RecordBatch.from_arrays([pa.array([7] * k), one, one, one, ids, n, ids, pa.array(list(map(setjoin.signature, sets)), pa.binary())],
                                      ["tok", "bi", "bj", "block", "fp", "n", "label", "sig"])
    low = [np.sort(s & np.uint64(2**48 - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for s in sets]
    group = pa.RecordBatch.from_arrays([pa.array([7] * k), one, one, one, ids, ids, pa.array(low, pa.binary())],
                                       ["grp", "bi", "bj", "block", "id", "label", "arr"])
    for step, batch in ((setjoin._tiles, tile), (setjoin._groups, group)):
        tracemalloc.start()
        try:
            rows = [r for out in step(iter([batch])) for r in out.to_pylist()]
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        a, b = ("a_", "b_") if "a_" in rows[0] else ("a", "b")
        edges = [(r[a], r[b]) for r in rows if r[a] is not None]
        assert len(edges) == k - 1 and len({x for e in edges for x in e}) == k and peak < 80e6, (step, len(edges), peak)


def test_small_tables_are_written_in_few_files(spark, monkeypatch):
    """Each file written to a local folder forks the executor; rounds of a few rows wrote one per shuffle partition."""
    import glob
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    scratch, files = Scratch(spark, "t"), []
    drop = Scratch.drop

    def counted(self, *frames):
        files.extend(len(glob.glob(f"{f._scratch.removeprefix('file:')}/part-*")) for f in frames)
        drop(self, *frames)
    monkeypatch.setattr(Scratch, "drop", counted)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        edges = scratch.cut(spark.range(3000).where("id % 10 <> 0").select(F.col("id").alias("a"), (F.col("id") - 1).alias("b")))
        got = {r.id: r.component for r in common.components(edges, scratch, edges).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {i: i // 10 * 10 for i in range(3000)}
    assert 0 < max(files) <= spark.sparkContext.defaultParallelism, files
