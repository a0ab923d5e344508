"""URL filters, bit-plane clustering and lexical search against brute force, on small tables with awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from fleetlake.llm import bitkmeans, lexsearch, urlfilter
from fleetlake.llm.common import Scratch

URLS = ["https://a.b.Example.ORG/es/1?x#y", "http://example.org/en/17", "http://example.org/en/2", "x://notexample.org/es/", "http://org/",
        "http://org", "https://q.com/fr/../?a", "https://q.com/de/9", "https://q.com/fr", "HTTP://com/de/", "no scheme", "://", "", None,
        "a://b://example.org/es/", "http://example.org?/es/", "http://exa mple.org/en/1", "http://Üé.com/de/ü", "http://com:80/de/",
        "http://" + "a." * 3000 + "com/de/x", "http://x.org/" + "y" * 100_000]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def judged(url, rules, default="allow"):
    host, path = split(url)
    fits = [(len((h + p).encode()), len(h.encode()), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, False, None, default))
    return host, path, best[3], best[4]


@pytest.mark.parametrize("list_bytes", [urlfilter.LIST_BYTES, 0])  # 0: the join of long lists
def test_urls_equal_brute_force(spark, list_bytes):
    rng = random.Random(1)
    hosts = ["org", "com", "example.org", "b.example.org", "q.com", "x.q.com", "é.com", ""]
    many = {(rng.choice(hosts), rng.choice(["", "/", "/e", "/es/", "/de/", "/es/1", "/ü", "x"])): rng.choice(urlfilter.VERDICTS) for _ in range(40)}
    urls = URLS + [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/es/12', '/de/', '/e?q', '/üx'])}" for _ in range(200)]
    pages = spark.createDataFrame([(i // 2 if i % 7 else None, u, "extra", "clash") for i, u in enumerate(urls + urls[:5])],
                                  "page_id long, url string, html string, rule string")
    for rules in (urlfilter.RULES, [(h, p, v) for (h, p), v in many.items()] + [("Org", "/", "block"), ("org", "/", "allow"), (None, "/", "block"), ("q.com", None, "block")], []):
        frame = spark.createDataFrame(rules, "host string, path string, verdict string")
        lower = [(h.lower(), p or "", v) for h, p, v in rules if h is not None]
        got = urlfilter.judge(pages, frame, Scratch(spark, "t"), list_bytes=list_bytes).collect()
        want = Counter((i // 2 if i % 7 else None, *judged(u, lower)) for i, u in enumerate(urls + urls[:5]))
        assert Counter(map(tuple, got)) == want
    assert urlfilter.judge(pages.limit(0), frame, Scratch(spark, "t"), list_bytes=list_bytes).count() == 0
    with pytest.raises(ValueError):
        urlfilter.judge(pages, spark.createDataFrame([("a", "/", "deny")], "host string, path string, verdict string"), Scratch(spark, "t"))


def test_equal_digests_are_told_apart_by_their_strings():
    few = lambda s: len(s) % 3  # noqa: E731 -- a digest that collides all the time
    words = [b"a" * n + bytes([97 + k]) for n in range(20) for k in range(4)]
    array, order = urlfilter.DigestArray.build(words[::2], few)
    got = array.find(words, few)
    assert [words[::2][order[i]] if i >= 0 else None for i in got] == [w if k % 2 == 0 else None for k, w in enumerate(words)]


def kmeans(rows, k, rounds):
    kept = [(i, np.array([math.floor(1024 * x) for x in e], object)) for i, e in rows
            if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), [int(x) for x in v]) for i, v in kept if i is not None)[:k]
    cent = [np.array(v, object) for _, v in start]

    def assign():
        return [min((int(((v - c) ** 2).sum()), j) for j, c in enumerate(cent)) for _, v in kept]
    for _ in range(rounds):
        at = assign()
        for j in range(len(cent)):
            mine = [v for (_, v), (_, c) in zip(kept, at) if c == j]
            if mine:
                cent[j] = sum(mine) // len(mine)
    return Counter((i, c, d) for (i, _), (d, c) in zip(kept, assign())), cent


@pytest.mark.parametrize("rounds", [0, 1, 10])
def test_clusters_equal_brute_force(spark, rounds):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in np.float32(v)]) for i, v in enumerate(rng.standard_normal((60, 64)) * rng.choice([0.01, 1, 30], (60, 1)))]
    rows += [(70, [0.0] * 64), (71, rows[3][1]), (3, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (72, None), (73, []), (74, [1.0] * 63),
             (75, [1.0] * 63 + [None]), (76, [1.0] * 63 + [float("nan")]), (77, [1.0] * 63 + [float("inf")]), (78, [-0.0004882812] * 64)]
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], "vec_id long, embedding array<float>, cluster int, planes string")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, cent = bitkmeans.cluster(df, Scratch(spark, "t"), rounds=rounds)
    want, centers = kmeans(rows, 8, rounds)
    assert Counter(map(tuple, got.collect())) == want
    assert cent.tolist() == [[int(x) for x in c] for c in centers]


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    none, cent = bitkmeans.cluster(spark.createDataFrame([(1, None), (2, [1.0])], schema), Scratch(spark, "t"))
    assert none.count() == 0 and len(cent) == 0
    some, cent = bitkmeans.cluster(spark.createDataFrame([(1, [1.0] * 64), (2, [1.0] * 64), (None, [2.0] * 64)], schema), Scratch(spark, "t"))
    assert len(cent) == 2 and {r.vec_id: r.cluster for r in some.collect()} == {1: 1, 2: 1, None: 0}  # the first of equal centroids moved away
    with pytest.raises(OverflowError):
        bitkmeans.cluster(spark.createDataFrame([(1, [1e9] * 64)], schema), Scratch(spark, "t"))


def test_dot_products_on_planes():
    rng = np.random.default_rng(3)
    v = rng.integers(-2000, 2000, (50, 64))
    planes = bitkmeans.pack_planes(v, 12)
    assert (bitkmeans.dots(planes, planes[7]) == v @ v[7]).all()
    assert (bitkmeans.weights(12) @ bitkmeans.plane_counts(planes) == v.sum(0)).all()


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, k):
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, terms in queries.items():
        scores = []
        for i, b in bags:
            m = 50 + 50 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * b[t] // (1000 * b[t] + 20 * m)) for t in terms if b[t])
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def search_tables():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "日本", "x1"]
    often = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(rng.choices(vocabulary, often, k=rng.randint(1, 60))) for _ in range(300)]
    texts += texts[:20] + ["", None, " \n", "W1, w1; W2!", "w1_w2-w3\x00w4", "z" * 50_000, "w1 " * 20_000, "É é"]
    items = [(q, " ".join(rng.choices(vocabulary, often, k=rng.randint(1, 30)))) for q in range(25)]
    items += [(3, "w1 w2 日本"), (5, items[5][1]), (30, ""), (31, None), (32, "unseen"), (None, "w1 w7")]
    return texts, items


@pytest.mark.parametrize("segment, pairs, block", [(4 << 20, 32, 200_000), (700, 8, 60), (3000, 0, 200_000)])
def test_search_equals_brute_force(spark, segment, pairs, block):
    texts, items = search_tables()
    ids = [None if i == 7 else i // 2 if i > 310 else i for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts)], "doc_id long, text string, terms string, seg int")
    frame = spark.createDataFrame([(q, t, 1.0) for q, t in items], "item_id long, text string, score double")
    scratch = Scratch(spark, "t")
    index = lexsearch.build_index(docs.repartition(3), scratch, pairs, segment)  # many small segments: thresholds skip
    for k in (3, 50):
        got = lexsearch.search(index, frame, scratch, k, block)
        assert Counter(map(tuple, got.collect())) == ranked(list(zip(ids, texts)), items, k)


def test_search_of_empty_tables(spark):
    scratch = Scratch(spark, "t")
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i, n in ((docs, items, 1), (docs.limit(0), items, 0), (docs.where("doc_id = 2"), items, 0), (docs, items.limit(0), 0)):
        assert lexsearch.search(lexsearch.build_index(d, scratch), i, scratch).count() == n


def test_pair_bounds_are_bounds_and_tighter_than_sums():
    rng = np.random.default_rng(5)
    score = rng.integers(1, 100, (6, 40)) * (rng.random((6, 40)) < 0.4)
    joint, members = {}, {}
    for a in range(6):
        for b in range(a + 1, 6):
            both = (score[a] > 0) & (score[b] > 0)
            if both.any():
                joint[a, b] = int((score[a] + score[b])[both].max())
                members[a, b] = np.packbits(both, bitorder="little")
    lists = lexsearch.PairLists(joint, members)
    total, pairs = lists.matched([(int(s.max()), i) for i, s in enumerate(score)])
    assert score.sum(0).max() <= total < sum(int(s.max()) for s in score)
    inside = total - sum(np.where(lists.in_list(i, j, np.arange(40)), 0, best - one) for i, j, best, one in pairs)
    assert (score.sum(0) <= inside).all()
