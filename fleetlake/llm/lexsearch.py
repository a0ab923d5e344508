"""Ranked lexical search by MaxScore with pair bounds.

Index. Texts are cut into terms (runs of ASCII letters, digits and all other characters above U+007F, only A-Z
lower-cased; a term is known by a 64-bit hash), and every ``SEGMENT_BYTES`` of text become one row of a written table:
the documents' ids and lengths, and for each term its postings (document, occurrences). Totals N, L and the document
frequencies of the terms asked come from that table.

Pair lists. A second pass adds to each segment, for every pair of the ``PAIR_TERMS`` terms of highest document
frequency that occurs together in it, the documents in both (a bitmap) and the pair's joint maximum impact, the
largest sum of the two terms' scores in one document. They depend on the corpus alone, not on the queries.

Search. A task takes its segments one after the other and keeps each query's best ``k`` scores as a threshold. In
a segment a term's bound is its maximum score there. A pair's bound is its joint maximum, or the larger of the two bounds if that is
more: never above their sum. Query terms are taken by ascending bound; the longest run of them whose combined
bound (pairs of the greatest saving first, the rest alone) stays under the threshold needs no postings read for new
candidates, and candidates from the other terms are dropped as soon as their score and the combined bound of what is
left stay under it. For each candidate the bound uses the pair only if the document is in the pair's list.
Documents at the threshold itself are kept, so ties by doc_id come out right: the result is exact.

Memory. Words are cut from about 1 MB of text at a time, a row group of the index holds one segment, and workers get about
one at a time, so what a task holds doesn't grow with its share of the input.

Queries go in blocks of about ``BLOCK_TERMS`` terms, so what a task is given is bounded. Each task returns at most k rows
a query; they are merged in two levels of windows.

Defined cases: a null text has no terms; documents without terms count nowhere; a null doc_id counts in the
statistics, but can't be named and is not returned; rows that share a doc_id are documents of their own; items that share
an item_id (null is an id like another) are one query of all their terms; an item without terms, or whose terms no
document holds, has no rows; empty tables give an empty table; columns other than those named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlake.llm.common import CHUNK_BYTES, Scratch, arrow_slices, read_table, small_batches, utf8, word_hashes

TOP = 50
SEGMENT_BYTES = 4 << 20
PAIR_TERMS = 32
BLOCK_TERMS = 200_000
MERGE_GROUPS = 64
SEGMENT = "seg long, docs array<long>, named array<boolean>, lens array<long>, terms array<long>, offs array<int>, at array<int>, tf array<int>"
INDEX = SEGMENT + ", one array<int>, two array<int>, joint array<long>, members binary"

# no part of a term: ASCII other than digits and letters
GAP = np.zeros(256, bool)
GAP[:128] = True
GAP[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def _segment(seg: int, slices: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> pa.RecordBatch:
    """One row of the index, from (words, words of each text, doc_ids) of its slices of text."""
    h, n = (np.concatenate([s[i] for s in slices]) for i in (0, 1))
    of = np.repeat(np.arange(len(n), dtype=np.int64), n)
    h = h.view(np.int64)  # in the order that searches use
    order = np.lexsort((of, h))
    t, d = h[order], of[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (d[1:] != d[:-1])
    head = np.flatnonzero(new)
    tf = np.diff(np.append(head, len(t)))
    term, at = t[head], d[head]
    start = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
    ids = pa.concat_arrays([s[2] for s in slices])
    cells = [[seg], [ids.fill_null(0).to_numpy()], [ids.is_valid().to_numpy(zero_copy_only=False)], [n], [term[start]],
             [np.append(start, len(term))], [at], [tf]]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.list_(pa.int64())] * 2, *[pa.list_(pa.int32())] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)],
                                      ["seg", "docs", "named", "lens", "terms", "offs", "at", "tf"])


def _segments(segment_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, held, size = TaskContext.get().partitionId() << 32, [], 0
        for b in arrow_slices(batches, limit=min(segment_bytes, CHUNK_BYTES)):
            raw, off = utf8(b.column("text"))
            h, _, _, first = word_hashes(raw, off, gap=GAP)
            held.append((h, np.diff(first), b.column("doc_id")))
            size += len(raw)
            if size >= segment_bytes:
                yield _segment(seg, held)
                seg, held, size = seg + 1, [], 0
        if held:
            yield _segment(seg, held)
    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in arrow_slices(batches):
        h, _, _, first = word_hashes(*utf8(b.column("text")), gap=GAP)
        of = np.repeat(np.arange(b.num_rows), np.diff(first))
        yield pa.RecordBatch.from_arrays([b.column("item_id").take(pa.array(of)), pa.array(h.view(np.int64))], ["item_id", "term"])


def _array(col: pa.Array, i: int) -> np.ndarray:
    off = col.offsets
    return col.values[off[i].as_py():off[i + 1].as_py()].to_numpy(zero_copy_only=False)


def _frequencies(wanted: np.ndarray | None):
    """(term, documents that hold it) per task, of the sorted terms ``wanted`` (None: all)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = None if wanted is None else np.zeros(len(wanted), np.int64)
        for b in batches:
            for i in range(b.num_rows):
                term, n = _array(b.column("terms"), i), np.diff(_array(b.column("offs"), i)).astype(np.int64)
                if wanted is None:
                    yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n)], ["term", "n"])
                elif len(wanted) and len(term):
                    at = np.minimum(np.searchsorted(wanted, term), len(wanted) - 1)
                    hit = wanted[at] == term
                    df[at[hit]] += n[hit]
        if df is not None:
            some = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(wanted[some]), pa.array(df[some])], ["term", "n"])
    return run


@dataclass
class Statistics:
    docs: int   # documents with a term
    words: int  # their terms with repeats

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.docs + 2) / (2 * df + 1)))

    def impacts(self, weight: int, tf: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """A term's score in documents of these lengths."""
        m = 50 + (50 * lens * self.docs) // self.words
        return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Segment:
    """One row of the index."""

    def __init__(self, b: pa.RecordBatch, i: int):
        (self.docs, self.named, self.lens, self.terms, self.offs, self.at, self.tf) = (
            _array(b.column(c), i) for c in ("docs", "named", "lens", "terms", "offs", "at", "tf"))

    def place(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term here, or -1."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        s = slice(self.offs[place], self.offs[place + 1])
        return self.at[s], self.tf[s].astype(np.int64)


def _pair_lists(frequent: np.ndarray, weight: list[int], stats: Statistics):
    """Each segment with its pairs of ``frequent`` terms (numbers, ascending), their joint maxima and members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                seg = Segment(b, i)
                score = np.full((len(frequent), len(seg.docs)), -1, np.int64)
                for r, place in enumerate(seg.place(frequent)):
                    if place >= 0:
                        at, tf = seg.postings(place)
                        score[r, at] = stats.impacts(weight[r], tf, seg.lens[at])
                one, two, joint, members = [], [], [], []
                held = score >= 0
                for x in range(len(frequent) - 1):
                    both = held[x] & held[x + 1:]
                    for y in np.flatnonzero(both.any(1)):
                        one.append(x)
                        two.append(x + 1 + y)
                        joint.append(int((score[x] + score[x + 1 + y])[both[y]].max()))
                        members.append(np.packbits(both[y], bitorder="little").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*b.slice(i, 1).columns, pa.array([one], pa.list_(pa.int32())), pa.array([two], pa.list_(pa.int32())),
                     pa.array([joint], pa.list_(pa.int64())), pa.array([b"".join(members)], pa.binary())],
                    [*b.schema.names, "one", "two", "joint", "members"])
    return run


@dataclass
class Index:
    segments: DataFrame
    stats: Statistics
    frequent: np.ndarray  # terms of the pair lists


def build_index(docs: DataFrame, scratch: Scratch, pair_terms: int = PAIR_TERMS, segment_bytes: int = SEGMENT_BYTES) -> Index:
    """Segments and pair lists of every row of (doc_id, text)."""
    with small_batches(docs.sparkSession):
        return _index(docs, scratch, pair_terms, segment_bytes)


def _index(docs: DataFrame, scratch: Scratch, pair_terms: int, segment_bytes: int) -> Index:
    segments = scratch.cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_segments(segment_bytes), SEGMENT),
                           group_rows=1)
    words = F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x)
    n, total = segments.agg(F.sum(F.size(F.filter("lens", lambda x: x > 0))), F.sum(words)).first()
    stats = Statistics(int(n or 0), int(total or 0))
    all_df = segments.select("terms", "offs").mapInArrow(_frequencies(None), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    top = all_df.orderBy(F.desc("n"), "term").limit(pair_terms).collect()
    frequent = np.array([r.term for r in top], np.int64)
    whole = scratch.cut(segments.mapInArrow(_pair_lists(frequent, [stats.weight(r.n) for r in top], stats), INDEX), group_rows=1)
    scratch.drop(segments)
    return Index(whole, stats, frequent)


@dataclass
class PairLists:
    """A segment's pairs of frequent terms: joint maximum and members by (smaller, larger) number."""
    joint: dict[tuple[int, int], int]
    members: dict[tuple[int, int], np.ndarray]

    @classmethod
    def read(cls, b: pa.RecordBatch, i: int) -> PairLists:
        one, two, joint = (_array(b.column(c), i).tolist() for c in ("one", "two", "joint"))
        raw = np.frombuffer(b.column("members")[i].as_py() or b"", np.uint8).reshape(len(one), -1 if one else 0)
        keys = list(zip(one, two))
        return cls(dict(zip(keys, joint)), dict(zip(keys, raw)))

    def matched(self, bounds: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int, int, int]]]:
        """Combined bound of terms, given as (bound, frequent number or -1), and the pairs that lower it.

        A pair is (first, second, bound of a document in its list, bound of one outside); outside it holds one term at most.
        """
        total = sum(x for x, _ in bounds)
        some = [(i, x, f) for i, (x, f) in enumerate(bounds) if f >= 0]
        savings = []
        for p, (i, x, f) in enumerate(some):
            for j, y, g in some[p + 1:]:
                joint = self.joint.get((min(f, g), max(f, g)))
                one = max(x, y)
                best = one if joint is None else max(one, joint)
                savings.append((x + y - best, i, j, best, one))
        used, pairs = set(), []
        for saved, i, j, best, one in sorted(savings, reverse=True):
            if i not in used and j not in used:
                used |= {i, j}
                total -= saved
                pairs.append((i, j, best, one))
        return total, pairs

    def in_list(self, f: int, g: int, docs: np.ndarray) -> np.ndarray:
        raw = self.members.get((min(f, g), max(f, g)))
        if raw is None:
            return np.zeros(len(docs), bool)
        return (raw[docs >> 3] >> (docs & 7).astype(np.uint8)) & 1 > 0


def search_segment(seg: Segment, lists: PairLists, terms: list[tuple[int, int, np.ndarray, np.ndarray]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents (numbers) with a score of ``least`` or more, and their scores; ``least`` is 1 or more.

    ``terms``: (bound, frequent number or -1, documents, scores) of the query's terms that occur here.
    """
    terms = sorted(terms, key=lambda t: t[0])
    bounds = [(t[0], t[1]) for t in terms]
    # the longest run of terms that can't reach the threshold by themselves
    free, combined = 0, [(0, [])]
    while free < len(terms):
        got = lists.matched(bounds[:free + 1])
        if got[0] >= least:
            break
        combined.append(got)
        free += 1
    if free == len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    score = np.zeros(len(seg.docs), np.int64)
    for _, _, at, s in terms[free:]:
        score[at] += s
    cand = np.flatnonzero(score + combined[free][0] >= least) if free else np.flatnonzero(score >= least)
    cand = cand[score[cand] > 0]
    for left in range(free, 0, -1):
        if not len(cand):
            break
        # what the terms still unread can add to each candidate, by its place in the pair lists
        total, pairs = combined[left]
        more = np.full(len(cand), total, np.int64)
        for i, j, best, one in pairs:
            if best > one:
                more -= np.where(lists.in_list(bounds[i][1], bounds[j][1], cand), 0, best - one)
        cand = cand[score[cand] + more >= least]
        _, _, at, s = terms[left - 1]
        got = np.minimum(np.searchsorted(at, cand), len(at) - 1)
        hit = at[got] == cand
        score[cand[hit]] += s[got[hit]]
    cand = cand[score[cand] >= least]
    return cand, score[cand]


def _search(queries: list[tuple[int | None, np.ndarray]], weight: dict[int, int], index_terms: np.ndarray, stats: Statistics, k: int):
    """Each task's best k of every query; its segments come with their pair lists."""
    number = {int(t): i for i, t in enumerate(index_terms)}
    asked = np.unique(np.concatenate([t for _, t in queries])) if queries else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)  # scores and ids, highest first
        for b in batches:
            for i in range(b.num_rows):
                seg = Segment(b, i)
                lists = PairLists.read(b, i)
                here = {}
                for t, place in zip(asked.tolist(), seg.place(asked).tolist()):
                    w = weight.get(t, 0)
                    if place >= 0 and w > 0:
                        at, tf = seg.postings(place)
                        s = stats.impacts(w, tf, seg.lens[at])
                        here[t] = (int(s.max()), number.get(t, -1), at, s)
                for q, (_, terms) in enumerate(queries):
                    scores, ids = best[q]
                    mine = [here[t] for t in terms.tolist() if t in here]
                    if not mine:
                        continue
                    cand, s = search_segment(seg, lists, mine, int(scores[-1]) if len(scores) == k else 1)
                    fine = seg.named[cand]
                    if fine.any():
                        scores, ids = np.concatenate([scores, s[fine]]), np.concatenate([ids, seg.docs[cand[fine]]])
                        order = np.lexsort((ids, -scores))[:k]
                        best[q] = (scores[order], ids[order])
        sizes = [len(s) for s, _ in best]
        items = [item for (item, _), n in zip(queries, sizes) for _ in range(n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.array(np.concatenate([d for _, d in best] or [np.zeros(0, np.int64)]), pa.int64()),
             pa.array(np.concatenate([s for s, _ in best] or [np.zeros(0, np.int64)]), pa.int64())], ["item_id", "doc_id", "score"])
    return run


def search(index: Index, items: DataFrame, scratch: Scratch, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a score above 0 for every row of (item_id, text)."""
    with small_batches(items.sparkSession):
        found = _found(index, items, scratch, k, block_terms)
    order = [F.desc("score"), F.asc("doc_id")]
    some = found.withColumn("n", F.row_number().over(W.partitionBy("item_id", "group").orderBy(*order))).where(F.col("n") <= k)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _found(index: Index, items: DataFrame, scratch: Scratch, k: int, block_terms: int) -> DataFrame:
    """Each task's best ``k`` of every query, as written tables: (item_id, doc_id, score, group)."""
    asked = scratch.cut(items.select(F.col("item_id").cast("long").alias("item_id"), "text")
                        .mapInArrow(_item_terms, "item_id long, term long").distinct())
    blocks = max(1, math.ceil(asked.count() / block_terms))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    parts = []
    for block in range(blocks):  # one pass over the index for each bounded block of queries
        mine = asked.where(F.col("block") == block).groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
        queries = [(r.item_id, np.sort(np.array(r.terms, np.int64))) for r in mine]
        terms = np.unique(np.concatenate([t for _, t in queries])) if queries else np.zeros(0, np.int64)
        df = index.segments.select("terms", "offs").mapInArrow(_frequencies(terms), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        weight = {r.term: index.stats.weight(r.n) for r in df.collect()}  # terms of this block
        found = index.segments.mapInArrow(_search(queries, weight, index.frequent, index.stats, k), "item_id long, doc_id long, score long")
        parts.append(scratch.cut(found.withColumn("group", F.spark_partition_id() % MERGE_GROUPS)))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents for every benchmark item."""
    scratch = Scratch(spark, "lexical")
    index = build_index(read_table(spark, sf_dir, "documents", "doc_id", "text"), scratch)
    return search(index, read_table(spark, sf_dir, "benchmark", "item_id", "text"), scratch)


ORACLE = r"""
with words as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
asked as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
postings as (select doc_id, term, count(*) as tf from words group by doc_id, term),
lens as (select doc_id, count(*) as n from words group by doc_id),
totals as (select count(*) as docs, cast(sum(n) as bigint) as total from lens),
weights as (select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
  from postings, totals group by term, docs),
scores as (select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) as bigint) as score
  from asked join postings using (term) join weights using (term) join lens using (doc_id), totals group by item_id, doc_id)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0) where rank <= 50
"""
