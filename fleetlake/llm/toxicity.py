"""Toxicity from the nearest labelled examples by TF-IDF cosine.

Examples: of the labelled rows that may be learnt from, at most ``EXAMPLES`` of each label (smallest hash of doc_id),
of at most
``TERMS`` terms each and ``ENTRIES`` in all a label. Terms are the runs of letters, only A-Z lower-cased (a
byte of 128 and more is a letter), as 64-bit hashes. A term of an example weighs ln(1 + its count) * (ln((1 + N) / (1 +
df)) + 1), N and df over all documents; a word that no example has counts in a text's length with df 0.

The index is built in the tasks from the examples' counts. Terms that over one in ``RARE`` examples hold are rows of a
matrix, cut in blocks of ``BLOCK`` like examples of one label, with each term's largest weight per block; the others
are posting lists, added up first. A block's bound is what the frequent terms' largest weights could add to the best of
those sums. The ``FIRST`` blocks of each label with the largest bound are scored, then all whose bound reaches the
label's k-th cosine, so the ``NEIGHBOURS`` nearest of each label are exact by plain TF-IDF cosine.

The neighbours vote. Each one's voice is the sum, over the terms it shares with the text, of the squared significance
with which more toxic examples hold the term than the labels' shares let expect; a label's voice is the mean of its
neighbours' weighted by cosine. The vote is toxic / (toxic + other + 1). The votes of the examples themselves, each left
out of the neighbours and of the term counts, are made a monotone score by pooling adjacent violators, each example
weighted for how thinly its label was sampled.

Defined cases: a null or empty text, or one without a term that an example has, gets the smallest score; ties between
examples go to the smaller doc_id; a document that is an example itself is
among its own neighbours (scores don't look at doc_id); rows of ``labels``
that repeat a doc_id count once (toxic if one says so), null labels not at all; without examples of both labels
every score is 0; rows with a null doc_id are scored and not held out; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch, arrow_slices, free_caches, ranges, read_table, release_memory, row_ids, utf8, word_hashes

EXAMPLES = 3000
ENTRIES = 2_000_000  # terms of one label's examples, summed: bounds what is sent to the tasks
TERMS = 20_000  # of one example
RARE = 16
BLOCK = 64
FIRST = 4
ROWS = 128  # texts searched at a time, fewer where their terms have over ``POSTINGS`` postings
POSTINGS = 1_000_000
SLICE = 1 << 19  # bytes of text whose words are cut at a time: bounds what a task holds
NEIGHBOURS = 40  # of each label
THRESHOLD = 0.7
_U = np.uint64
_GAP = np.ones(256, bool)
_GAP[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def text_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, how often), in that order, of every text of a string column."""
    h, _, _, first = word_hashes(*utf8(column), _GAP)
    text = np.repeat(np.arange(len(column)), np.diff(first))
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])])[:len(h)])
    return text[new], h[new], np.diff(np.append(new, len(h)))


def _lists(values: np.ndarray, text: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32()), pa.array(values, kind))


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    free_caches()
    for b in arrow_slices(batches, limit=SLICE):
        text, term, tf = text_terms(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), _lists(term.view(np.int64), text, b.num_rows, pa.int64()),
                                          _lists(tf, text, b.num_rows, pa.int32())], ["doc_id", "y", "terms", "tf"])


def places(vocabulary: np.ndarray, term: np.ndarray) -> np.ndarray:
    """Each term's place in the sorted vocabulary, -1 where it isn't there."""
    at = np.searchsorted(vocabulary, term)
    return np.where(vocabulary[np.minimum(at, len(vocabulary) - 1)] == term, at, -1) if len(vocabulary) else np.full(len(term), -1)


def _document_counts(shared):
    """(term, documents) of a partition; term -1 stands for every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_caches()
        vocabulary = shared.value
        total, n = np.zeros(len(vocabulary), np.int64), 0
        for b in arrow_slices(batches, limit=SLICE):
            n += b.num_rows
            at = places(vocabulary, text_terms(b.column("text"))[1])
            total += np.bincount(at[at >= 0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], n), pa.int64())], ["t", "c"])
    return run


def _cuts(postings: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of at most ``ROWS`` texts and, but for a single text, ``POSTINGS`` postings."""
    lo, held = 0, 0
    for i, p in enumerate(postings.tolist()):
        if i > lo and (i - lo == ROWS or held + p > POSTINGS):
            yield lo, i
            lo, held = i, 0
        held += p
    if len(postings):
        yield lo, len(postings)


class BlockMaxIndex:
    """Examples as unit TF-IDF vectors, searched block by block.

    ``ids`` rise; ``first``, ``term`` and ``tf`` hold example i's terms (places in ``vocabulary``) at first[i] to first[i + 1].
    """

    def __init__(self, vocabulary: np.ndarray, idf: np.ndarray, unseen: float, ids, y, first, term, tf):
        self.vocabulary, self.idf, self.unseen = vocabulary, np.asarray(idf, np.float64), float(unseen)
        self.ids, self.y = np.asarray(ids, np.int64), np.asarray(y, np.int64)
        self.first, self.term, self.tf = np.asarray(first, np.int64), np.asarray(term, np.int32), np.asarray(tf, np.int32)
        self._built = False

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("vocabulary", "idf", "unseen", "ids", "y", "first", "term", "tf")}

    def __setstate__(self, state):
        self.__init__(**state)

    def build(self) -> BlockMaxIndex:
        if self._built:
            return self
        n, v = len(self.ids), len(self.idf)
        row = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.first))
        w = np.log1p(self.tf) * self.idf[self.term]
        norm = np.sqrt(np.bincount(row, w * w, n))
        w = w / norm[row]
        self.every = np.bincount(self.term, minlength=v)  # examples that hold a term, and toxic ones
        self.toxic = np.bincount(self.term, self.y[row], v)
        self.voice = _voice(self.toxic, self.every, self.y.sum(), n)
        self.rank = np.empty(v, np.int64)  # common terms side by side: they stay in the processor's cache
        self.rank[np.argsort(-self.every, kind="stable")] = np.arange(v)
        speaks = self.voice[self.term] > 0
        ends = np.append(0, np.cumsum(speaks))[self.first]
        self.spoken, self.spoken_size = np.split(self.rank[self.term[speaks]], ends[1:-1]), np.diff(ends)
        frequent = np.flatnonzero(self.every * RARE > n)
        self.dense = np.full(v, -1, np.int32)
        self.dense[frequent] = np.arange(len(frequent))
        d = self.dense[self.term]
        held = np.flatnonzero(d >= 0)
        matrix = np.zeros((n, len(frequent)), np.float64)
        matrix[row[held], d[held]] = w[held]
        self._order(matrix)
        del matrix
        self.matrix = np.zeros((len(frequent), self.columns), np.float64)
        self.matrix[d[held], self.place[row[held]]] = w[held]
        self.top = self.matrix.reshape(len(frequent), self.columns // BLOCK, BLOCK).max(2)
        # posting lists of the other terms
        rare = np.flatnonzero(d < 0)
        rare = rare[np.argsort(self.term[rare], kind="stable")]
        self.post_at, self.post_w = self.place[row[rare]], w[rare]
        self.post_first = np.searchsorted(self.term[rare], np.arange(v + 1))
        self._built = True
        del row, w, d, held, rare, speaks, ends, frequent
        release_memory()
        return self

    def _order(self, matrix: np.ndarray) -> None:
        """Columns of the examples: each label's in blocks of its own, like ones side by side. Order decides speed alone."""
        rng, n = np.random.default_rng(7), len(self.ids)
        pivots = matrix[rng.permutation(n)[:32]]
        near = matrix @ pivots.T
        group, best = near.argmax(1), near.max(1)
        self.place, blocks = np.zeros(n, np.int64), []
        at = 0
        for label in (0, 1):
            mine = np.flatnonzero(self.y == label)
            mine = mine[np.lexsort((best[mine], group[mine]))]
            self.place[mine] = at + np.arange(len(mine))
            k = (len(mine) + BLOCK - 1) // BLOCK
            blocks += [label] * k
            at += k * BLOCK
        self.columns, self.block_label = at, np.array(blocks, int)
        self.example = np.full(at, -1)
        self.example[self.place] = np.arange(n)

    def search(self, text: np.ndarray, term: np.ndarray, tf: np.ndarray, n: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: none) and cosines (0: none), nearest first, of the k nearest examples of label 0 and 1: (n, 2, k) each.

        Terms as ``text_terms`` gives them; ``without``: an example per text to leave out (-1: none)."""
        self.build()
        k = NEIGHBOURS
        at = places(self.vocabulary, term)
        w = np.log1p(tf) * np.append(self.idf, self.unseen)[at]
        norm = np.sqrt(np.bincount(text, w * w, n))
        w = w / norm[text]
        out_i, out_s = np.full((n, 2, k), -1), np.zeros((n, 2, k))
        post = np.append(np.diff(self.post_first), 0)[at]
        for lo, hi in _cuts(np.bincount(text, post, n)):
            a, b = np.searchsorted(text, [lo, hi])
            mine = a + np.flatnonzero(at[a:b] >= 0)
            skip = None if without is None else without[lo:hi]
            out_i[lo:hi], out_s[lo:hi] = self._some(text[mine] - lo, at[mine], w[mine], hi - lo, k, skip)
        return out_i, out_s

    def _some(self, text, at, w, n, k, skip):
        blocks = len(self.block_label)
        d = self.dense[at]
        q = np.zeros((n, len(self.matrix)))
        q[text[d >= 0], d[d >= 0]] = w[d >= 0]
        r = np.flatnonzero(d < 0)
        size = self.post_first[at[r] + 1] - self.post_first[at[r]]
        p = ranges(self.post_first[at[r]], size)
        score = np.bincount(np.repeat(text[r] * self.columns, size) + self.post_at[p], np.repeat(w[r], size) * self.post_w[p],
                            n * self.columns).astype(np.float64, copy=False).reshape(n, blocks, BLOCK)  # without rows it counts in integers
        bound = q @ self.top + score.max(2) + 1e-12
        done = np.zeros((n, blocks), bool)
        found_i, found_s = np.full((n, 2, k), -1), np.zeros((n, 2, k))
        for label in (0, 1):
            own = np.flatnonzero(self.block_label == label)
            best = np.argsort(-bound[:, own], axis=1, kind="stable")[:, :FIRST]
            wanted = np.zeros((n, len(own)), bool)
            np.put_along_axis(wanted, best, True, 1)
            for last in (False, True):
                for j in np.flatnonzero(wanted.any(0)):
                    rows, c = np.flatnonzero(wanted[:, j]), own[j]
                    score[rows, c] += q[rows] @ self.matrix[:, c * BLOCK:(c + 1) * BLOCK]
                    if skip is not None:
                        hit = rows[skip[rows] >= 0]
                        hit = hit[self.place[skip[hit]] // BLOCK == c]
                        score[hit, c, self.place[skip[hit]] % BLOCK] = 0
                    done[rows, c] = True
                if last:
                    break
                seen = score[np.arange(n)[:, None], own[best]].reshape(n, -1)
                kth = np.partition(seen, -k, axis=1)[:, -k] if seen.shape[1] >= k else np.zeros(n)
                wanted = ~done[:, own] & (bound[:, own] > 0) & (bound[:, own] >= kth[:, None])
            seen = np.where(done[:, own, None], score[:, own], 0).reshape(n, -1)
            numbers = self.example[(own[:, None] * BLOCK + np.arange(BLOCK)).ravel()]
            if seen.shape[1] > k:
                kth = np.partition(seen, -k, axis=1)[:, -k]
            else:
                kth = np.zeros(n)
            rows, cols = np.nonzero((seen >= kth[:, None]) & (seen > 0))
            s, i = seen[rows, cols], numbers[cols]
            o = np.lexsort((i, -s, rows))
            rows, s, i = rows[o], s[o], i[o]
            nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
            keep = nth < k
            found_i[rows[keep], label, nth[keep]], found_s[rows[keep], label, nth[keep]] = i[keep], s[keep]
        return found_i, found_s

    def vote(self, text, term, n, found: np.ndarray, cosine: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
        """The vote of the neighbours that ``search`` gave; ``label``: of texts that are examples, so their terms count one less."""
        self.build()
        at = places(self.vocabulary, term)
        some = np.flatnonzero(at >= 0)
        start, at = np.searchsorted(text[some], np.arange(n + 1)), at[some]
        if label is None:  # only terms with a voice are looked at
            voice, lists, size = self.voice[at], self.spoken, self.spoken_size
        else:
            y = label[text[some]]
            voice = _voice(self.toxic[at] - y, self.every[at] - 1, self.y.sum() - y, len(self.y) - 1)
            lists, size = np.split(self.rank[self.term], self.first[1:-1]), np.diff(self.first)
        at = self.rank[at]
        heard, out = np.zeros(len(self.idf)), np.zeros(n)
        for r in range(n):
            mine = at[start[r]:start[r + 1]]
            heard[mine] = voice[start[r]:start[r + 1]]
            near = found[r].ravel()  # -1 has cosine 0
            some = np.flatnonzero((near >= 0) & (size[near] > 0))
            said = np.zeros(len(near))
            if len(some):
                pick = near[some]
                ends = np.cumsum(size[pick])
                said[some] = np.add.reduceat(heard.take(np.concatenate([lists[i] for i in pick.tolist()])), ends - size[pick])
            total = cosine[r].sum(1)
            other, toxic = np.divide((cosine[r] * said.reshape(2, -1)).sum(1), total, out=np.zeros(2), where=total > 0)
            out[r] = toxic / (other + toxic + 1)
            heard[mine] = 0
        return out


def _voice(toxic, every, share, size):
    """Squared significance of ``toxic`` holders among ``every``, where ``share`` of ``size`` examples are toxic; 0 if they are fewer than expected."""
    expected = every * share / max(1, size)
    return np.maximum(0, toxic - expected) ** 2 / (expected + 1)


def pooled(votes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A rising step function from vote to share of toxic (start and value of each step): adjacent violators are pooled.
    A step starts midway between its first vote and the last one below it."""
    votes, place = np.unique(votes, return_inverse=True)
    w, t = np.bincount(place, weight), np.bincount(place, weight * y)
    pools: list[list[float]] = []  # first vote, last vote, weight, toxic weight
    for step in zip(votes.tolist(), votes.tolist(), w.tolist(), t.tolist()):
        pools.append(list(step))
        while len(pools) > 1 and pools[-2][3] / pools[-2][2] >= pools[-1][3] / pools[-1][2]:
            _, last, w1, t1 = pools.pop()
            pools[-1][1:] = last, pools[-1][2] + w1, pools[-1][3] + t1
    first, last = np.array([p[0] for p in pools]), np.array([p[1] for p in pools])
    return np.append(first[:1], (last[:-1] + first[1:]) / 2), np.array([p[3] / p[2] for p in pools])


def _own_votes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_caches()
        x = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            me = np.searchsorted(x.ids, b.column("doc_id").to_numpy())
            terms, tf = (b.column(c) for c in ("terms", "tf"))
            text = np.repeat(np.arange(b.num_rows), terms.value_lengths().to_numpy())
            term = terms.flatten().to_numpy().view(_U)
            found, cosine = x.search(text, term, tf.flatten().to_numpy(), b.num_rows, me)
            votes = x.vote(text, term, b.num_rows, found, cosine, x.y[me])
            yield pa.RecordBatch.from_arrays([pa.array(me, pa.int32()), pa.array(votes, pa.float64())], ["n", "vote"])
    return run


SCHEMA = "doc_id long, score double, nearest_id long, nearest_cosine double, nearest_toxic int"


def _scores(shared, steps: np.ndarray, values: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_caches()
        x = shared.value
        for b in arrow_slices(batches, limit=SLICE):
            n = b.num_rows
            text, term, tf = text_terms(b.column("text"))
            found, cosine = x.search(text, term, tf, n)
            votes = x.vote(text, term, n, found, cosine)
            score = values[np.maximum(0, np.searchsorted(steps, votes, side="right") - 1)]
            best = cosine[:, :, 0]
            label = (best[:, 1] > best[:, 0]).astype(np.int64)
            near, none = found[np.arange(n), label, 0], best.max(1) <= 0
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(score, pa.float64()), pa.array(x.ids[near], pa.int64(), mask=none),
                 pa.array(best.max(1), pa.float64(), mask=none), pa.array(label, pa.int32(), mask=none)],
                ["doc_id", "score", "nearest_id", "nearest_cosine", "nearest_toxic"])
    return run


def examples_of(docs: DataFrame, labelled: DataFrame, scratch: Scratch, examples: int = EXAMPLES):
    """(doc_id, y, terms, tf) of the examples and how many labelled rows one of label 0 and of 1 stands for, or None.

    ``labelled``: (doc_id, y) to learn from."""
    labelled = scratch.cut(labelled)
    picked = [labelled.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples) for y in (0, 1)]
    picked = scratch.cut(picked[0].unionByName(picked[1]))  # at most 2 * examples ids
    body = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(picked, "doc_id").repartition(24)
            .mapInArrow(_example_terms, "doc_id long, y int, terms array<long>, tf array<int>").dropDuplicates(["doc_id"])
            .where(F.size("terms") <= TERMS))
    body = scratch.cut(body)
    # at most ``examples`` rows a window: (doc_id, y, size)
    order = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id")
    kept = (body.select("doc_id", "y", F.size("terms").alias("size")).withColumn("sum", F.sum("size").over(order))
            .where(F.col("sum") <= ENTRIES).select("doc_id"))
    body = scratch.cut(body.join(kept, "doc_id"))
    count = {r.y: r.c for r in labelled.groupBy("y").agg(F.count("*").alias("c")).collect()}  # two rows
    size = {r.y: r.c for r in body.groupBy("y").agg(F.count("*").alias("c")).collect()}
    return (body, [count[y] / size[y] for y in (0, 1)]) if set(size) == {0, 1} else None


def score_documents(docs: DataFrame, labelled: DataFrame, scratch: Scratch, row: str = "doc_id") -> DataFrame:
    """doc_id (that is ``row``), score and the nearest example for every row of ``docs``."""
    sc, fitted = docs.sparkSession.sparkContext, examples_of(docs, labelled, scratch)
    docs = docs.select(F.col(row).cast("long").alias("doc_id"), "text")
    if fitted is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(None).cast("long").alias("nearest_id"),
                           F.lit(None).cast("double").alias("nearest_cosine"), F.lit(None).cast("int").alias("nearest_toxic"))
    body, stands_for = fitted
    own = body.toArrow().sort_by("doc_id").combine_chunks()  # at most 2 * EXAMPLES rows and 2 * ENTRIES entries
    terms, tf, y = own["terms"].combine_chunks(), own["tf"].combine_chunks(), own["y"].to_numpy()
    first = np.append(0, np.cumsum(terms.value_lengths().to_numpy()))
    vocabulary, place = np.unique(terms.flatten().to_numpy().view(_U), return_inverse=True)
    words = sc.broadcast(vocabulary)
    # document frequencies over all documents: a row a term
    counts = docs.mapInArrow(_document_counts(words), "t int, c long").groupBy("t").agg(F.sum("c").alias("c")).toArrow()
    words.destroy()
    t, c = counts["t"].to_numpy(), counts["c"].to_numpy()
    df, n = np.zeros(len(vocabulary)), int(c[t < 0].sum())
    df[t[t >= 0]] = c[t >= 0]
    shared = sc.broadcast(BlockMaxIndex(vocabulary, np.log((1 + n) / (1 + df)) + 1, np.log(1 + n) + 1, own["doc_id"].to_numpy(), y,
                                        first, place, tf.flatten().to_numpy()))
    votes = np.zeros(own.num_rows)
    for r in body.repartition(24).mapInArrow(_own_votes(shared), "n int, vote double").collect():
        votes[r.n] = r.vote
    steps, values = pooled(votes, y, np.array(stands_for)[y])
    out = scratch.cut(docs.mapInArrow(_scores(shared, steps, values), SCHEMA))
    shared.destroy()
    return out


def held_out(col="doc_id"):
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 3 == 1, F.lit(False))


def learnable(labels: DataFrame) -> DataFrame:
    """One (doc_id, y) per labelled document outside the held-out third."""
    return (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; labels from ``labels`` outside the held-out third."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    out = score_documents(docs, learnable(read_table(spark, sf_dir, "labels")), Scratch(spark, "toxicity"))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                      "nearest_id", "nearest_cosine", "nearest_toxic")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored at the threshold or over it go, each by its own text."""
    scratch = Scratch(spark, "toxicity")
    rows, key = row_ids(docs, scratch)
    out = score_documents(rows, learnable(read_table(spark, sf_dir, "labels")), scratch, key)
    gone = out.where(F.col("score") >= THRESHOLD).select(F.col("doc_id").alias(key)).distinct()
    return rows.join(gone, key, "left_anti").select(*docs.columns)
