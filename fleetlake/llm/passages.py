"""Substring dedup by collinear chaining.

1. Equal texts are one class: every document but the smallest doc_id of its class repeats that one as a whole, and
   only the smallest goes on.
2. Seeds are runs of ``K`` words whose smallest word hash is the first or the last of them: about a third of all runs,
   chosen by their own words alone, so that two texts choose alike, and at least one in any ``2 * K - 1`` equal words. A run that
   comes again within ``DIAGONAL_GAP`` words is also a seed together with its number of earlier times, so that periodic texts
   line up time by time.
3. Of the documents that hold a seed, in the order of doc_id, each is matched with the first and with the one before
   it. A seed that others hold too by chance has some chance holder as its first one; the document before is the
   next copy of the passage then, or the other way round. A passage in many documents costs two matches per document.
4. Per (document, earlier document) matches on one diagonal join to blocks, and blocks are chained in order: a chain's
   score is its words less ``GAP_COST`` per word skipped in either text, its best predecessor comes from a Fenwick tree
   of prefix maxima over ends in the earlier document. Chains whose seeds cover under ``EVIDENCE`` words are left.
5. The words around each chain are fetched from both texts and the chain is aligned: blocks grow over equal words, and
   the ends of a chain also over unequal ones as far as the words gained are ``SIMILAR`` or more; gaps are closed by edit
   distance. A chain of which less than ``SIMILAR`` matches is cut at its widest gap, until what is left does.
6. An aligned span counts only if it alone, against this one document, has ``LEAST`` words or more of which ``SIMILAR`` or
   more match. Of a document's spans those that others cover are left out.

A passage is reported in every document but the first that has it, with an earlier document (``source_id``) that
holds it, and the words that match there; spans of unlike sources may overlap. Words are as in the n-gram join.

Defined cases: null or empty texts have no passages; repeats within one document are no passage, and a
periodic run counts as far as the earlier document's is long; rows with a null
doc_id take no part, for a passage is reported by it; rows that share a doc_id are no copies of each other; an empty table
gives an empty table; clashing extra columns pass through the stage untouched. The stage numbers its rows, so there
rows without a doc_id or with one of several rows are documents like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch, arrow_slices, mix64, read_table, row_ids, sequence_hashes, unused_name, utf8, word_hashes

K = 6
EVIDENCE = 15  # words of a chain that its seeds cover; three seeds at least
DIAGONAL_GAP = 48  # words between matches of one block
GAP_COST = 0.05  # low, as seeds lie far apart; what is too far apart is cut again by the alignment
SIMILAR = 0.8
DROP = 4.0  # how far a growing end's score may fall under its best; an unequal word costs SIMILAR, an equal one gives the rest
LEAST = 50
GROW = 0.65  # similarity that lets an end grow on; whether the whole is SIMILAR is judged afterwards
NEAR = 12  # words behind an end that are looked at for a sign that the passage goes on
CELL = 64  # words of a fetched block
MARGIN = 48


def later_rounds(seeds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of seeds that come again within ``DIAGONAL_GAP`` words, and how many came before each in such a row."""
    order = np.lexsort((at, seeds))
    s, p = seeds[order], at[order]
    start = np.concatenate([[True], (s[1:] != s[:-1]) | (np.diff(p) > DIAGONAL_GAP)])
    rank = np.arange(len(s)) - np.maximum.accumulate(np.where(start, np.arange(len(s)), 0))
    return order[rank > 0], rank[rank > 0].astype(np.uint64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, MD5 of the text and its number of words."""
    for b in arrow_slices(batches):
        _, _, _, first = word_hashes(*utf8(b.column("text")))
        key = [hashlib.md5((t or "").encode()).digest() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(key, pa.binary()), pa.array(np.diff(first).astype(np.int64))],
                                         ["doc_id", "key", "n_words"])


def chosen(h: np.ndarray) -> np.ndarray:
    """Which runs of ``K`` words are seeds: the smallest word hash is at an end."""
    n = len(h) - K + 1
    if n <= 0:
        return np.zeros(0, bool)
    low = h[:n].copy()
    for i in range(1, K):
        np.minimum(low, h[i:i + n], out=low)
    return (h[:n] == low) | (h[K - 1:K - 1 + n] == low)


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in arrow_slices(batches):
        h, _, _, first = word_hashes(*utf8(b.column("text")))
        runs, take = sequence_hashes(h, K), chosen(h)
        ids, tok, doc, pos = b.column("doc_id").to_pylist(), [], [], []
        for i, (lo, hi) in enumerate(zip(first[:-1], first[1:])):
            if hi - lo >= K:
                at = np.flatnonzero(take[lo:hi - K + 1])
                seeds = runs[lo + at]
                again, rank = later_rounds(seeds, at)
                if len(again):  # a run that comes again: also under a name of its own for each time
                    seeds = np.concatenate([seeds, mix64(seeds[again] ^ (rank * np.uint64(0x9FB21C651E98DF25)))])
                    at = np.concatenate([at, at[again]])
                tok.append(seeds)
                pos.append(at)
                doc.append(np.full(len(at), ids[i], np.int64))
        if tok:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tok).view(np.int64)), pa.array(np.concatenate(doc)),
                                              pa.array(np.concatenate(pos).astype(np.int32))], ["tok", "doc", "pos"])


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each seed's place beside its first holder's and the one's before it, from rows in the order of (tok, doc, pos)."""
    # of the row before this batch: tok and doc; doc and pos of its seed's first holder, of itself, and of the holder before
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        tok, doc, pos = (b.column(c).to_numpy() for c in ("tok", "doc", "pos"))
        n = np.arange(len(tok))
        new_tok = np.concatenate([[last is None or tok[0] != last[0]], tok[1:] != tok[:-1]])
        new_doc = new_tok | np.concatenate([[last is None or doc[0] != last[1]], doc[1:] != doc[:-1]])
        at = np.maximum.accumulate(np.where(new_tok, n, -1))
        own = np.maximum.accumulate(np.where(new_doc, n, -1))  # first row of this seed in this document
        lo, apos = doc[at], pos[at]
        before, bpos = doc[np.maximum(own - 1, 0)], pos[np.maximum(own - 1, 0)]
        if last is not None:
            lo[at < 0], apos[at < 0] = last[2:4]
            before[own < 0], bpos[own < 0] = last[6:8]
            before[own == 0], bpos[own == 0] = last[4:6]
        last = (tok[-1], doc[-1], lo[-1], apos[-1], doc[-1], pos[-1], before[-1], bpos[-1])
        hit = doc != lo
        near = hit & (before != lo)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[hit], y[near]])) for x, y in ((doc, doc), (lo, before), (pos, pos), (apos, bpos))],
                                         ["doc", "lo", "pos", "apos"])


def diagonal_blocks(pos: np.ndarray, apos: np.ndarray) -> dict[tuple[int, int, int], int]:
    """(start, earlier start, words) of runs of matches on one diagonal, and the words that their seeds cover; within a
    run words may differ."""
    order = np.lexsort((pos, pos - apos))
    p, d = pos[order], (pos - apos)[order]
    step = np.diff(p)
    cut = np.flatnonzero((np.diff(d) != 0) | (step > DIAGONAL_GAP)) + 1
    covered = np.concatenate([[0], np.cumsum(np.minimum(step, K))])
    return {(int(p[lo]), int(p[lo] - d[lo]), int(p[hi - 1] - p[lo]) + K): int(covered[hi - 1] - covered[lo]) + K
            for lo, hi in zip([0, *cut], [*cut, len(p)])}


def chains(blocks: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Best-scoring collinear chains, each block in one at most."""
    ends = sorted({b + n for _, b, n in blocks})
    rank = {e: i + 1 for i, e in enumerate(ends)}
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (len(ends) + 1)
    score, back = [0.0] * len(blocks), [-1] * len(blocks)
    waiting = sorted(range(len(blocks)), key=lambda i: blocks[i][0] + blocks[i][2])
    done = 0
    for i, (a, b, n) in enumerate(blocks):
        while done < len(blocks) and blocks[waiting[done]][0] + blocks[waiting[done]][2] <= a:
            j = waiting[done]
            x, y, m = blocks[j]
            item, r = (score[j] + GAP_COST * (x + m + y + m), j), rank[y + m]
            while r <= len(ends):
                if item > tree[r]:
                    tree[r] = item
                r += r & -r
            done += 1
        best, r = (-1e18, -1), int(np.searchsorted(ends, b, side="right"))
        while r:
            best = max(best, tree[r])
            r -= r & -r
        gain = best[0] - GAP_COST * (a + b)
        score[i], back[i] = (n + gain, best[1]) if gain > 0 else (float(n), -1)
    used, out = set(), []
    for i in sorted(range(len(blocks)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and i not in used:
            used.add(i)
            chain.append(blocks[i])
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None

    def some(t, cuts: np.ndarray) -> pa.RecordBatch:
        doc, lo_, pos, apos = (t.column(c).to_numpy() for c in ("doc", "lo", "pos", "apos"))
        rows = []
        enough = np.flatnonzero(np.diff(cuts) * K >= EVIDENCE)  # fewer seeds can't cover as much
        for lo, hi in zip(cuts[enough], cuts[enough + 1]):
            blocks = diagonal_blocks(pos[lo:hi], apos[lo:hi])
            if sum(blocks.values()) >= EVIDENCE:
                rows += [(int(doc[lo]), int(lo_[lo]), c) for c in chains(sorted(blocks)) if sum(map(blocks.get, c)) >= EVIDENCE]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([[x for b in r[2] for x in b] for r in rows], pa.list_(pa.int32()))], ["doc", "lo", "blocks"])

    for b in batches:
        if not b.num_rows:
            continue
        t = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        doc, lo = (t.column(c).to_numpy() for c in ("doc", "lo"))
        cuts = np.concatenate([[0], np.flatnonzero((doc[1:] != doc[:-1]) | (lo[1:] != lo[:-1])) + 1])
        yield some(t, cuts)
        held = t.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield some(held, np.array([0, held.num_rows]))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes of every text, ``CELL`` words a row."""
    for b in arrow_slices(batches):
        h, _, _, first = word_hashes(*utf8(b.column("text")))
        h = (h >> np.uint64(32)).astype("<u4")
        rows = [(d, i, h[lo + i * CELL:min(hi, lo + (i + 1) * CELL)].tobytes())
                for d, lo, hi in zip(b.column("doc_id").to_pylist(), first[:-1], first[1:]) for i in range((hi - lo + CELL - 1) // CELL)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                          pa.array([r[2] for r in rows], pa.binary())], ["of", "cell", "words"])


def edit_matches(x: np.ndarray, y: np.ndarray) -> int:
    """Most words of two gaps that an alignment by least edits can match in order."""
    if not len(x) or not len(y):
        return 0
    row = np.zeros(len(y) + 1, np.int64)
    for w in x:
        row = np.maximum.accumulate(np.maximum(row, np.concatenate([[0], row[:-1] + (y == w)])))
    return int(row[-1])


def end_growth(same: np.ndarray) -> int:
    """Words by which an end grows over ``same`` (equal or not, outwards): to its best score before a fall of ``DROP``."""
    if not len(same):
        return 0
    score = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - SIMILAR, -SIMILAR))])
    top = np.maximum.accumulate(score)
    fallen = np.flatnonzero(top - score > DROP + 1e-9)
    score = score[:fallen[0]] if len(fallen) else score
    return len(score) - 1 - int(np.argmax(np.round(score, 9)[::-1]))


def gapped_growth(x: np.ndarray, y: np.ndarray) -> tuple[int, int, int]:
    """Words by which an end grows in both texts when words may also be put in or left out, and how many of them match.

    ``x`` and ``y`` run outwards from the end. An equal pair gains ``1 - GROW``, any other step costs ``GROW``; the
    best cell of the table wins, the longest of equal ones.
    """
    none = (0, 0, 0)
    if not set(x[:NEAR].tolist()) & set(y[:NEAR].tolist()):
        return none  # the texts part here
    step = GROW * np.arange(len(y) + 1)
    row, best, cell = -step, 0.0, none
    hits = np.zeros(len(y) + 1, np.int64)
    for i, w in enumerate(x.tolist(), 1):
        same = y == w
        cross = row[:-1] + np.where(same, 1 - GROW, -GROW)
        up = row - GROW
        new, got = up.copy(), hits.copy()
        better = cross > up[1:]
        new[1:][better] = cross[better]
        got[1:][better] = (hits[:-1] + same)[better]
        run = np.maximum.accumulate(new + step)  # a row's cells reached by leaving words of y out
        at = np.maximum.accumulate(np.where(new + step >= run, np.arange(len(run)), 0))
        row, hits = run - step, got[at]
        j = len(row) - 1 - int(np.argmax(np.round(row, 9)[::-1]))
        if row[j] >= best - 1e-9 and row[j] > 0:
            best, cell = row[j], (i, j, int(hits[j]))
    return cell


def align(blocks: list[tuple[int, int, int]], x: np.ndarray, x0: int, y: np.ndarray, y0: int) -> list[tuple[int, int, int, int, int]]:
    """(start, end, anchor start, anchor end, matching words) of a chain on the fetched words."""
    def grow(a: int, b: int, n: int) -> tuple[int, int, int]:
        while a > x0 and b > y0 and x[a - 1 - x0] == y[b - 1 - y0]:
            a, b, n = a - 1, b - 1, n + 1
        while a + n < x0 + len(x) and b + n < y0 + len(y) and x[a + n - x0] == y[b + n - y0]:
            n += 1
        return a, b, n

    grown = [grow(*b) for b in blocks]
    a, b, n = grown[0]
    m = min(a - x0, b - y0)
    more = end_growth((x[a - x0 - m:a - x0] == y[b - y0 - m:b - y0])[::-1])
    grown[0] = (a - more, b - more, n + more)
    a, b, n = grown[-1]
    m = min(x0 + len(x) - a - n, y0 + len(y) - b - n)
    grown[-1] = (a, b, n + end_growth(x[a + n - x0:a + n - x0 + m] == y[b + n - y0:b + n - y0 + m]))
    hits = [int((x[a - x0:a - x0 + n] == y[b - y0:b - y0 + n]).sum()) for a, b, n in grown]
    ends = []  # growth over words put in or left out, before the first block and behind the last
    for near, (a, b, n) in ((-1, grown[0]), (1, grown[-1])):
        if near < 0:
            outer = x[max(0, a - x0 - MARGIN):a - x0][::-1], y[max(0, b - y0 - MARGIN):b - y0][::-1]
        else:
            outer = x[a + n - x0:a + n - x0 + MARGIN], y[b + n - y0:b + n - y0 + MARGIN]
        ends.append(gapped_growth(*outer))
    gaps = []  # between blocks: words skipped, and how many of them match
    for (a, b, n), (c, d, _) in zip(grown[:-1], grown[1:]):
        ga, gb = c - a - n, d - b - n
        if ga < 0 or gb < 0:  # grown into each other
            gaps.append((0, -max(-ga, -gb)))
        elif ga <= 4 * CELL and gb <= 4 * CELL:
            gaps.append((max(ga, gb), edit_matches(x[a + n - x0:c - x0], y[b + n - y0:d - y0])))
        else:
            gaps.append((max(ga, gb), 0))
    out, todo = [], [(0, len(grown))]
    while todo:
        i, j = todo.pop()
        s, b0, _ = grown[i]
        e, b1 = (k + grown[j - 1][2] for k in grown[j - 1][:2])
        total = sum(hits[i:j]) + sum(m for _, m in gaps[i:j - 1])
        head, tail = ends[0] if i == 0 else (0, 0, 0), ends[1] if j == len(grown) else (0, 0, 0)
        for h, t in ((head, tail), (head, (0, 0, 0)), ((0, 0, 0), tail), ((0, 0, 0), (0, 0, 0))):
            span = (s - h[0], e + t[0], b0 - h[1], b1 + t[1], total + h[2] + t[2])
            if span[4] >= SIMILAR * max(span[1] - span[0], span[3] - span[2]):
                out.append(span)
                break
        else:
            if j - i == 1:
                continue
            widest = max(range(i, j - 1), key=lambda k: gaps[k][0])
            todo += [(i, widest + 1), (widest + 1, j)]
    return out


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for doc, lo, flat, cells in zip(*(b.column(c).to_pylist() for c in ("doc", "lo", "blocks", "cells"))):
            side: tuple[list, list] = ([], [])
            for c in cells:
                side[c["side"]].append((c["at"], c["words"]))
            if side[0] and side[1]:
                x, y = (np.frombuffer(b"".join(w for _, w in sorted(s)), "<u4") for s in side)
                blocks = list(zip(flat[::3], flat[1::3], flat[2::3]))
                got = align(blocks, x, min(side[0])[0], y, min(side[1])[0])
                rows += [(doc, lo, *r) for r in got if min(r[1] - r[0], r[3] - r[2]) >= LEAST * SIMILAR and r[1] - r[0] >= LEAST]
        names = ["doc", "lo", "s", "e", "ls", "le", "m"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(7)], names)


def uncovered(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The spans (start, end, source, matching words) that are left without those that others cover."""
    out: list[tuple[int, int, int, int]] = []
    for span in sorted(spans, key=lambda x: (x[0], -x[1], -x[3], x[2])):
        if out and span[1] <= out[-1][1]:
            continue
        while len(out) > 1 and span[0] <= out[-2][1]:  # the last one lies within its neighbours
            out.pop()
        out.append(span)
    return out


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(d, *r) for d, spans in zip(b.column("doc").to_pylist(), b.column("spans").to_pylist())
                for r in uncovered([(x["s"], x["e"], x["lo"], x["m"]) for x in spans])]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)],
                                         ["doc_id", "start_word", "end_word", "source_id", "matching_words"])


def repeated_passages(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, start_word, end_word, source_id, matching_words of every repeated passage."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    keys = scratch.cut(docs.mapInArrow(_keys, "doc_id long, key binary, n_words long"))
    first = keys.groupBy("key").agg(F.min("doc_id").alias("source_id"))
    copies = scratch.cut(keys.join(first, "key").where("doc_id <> source_id").select("doc_id", "source_id", "n_words"))
    scratch.drop(keys)
    docs = docs.join(copies.select("doc_id"), "doc_id", "left_anti")
    seeds = docs.mapInArrow(_seeds, "tok long, doc long, pos int")
    # seeds are shuffled once and streamed in order, whatever the size of a seed's group
    matches = seeds.repartition("tok").sortWithinPartitions("tok", "doc", "pos").mapInArrow(_matches, "doc long, lo long, pos int, apos int")
    found = scratch.cut(matches.repartition("doc", "lo").sortWithinPartitions("doc", "lo", "pos", "apos")
                        .mapInArrow(_chains, "doc long, lo long, blocks array<int>"))
    last = F.size("blocks")
    first_end = [(F.element_at("blocks", k), F.element_at("blocks", last - 2 + k - 1) + F.element_at("blocks", last)) for k in (1, 2)]
    found = found.withColumn("chain", F.xxhash64("doc", "lo", "blocks"))
    wanted = None
    for side, (who, (s, e)) in enumerate(zip(("doc", "lo"), first_end)):
        cells = F.sequence(F.floor(F.greatest(s - MARGIN, F.lit(0)) / CELL).cast("int"), F.floor((e + MARGIN) / CELL).cast("int"))
        rows = found.select("chain", F.lit(side).alias("side"), F.col(who).alias("of"), F.greatest(s - MARGIN, F.lit(0)).alias("from"),
                            (e + MARGIN).alias("to"), F.explode(cells).alias("cell"))
        wanted = rows if wanted is None else wanted.unionByName(rows)
    need = scratch.cut(wanted.select("of", "cell").distinct())
    cells = scratch.cut(docs.mapInArrow(_cells, "of long, cell int, words binary").join(need, ["of", "cell"], "left_semi")
                        .dropDuplicates(["of", "cell"]))
    skip = F.greatest(F.col("from") - F.col("cell") * CELL, F.lit(0))  # of a cell only the words that the chain may reach
    upto = F.least(F.col("to") - F.col("cell") * CELL, F.lit(CELL))
    part = F.struct("side", (F.col("cell") * CELL + skip).alias("at"), F.substring("words", skip * 4 + 1, (upto - skip) * 4).alias("words"))
    gathered = wanted.join(cells, ["of", "cell"]).select("chain", part.alias("part")).groupBy("chain").agg(F.collect_list("part").alias("cells"))
    spans = found.join(gathered, "chain").select("doc", "lo", "blocks", "cells").mapInArrow(
        _aligned, "doc long, lo long, s long, e long, ls long, le long, m long")
    spans = scratch.cut(spans)
    scratch.drop(need, cells)
    merged = spans.groupBy("doc").agg(F.collect_list(F.struct("s", "e", "lo", "m")).alias("spans"))  # spans of one text
    whole = copies.where(F.col("n_words") >= LEAST).dropDuplicates(["doc_id", "source_id"]).select(
        "doc_id", F.lit(0).cast("long").alias("start_word"), F.col("n_words").alias("end_word"), "source_id", F.col("n_words").alias("matching_words"))
    return merged.mapInArrow(_merged, "doc_id long, start_word long, end_word long, source_id long, matching_words long").unionByName(whole)


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return repeated_passages(read_table(spark, sf_dir, "documents", "doc_id", "text"), Scratch(spark, "passages"))


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    raw = np.frombuffer(text.encode(), np.uint8)
    _, start, end, _ = word_hashes(raw, np.array([0, len(raw)]))
    out, at, data = [], 0, raw.tobytes()
    for s, e in sorted(spans):
        if e <= len(start):  # spans of another row of the same doc_id may lie beyond this text
            out.append(data[at:start[s]])
            at = max(at, start[e] if e < len(start) else len(data))
    out.append(data[at:])
    return b"".join(out).decode()


def _cut_texts(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_slices(batches):
            text = [t if not s or t is None else _without(t, [(x["start_word"], x["end_word"]) for x in s])
                    for t, s in zip(b.column("text").to_pylist(), b.column(b.num_columns - 1).to_pylist())]
            cols = []
            for n in names:
                col = b.column(n)
                if n == "text":
                    col = pa.array(text, col.type)
                elif n == "n_chars":
                    col = pa.array([len(t) if s and t is not None else c for t, s, c in zip(text, b.column(b.num_columns - 1).to_pylist(), col.to_pylist())], col.type)
                cols.append(col)
            out = pa.RecordBatch.from_arrays(cols, names)
            keep = [not s or bool(t and t.strip()) for t, s in zip(text, b.column(b.num_columns - 1).to_pylist())]
            yield out.filter(pa.array(keep, pa.bool_()))
    return run


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of all rows but their first, also of rows that share a doc_id or have none; a row of
    which nothing is left goes."""
    scratch = Scratch(spark, "passages")
    rows, key = row_ids(docs, scratch)
    found = repeated_passages(rows.select(F.col(key).alias("doc_id"), "text"), scratch)
    name = unused_name("spans", rows.columns)
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "end_word")).alias(name))
    spans = spans.withColumnRenamed("doc_id", key)
    return rows.join(spans, key, "left").select(*docs.columns, name).mapInArrow(_cut_texts(docs.columns), docs.schema)
