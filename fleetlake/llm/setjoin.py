"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections.

A document is the set of its distinct 5-word shingles, each a 64-bit hash. Two sets link when
``100 * intersection >= 80 * union``.

1. Equal sets are one class (key: a 64-bit fingerprint and the size); the class's smallest doc_id stands for it.
2. Shingles are put in one global order, rare ones first, by a table of ``SKETCH`` counters filled from all
   documents. Linked sets must share a shingle among their first ``n - ceil(0.8 n) + 1``; sets that share one
   there form a tile. The order decides only how small tiles are; any order gives all links.
3. Every class is compared with the smallest member and the hub (the one that has most of its prefix in common
   with others) that most of its tiles name; components of these links label the classes. Then only
   tiles that hold several labels are left, each set of members once, and in them only pairs of different labels.
4. A tile of two is its one pair. A larger tile is cut into blocks of about ``TILE`` members. Its members are
   banded by signature width (a power of two of at least 2 bits per shingle): a pair of one or two neighbouring
   bands whose sizes differ by a factor 1.25 at most may link if the bit counts, which bound the overlap from
   above, let it. A tile gives the members of such pairs and a forest over their labels, not the pairs: fewer
   rows than it has members, however many pairs there are.
5. Labels joined by the forests are a group; a link lies within one. Each member's array (sorted, the hashes' low
   48 bits) goes to its group, cut into blocks of about ``TILE`` members and ``ELEMENTS`` elements of which every two meet,
   and the pairs that may link there are intersected exactly, but those that links found before already join.

Defined cases: a null or empty text, or one without words, has no shingles, n_shingles 0, and its own doc_id
as component; under 5 words the whole sequence is the one shingle; repeated rows give repeated rows; rows of one
doc_id with unlike texts are one document in the links, each row with its own n_shingles; rows with
a null doc_id are left out of the join (they have no name to link) and come back with a null component; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch, arrow_slices, components, mix64, read_table, row_ids, shingle_sets, utf8

WORDS = 5
SKETCH = 1 << 19  # counters of the order table, in all
SKETCH_ROWS = 64
TILE = 2048  # members of a tile's or a group's block
HASHES = 1 << 21  # of doc_ids, broadcast to pick texts
ELEMENTS = 1 << 19  # elements of the sets in a group's block
_U = np.uint64


def _prefix(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1


def signature(s: np.ndarray) -> bytes:
    """A bit set of at least 2 bits per element, a power of two wide."""
    bits = max(64, 1 << int(2 * len(s) - 1).bit_length())
    sig = np.zeros(bits, np.uint8)
    sig[(s >> _U(16)) & _U(bits - 1)] = 1
    return np.packbits(sig, bitorder="little").tobytes()


def overlap_bound(a: bytes, b: bytes, na: int, nb: int) -> int:
    """No two sets with these signatures and sizes have more elements in common."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x = np.bitwise_or.reduce(x.reshape(-1, len(y)))
    elif len(y) > len(x):
        y = np.bitwise_or.reduce(y.reshape(-1, len(x)))
    return (na + nb - int(np.bitwise_count(x ^ y).sum())) // 2


def _fingerprint(s: np.ndarray) -> int:
    x = mix64(s + _U(len(s)))
    return int((mix64(np.array([np.bitwise_xor.reduce(x) ^ (x.sum(dtype=_U) << _U(1)) ^ _U(len(s))], _U)) >> _U(1))[0])


def _sets(b: pa.RecordBatch) -> list[np.ndarray]:
    return shingle_sets(*utf8(b.column("text")), WORDS)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, fingerprint and signature of each document; at a partition's end its part of the counters."""
    counts = np.zeros(SKETCH, np.uint32)
    names = ["doc_id", "n", "fp", "sig", "slot", "counts"]
    for b in arrow_slices(batches):
        sets = _sets(b)
        if any(map(len, sets)):
            counts += np.bincount((np.concatenate(sets) & _U(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint32)
        n = len(sets)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([_fingerprint(s) if len(s) else None for s in sets], pa.int64()),
             pa.array([signature(s) if len(s) else None for s in sets], pa.binary()),
             pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
    if counts.any():
        k = SKETCH_ROWS
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()),
             pa.array(range(k), pa.int32()), pa.array([c.tobytes() for c in counts.reshape(k, -1)], pa.binary())], names)


def _order_table(counters: DataFrame) -> np.ndarray:
    """Eighths of the binary logarithm of each counter: ``SKETCH`` bytes, whatever the input."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.uint32).astype(np.uint64) for c in pdf["counts"])
        level = np.minimum(255, 8 * np.log2(1.0 + total)).astype(np.uint8)
        return pd.DataFrame({"slot": [int(pdf["slot"].iloc[0])], "level": [level.tobytes()]})

    # a few counters of each partition meet in a row; then the rows of one slot
    rows = counters.groupBy("slot").applyInPandas(add, "slot int, level binary").collect()
    if not rows:
        return np.zeros(SKETCH, np.uint8)
    return np.frombuffer(b"".join(bytes(r.level) for r in sorted(rows, key=lambda r: r.slot)), np.uint8)


def _postings(level):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = level.value, set()
        for b in arrow_slices(batches):
            tok, fps, n = [], [], []
            for s in _sets(b):
                if not len(s) or (fp := _fingerprint(s)) in seen:
                    continue
                seen.add(fp)
                k = _prefix(len(s))
                if k < len(s):
                    key = (table[(s & _U(SKETCH - 1)).astype(np.int64)].astype(_U) << _U(56)) | (s >> _U(8))
                    s = s[np.argpartition(key, k - 1)[:k]]
                tok.append(s)
                fps.append(fp)
                n.append(len(s))
            if tok:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tok).view(np.int64)),
                                                  pa.array(np.repeat(np.array(fps, np.int64), n))], ["tok", "fp"])
    return run


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprint of each set and the low 48 bits of its elements, sorted by them."""
    for b in arrow_slices(batches):
        sets = [s for s in _sets(b) if len(s)]
        low = [np.sort(s & _U(2**48 - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array(list(map(_fingerprint, sets)), pa.int64()), pa.array(low, pa.binary())], ["fp", "arr"])


def _unpack(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(x, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        c = {k: b.column(k).to_pylist() for k in ("na", "nb", "sa", "sb")}
        keep = [5 * min(x, y) >= 4 * max(x, y) and 9 * overlap_bound(p, q, x, y) >= 4 * (x + y) for x, y, p, q in zip(*c.values())]
        yield b.select(["a_", "b_"]).filter(pa.array(keep, pa.bool_()))


def pair_slices(n: np.ndarray, label: np.ndarray, sig: list[bytes], side: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members (i, j) of one tile with different labels that sizes and signatures let link, about a million at most at a time.

    ``side``: the block of each member where the tile pairs two blocks (pairs within a block are another tile's).
    """
    names, inverse, count = np.unique(label, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return
    left = np.flatnonzero(inverse != count.argmax())  # pairs within the largest label aren't asked
    width = np.array(list(map(len, sig)))
    for w in np.unique(width[left]):
        own = left[width[left] == w]
        for v in (w // 2, w, 2 * w):
            other = np.flatnonzero(width == v)
            if not len(other):
                continue
            x = np.frombuffer(b"".join(sig[i] for i in own), np.uint64).reshape(len(own), -1)
            y = np.frombuffer(b"".join(sig[i] for i in other), np.uint64).reshape(len(other), -1)
            k = min(x.shape[1], y.shape[1])
            x = np.bitwise_or.reduce(x.reshape(len(own), -1, k), axis=1)
            y = np.bitwise_or.reduce(y.reshape(len(other), -1, k), axis=1)
            step = max(1, (1 << 20) // (len(other) * k))
            for lo in range(0, len(own), step):
                i = own[lo:lo + step]
                small, large = np.minimum(n[i][:, None], n[other]), np.maximum(n[i][:, None], n[other])
                far = np.bitwise_count(x[lo:lo + step, None, :] ^ y[None, :, :]).sum(2, dtype=np.int64)
                ok = (label[i][:, None] != label[other]) & (5 * small >= 4 * large) & (9 * ((small + large - far) // 2) >= 4 * (small + large))
                if side is not None:
                    ok &= side[i][:, None] != side[other]
                r, c = np.nonzero(ok)
                if len(r):
                    yield i[r], other[c]


def _joined(out: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])) if out else (np.zeros(0, int),) * 2


def tile_pairs(n: np.ndarray, label: np.ndarray, sig: list[bytes], side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ``pair_slices`` at once: the square of a tile's members."""
    return _joined(list(pair_slices(n, label, sig, side)))


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.RecordBatch]:
    """The rows of each key from batches sorted by it."""
    held = None
    for b in batches:
        t = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        if not t.num_rows:
            continue
        k = np.column_stack([t.column(c).to_numpy() for c in keys])
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield t.slice(lo, hi - lo)
        held = t.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held


def forest(i: np.ndarray, j: np.ndarray, part: np.ndarray, links=None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) that join the same members as all pairs do, one less than the parts they join.

    ``part``: of each member, which others it is joined with already. ``links(i, js)``: those of the pairs that count."""
    return _grow(i, j, part.copy(), links)


def _grow(i: np.ndarray, j: np.ndarray, part: np.ndarray, links=None) -> tuple[np.ndarray, np.ndarray]:
    """``forest``, which keeps in ``part`` what it has joined."""
    out = []
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    cuts = np.flatnonzero(i[1:] != i[:-1]) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(i)]):
        if lo == hi:
            continue
        me, js = int(i[lo]), j[lo:hi]
        js = js[part[js] != part[me]]
        if links is not None and len(js):
            js = js[links(me, js)]
        if len(js):
            parts, at = np.unique(part[js], return_index=True)
            out.append((np.full(len(at), me), js[at]))
            part[np.isin(part, parts)] = part[me]
    return _joined(out)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by tile (tok, bi, bj): labels (a_, b_) that members may join, and the fingerprints of these members;
    each once per partition."""
    seen: list[set] = [set(), set()]
    for t in _runs(batches, "tok", "bi", "bj"):
        fp, label = t.column("fp").to_numpy(), t.column("label").to_numpy()
        side = None if t.column("bi")[0].as_py() == t.column("bj")[0].as_py() else t.column("block").to_numpy()
        part, met, out = np.unique(label, return_inverse=True)[1], np.zeros(len(fp), bool), []
        for i, j in pair_slices(t.column("n").to_numpy(), label, t.column("sig").to_pylist(), side):
            met[i] = met[j] = True
            out.append(_grow(i, j, part))
        p, q = _joined(out)
        edges = set(zip(np.minimum(label[p], label[q]).tolist(), np.maximum(label[p], label[q]).tolist())) - seen[0]
        asked = set(fp[met].tolist()) - seen[1]
        for old, new in zip(seen, (edges, asked)):
            if len(old) < 500_000:  # only spares rows: they are made distinct afterwards
                old |= new
        if edges or asked:
            none = [None] * len(edges)
            yield pa.RecordBatch.from_arrays([pa.array([*(e[0] for e in edges), *[None] * len(asked)], pa.int64()),
                                              pa.array([*(e[1] for e in edges), *[None] * len(asked)], pa.int64()),
                                              pa.array([*none, *asked], pa.int64())], ["a_", "b_", "fp"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of ids that join the labels of a group's block pair as all its links do, from rows sorted by (grp, bi, bj)."""
    for t in _runs(batches, "grp", "bi", "bj"):
        label, ids = t.column("label").to_numpy(), t.column("id").to_numpy()
        side = None if t.column("bi")[0].as_py() == t.column("bj")[0].as_py() else t.column("block").to_numpy()
        sets = [_unpack(x) for x in t.column("arr").to_pylist()]
        n = np.array(list(map(len, sets)))
        first = np.append(0, np.cumsum(n))
        place = mine = None

        def links(me: int, js: np.ndarray) -> np.ndarray:
            mine[place[first[me]:first[me + 1]]] = 1
            both = np.add.reduceat(mine[np.concatenate([place[first[k]:first[k + 1]] for k in js])], np.append(0, np.cumsum(n[js])[:-1]))
            mine[place[first[me]:first[me + 1]]] = 0
            return 100 * both >= 80 * (n[me] + n[js] - both)

        part = np.unique(label, return_inverse=True)[1]
        for i, j in pair_slices(n, label, [signature(x) for x in sets], side):
            if place is None:
                place = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
                mine = np.zeros(place.max() + 1, np.int32)
            p, q = _grow(i, j, part, links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[p], pa.int64()), pa.array(ids[q], pa.int64())], ["a", "b"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in arrow_slices(batches, "xa"):
        keep, last, x = [], None, None
        for p, q in zip(b.column("xa").to_pylist(), b.column("xb").to_pylist()):
            if p is not last:
                last, x = p, _unpack(p)
            y = _unpack(q)
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            inter = int((both[1:] == both[:-1]).sum())
            keep.append(100 * inter >= 80 * (len(x) + len(y) - inter))
        yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Each row once per pair (bi, bj) of ``blocks`` that its own ``block``, by its fingerprint, is in."""
    return (rows.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")))


class JaccardJoin:
    """One run over a table of (doc_id, text). ``result()`` has a row per document."""

    def __init__(self, docs: DataFrame, scratch: Scratch):
        self.docs, self.s = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), scratch

    def profile(self) -> None:
        out = self.s.cut(self.docs.mapInArrow(
            _profile, "doc_id long, n long, fp long, sig binary, slot int, counts binary"))
        self.prof = out.where("slot IS NULL")
        level = _order_table(out.where("slot IS NOT NULL").select("slot", "counts"))
        self.level = out.sparkSession.sparkContext.broadcast(level)  # SKETCH bytes
        # a class: its sets' size, its smallest doc_id, its signature
        self.reps = self.s.cut(self.prof.where("n > 0 AND doc_id IS NOT NULL").groupBy("fp", "n").agg(
            F.min("doc_id").alias("id"), F.max("sig").alias("sig")), out)

    def tiles(self) -> None:
        post = self.docs.where("doc_id IS NOT NULL").mapInArrow(_postings(self.level), "tok long, fp long")
        tile = Window.partitionBy("tok")
        self.posts = self.s.cut(post.withColumn("low", F.min("fp").over(tile)).withColumn("high", F.max("fp").over(tile))
                                .where("low <> high").drop("high"))

    def bound(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a_, b_) of fingerprints that sizes and signatures let link."""
        r = self.reps
        pairs = (pairs.join(r.select(F.col("fp").alias("a_"), F.col("n").alias("na"), F.col("sig").alias("sa")), "a_")
                 .join(r.select(F.col("fp").alias("b_"), F.col("n").alias("nb"), F.col("sig").alias("sb")), "b_"))
        return pairs.select("a_", "b_", "na", "nb", "sa", "sb").mapInArrow(_bounded, "a_ long, b_ long")

    def arrays(self, ids: DataFrame) -> DataFrame:
        """(fp, arr) of the texts of these doc_ids, by fingerprint (rows of one doc_id may have unlike texts), and of some others.

        Texts aren't shuffled: those whose doc_id has the hash of a wanted one stay, told by at most ``HASHES`` numbers."""
        key = F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)).alias("key")
        texts = self.docs.select("text", key).join(F.broadcast(ids.select(key).distinct()), "key", "left_semi").select("text")
        return self.s.cut(texts.mapInArrow(_arrays, "fp long, arr binary").dropDuplicates(["fp"]))

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a_, b_) of fingerprints, the linked ones as pairs of ids (a, b)."""
        r = self.reps
        pairs = (pairs.join(r.select(F.col("fp").alias("a_"), F.col("id").alias("a")), "a_")
                 .join(r.select(F.col("fp").alias("b_"), F.col("id").alias("b")), "b_"))
        pairs = self.s.cut(pairs.select("a_", "b_", "a", "b"), self.members)
        arrays = self.arrays(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct())
        both = (pairs.join(arrays.select(F.col("fp").alias("b_"), F.col("arr").alias("xb")), "b_")
                .join(arrays.select(F.col("fp").alias("a_"), F.col("arr").alias("xa")), "a_"))
        out = self.s.cut(both.select("a", "b", "xa", "xb").mapInArrow(_linked, "a long, b long"), arrays)
        self.s.drop(pairs, arrays)
        return out

    def label(self) -> None:
        """Labels from two links at most per class: to the smallest fingerprint of its tiles and to their hub, the ones
        that most of its tiles name. A hub is the member of which the largest part of the
        prefix is shared: a text that was copied with changes shares all of it, its copies have shingles of their
        own. Links only save work; ``mixed`` finds every other one."""
        self.members = self.s.cut(self.posts.select("tok", "fp").distinct(), self.posts)
        prefix = F.expr("n - (4 * n + 4) div 5 + 1")
        own = self.s.cut(self.members.groupBy("fp").agg(F.count("*").alias("c")).join(self.reps.select("fp", "n"), "fp")
                         .select("fp", (F.col("c") / prefix).alias("part")), self.members)
        hubs = self.s.cut(self.members.join(own, "fp").groupBy("tok").agg(F.max_by("fp", F.struct("part", "fp")).alias("hub")), self.members)
        stars = None
        for end, rows in (("low", self.posts), ("hub", self.members.join(hubs, "tok"))):
            votes = rows.where(F.col("fp") != F.col(end)).groupBy("fp", end).agg(F.count("*").alias("c"))
            star = (votes.groupBy("fp").agg(F.max_by(end, F.struct("c", end)).alias("b_"))
                    .select(F.least("fp", "b_").alias("a_"), F.greatest("fp", "b_").alias("b_")))
            stars = star if stars is None else stars.unionByName(star)
        self.edges = self.verify(self.bound(stars.distinct()))
        self.s.drop(own, hubs)
        labels = components(self.edges, self.s, self.edges)
        self.labelled = self.s.cut(self.reps.join(labels, "id", "left").select(
            "fp", "n", "sig", F.coalesce("component", "id").alias("label")), self.reps)

    def mixed(self) -> None:
        """Links between labels, from tiles that hold several."""
        rows = self.s.cut(self.members.join(self.labelled.select("fp", "label"), "fp"), self.members)
        several = self.s.cut(rows.groupBy("tok").agg(
            F.min("label").alias("x"), F.max("label").alias("y"), F.min("fp").alias("a_"), F.max("fp").alias("b_"),
            F.count("*").alias("c"), F.sum(F.xxhash64("fp").cast("decimal(38,0)")).alias("all")).where("x <> y")
            # tiles of the same members ask the same pairs: one of them stays
            .groupBy("a_", "b_", "c", "all").agg(F.min("tok").alias("tok")).select("tok", "a_", "b_", "c", F.ceil(F.col("c") / F.lit(TILE)).cast("int").alias("blocks")), rows)
        # a tile of two members is its one pair; many tiles are the same two
        twos = self.bound(several.where("c = 2").select("a_", "b_").distinct())
        tiles = _block_pairs(rows.select("tok", "fp").join(several.where("c > 2").select("tok", "blocks"), "tok").join(self.labelled, "fp"))
        tiles = tiles.select("tok", "bi", "bj", "block", "fp", "n", "label", "sig")
        asked = self.s.cut(tiles.repartition("tok", "bi", "bj").sortWithinPartitions("tok", "bi", "bj").mapInArrow(_tiles, "a_ long, b_ long, fp long"))
        more = self.verify(twos)
        links = self.edges, more, self.grouped(asked)
        self.edges = self.s.cut(links[0].unionByName(links[1]).unionByName(links[2]), *links)

    def grouped(self, asked: DataFrame) -> DataFrame:
        """Links between labels of a group; ``asked``: pairs of labels (a_, b_) that members ``fp`` may join."""
        groups = components(asked.where("a_ IS NOT NULL").select(F.col("a_").alias("a"), F.col("b_").alias("b")), self.s, asked)
        members = self.s.cut(asked.where("fp IS NOT NULL").select("fp").distinct().join(self.labelled.select("fp", "n", "label"), "fp")
                             .join(groups.select(F.col("id").alias("label"), F.col("component").alias("grp")), "label")
                             .join(self.reps.select("fp", "id"), "fp"), self.reps)
        arrays = self.arrays(members.select(F.col("id").alias("doc_id")).distinct())
        sizes = members.groupBy("grp").agg(F.ceil(F.greatest(F.count("*") / F.lit(TILE), F.sum("n") / F.lit(ELEMENTS))).cast("int").alias("blocks"))
        rows = _block_pairs(members.join(sizes, "grp")).join(arrays, "fp").select("grp", "bi", "bj", "block", "id", "label", "arr")
        out = self.s.cut(rows.repartition("grp", "bi", "bj").sortWithinPartitions("grp", "bi", "bj").mapInArrow(_groups, "a long, b long"))
        self.s.drop(members, arrays)
        return out

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id."""
        self.profile()
        self.tiles()
        self.label()
        self.mixed()
        found = components(self.edges, self.s, self.edges)
        classes = self.s.cut(self.reps.join(found, "id", "left").select(
            "fp", "n", F.coalesce("component", "id").alias("component_id")), self.reps)
        return self.prof.join(classes, ["fp", "n"], "left").select(
            "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def jaccard_components(docs: DataFrame, scratch: Scratch) -> DataFrame:
    return JaccardJoin(docs, scratch).result()


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return jaccard_components(read_table(spark, sf_dir, "documents", "doc_id", "text"), Scratch(spark, "jaccard"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: that of the smallest doc_id. Rows that share a doc_id or have none are
    compared like any other."""
    scratch = Scratch(spark, "jaccard")
    rows, key = row_ids(docs, scratch)
    found = jaccard_components(rows.select(F.col(key).alias("doc_id"), "text"), scratch)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct()
    return rows.join(gone, key, "left_anti").select(*docs.columns)
