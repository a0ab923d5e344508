"""URL filters by a sorted digest array.

A rule is a host, a path and a verdict; it fits a url whose host is the rule's or lies under it and whose path
starts with the rule's. The list is written once to the shared scratch folder as one binary file: 64-bit xxhash
keys in order, beside them the full strings and what belongs to them. Two such arrays lie in it: the rules' hosts,
each with the path lengths its rules have, and the rules themselves. Spark hands the file to every executor
(``addFile``); tasks map it into memory, so the workers of a machine share its pages. A batch of urls is probed by
vectorised binary search: first its distinct host suffixes (no longer than the longest rule host), then, for
listed hosts only, the path prefixes of the lengths at hand. Every hit is confirmed on the stored string, so equal
digests of unlike strings change nothing. Urls are never shuffled.

A list of more than ``LIST_BYTES`` is not collected: its rules are joined by host suffix instead, in Spark.

Of the fitting rules the longest (host and path, in UTF-8 bytes) wins, then the one with the longer host; among
rules of the same host and path ``block`` wins. Without a rule the verdict is ``default``: not listed, allowed.

Defined cases: host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path is
what follows up to ``?``, ``#`` or the end; both are empty for a null url or one without ``://``, which no rule fits
but one for an empty host. Rules with a null host take no part, a null path is an empty one. Rows with a null or
repeated page_id, and rows repeated in full, are judged each on its own; an empty table gives an empty table;
columns other than page_id and url are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch, read_table

# host, path, verdict
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
VERDICTS = ("allow", "block")
LIST_BYTES = 64 << 20  # about two million rules; a longer list is joined
OUT = "page_id long, host string, path string, rule string, verdict string"

_UPPER = bytes(range(65, 91))
_TO_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_HOST_END, _PATH_END = re.compile(rb"[/?#]"), re.compile(rb"[?#]")


def host_and_path(url: str | None) -> tuple[bytes, bytes]:
    raw = b"" if url is None else url.encode()
    at = raw.find(b"://")
    if at < 0:
        return b"", b""
    rest = raw[at + 3:]
    end = _HOST_END.search(rest)
    host, rest = (rest, b"") if end is None else (rest[:end.start()], rest[end.start():])
    end = _PATH_END.search(rest)
    return host.translate(_TO_LOWER), rest if end is None else rest[:end.start()]


class DigestArray:
    """Distinct byte strings in the order of their digests."""

    def __init__(self, digests: np.ndarray, offsets: np.ndarray, blob: np.ndarray):
        self.digests, self.offsets, self.blob = digests, offsets, blob

    @classmethod
    def build(cls, strings: Sequence[bytes], digest=xxhash.xxh64_intdigest) -> tuple[DigestArray, np.ndarray]:
        """The array, and the place in ``strings`` of each of its entries."""
        keys = np.fromiter(map(digest, strings), np.uint64, len(strings))
        order = np.argsort(keys, kind="stable")
        laid = [strings[i] for i in order]
        return cls(keys[order], np.cumsum([0, *map(len, laid)]).astype(np.int64), np.frombuffer(b"".join(laid), np.uint8)), order

    def __getitem__(self, i: int) -> bytes:
        return self.blob[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def find(self, strings: Sequence[bytes], digest=xxhash.xxh64_intdigest) -> np.ndarray:
        """The place of each string, or -1."""
        out = np.full(len(strings), -1, np.int64)
        if not len(self.digests) or not strings:
            return out
        keys = np.fromiter(map(digest, strings), np.uint64, len(strings))
        first = np.searchsorted(self.digests, keys, "left")
        past = np.searchsorted(self.digests, keys, "right")
        for i in np.flatnonzero(past > first):
            for at in range(first[i], past[i]):  # more than one place only for digests that collide
                if self[at] == strings[i]:
                    out[i] = at
                    break
        return out


class RuleFile:
    """The mapped arrays of one list."""

    TYPES = ("u8", "i8", "u1", "i8", "i8", "u8", "i8", "u1", "u1")

    def __init__(self, arrays: list[np.ndarray]):
        self.hosts, self.rules = DigestArray(*arrays[:3]), DigestArray(*arrays[5:8])
        self.length_offsets, self.lengths, self.verdicts = arrays[3], arrays[4], arrays[8]
        self.labels = max((self.hosts[i].count(b".") + 1 for i in range(len(self.hosts.digests))), default=0)

    @classmethod
    def pack(cls, rules: Sequence[tuple[bytes, bytes, str]]) -> bytes:
        """The file of (host, path, verdict) rules."""
        best: dict[tuple[bytes, bytes], int] = {}
        for host, path, verdict in rules:
            best[host, path] = max(best.get((host, path), 0), VERDICTS.index(verdict))
        by_host: dict[bytes, set[int]] = {}
        for host, path in best:
            by_host.setdefault(host, set()).add(len(path))
        hosts, order = DigestArray.build(list(by_host))
        lengths = [sorted(list(by_host.values())[i]) for i in order]
        found, at = DigestArray.build([h + b"\0" + p for h, p in best])
        verdicts = np.array(list(best.values()), np.uint8)[at]
        arrays = [hosts.digests, hosts.offsets, hosts.blob, np.cumsum([0, *map(len, lengths)]), np.array([n for x in lengths for n in x]),
                  found.digests, found.offsets, found.blob, verdicts]
        raw = [np.ascontiguousarray(a, dtype=f"<{t}").tobytes() for a, t in zip(arrays, cls.TYPES)]
        sizes = np.array([len(a) for a in arrays], "<i8").tobytes()
        return sizes + b"".join(r + b"\0" * (-len(r) % 8) for r in raw)

    @classmethod
    def unpack(cls, raw: np.ndarray) -> RuleFile:
        n, at, arrays = len(cls.TYPES), 8 * len(cls.TYPES), []
        for size, t in zip(raw[:8 * n].view("<i8"), cls.TYPES):
            width = int(size) * np.dtype(t).itemsize
            arrays.append(raw[at:at + width].view(f"<{t}"))
            at += width + -width % 8
        return cls(arrays)

    def suffixes(self, host: bytes) -> list[bytes]:
        """The host and the domains above it that are short enough to be a rule's."""
        out, at = [], len(host)
        for _ in range(self.labels):
            at = host.rfind(b".", 0, at)
            out.append(host[at + 1:])
            if at < 0:
                break
        return out

    def best(self, urls: Sequence[tuple[bytes, bytes]]) -> list[tuple[str, str] | None]:
        """(rule, verdict) of the longest rule that fits each (host, path)."""
        asked = {h: self.suffixes(h) for h in dict.fromkeys(h for h, _ in urls)}
        names = list(dict.fromkeys(s for x in asked.values() for s in x))
        listed = {s: i for s, i in zip(names, self.hosts.find(names)) if i >= 0}
        probes: dict[bytes, int] = {}
        fitting = []
        for host, path in urls:
            mine = []
            for s in asked[host]:
                if s in listed:
                    i = listed[s]
                    for n in self.lengths[self.length_offsets[i]:self.length_offsets[i + 1]]:
                        if n <= len(path):
                            key = s + b"\0" + path[:n]
                            mine.append((len(key), len(s), probes.setdefault(key, len(probes))))
            fitting.append(mine)
        keys = list(probes)
        at = self.rules.find(keys)
        out: list[tuple[str, str] | None] = []
        for mine in fitting:
            hit = max((m for m in mine if at[m[2]] >= 0), default=None)
            out.append(None if hit is None else (keys[hit[2]].replace(b"\0", b"", 1).decode(), VERDICTS[self.verdicts[at[hit[2]]]]))
        return out


_mapped: dict[str, RuleFile] = {}


def rule_file(name: str) -> RuleFile:
    """The list that ``addFile`` brought here, mapped once per Python worker."""
    if name not in _mapped:
        _mapped.clear()
        _mapped[name] = RuleFile.unpack(np.memmap(SparkFiles.get(name), np.uint8, "r"))
    return _mapped[name]


def _judge(name: str, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = rule_file(name)
        for b in batches:
            urls = [host_and_path(u) for u in b.column("url").to_pylist()]
            got = rules.best(urls)
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), pa.array([h.decode() for h, _ in urls], pa.string()), pa.array([p.decode() for _, p in urls], pa.string()),
                 pa.array([g and g[0] for g in got], pa.string()), pa.array([g[1] if g else default for g in got], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])
    return run


def _clean(rules: DataFrame) -> DataFrame:
    lower = F.translate("host", _UPPER.decode(), _UPPER.lower().decode())
    return rules.where("host IS NOT NULL").select(lower.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").distinct()


def judge(pages: DataFrame, rules: DataFrame, scratch: Scratch, default: str = "allow", list_bytes: int = LIST_BYTES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` under ``rules`` (host, path, verdict)."""
    rules = scratch.cut(_clean(rules))
    if wrong := rules.where(~F.col("verdict").isin(*VERDICTS) | F.col("verdict").isNull()).limit(3).collect():
        raise ValueError(f"a verdict is one of {VERDICTS}: {wrong}")
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 32)).first()[0] or 0
    if size > list_bytes:
        return judge_by_join(pages, rules, default)
    spark, name = pages.sparkSession, f"rules-{uuid.uuid4().hex}"
    scratch.write_bytes(name, RuleFile.pack([(r.host.encode(), r.path.encode(), r.verdict) for r in rules.collect()]))
    spark.sparkContext.addFile(f"{scratch.root}/{name}")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(_judge(name, default), OUT)


def judge_by_join(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The same rows from a shuffled join of distinct (host, path) with the list, for lists of any size."""
    rest = F.when(F.locate("://", "url") > 0, F.expr("substr(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(rest, F.lit("")).alias("rest"))
    host = F.regexp_extract("rest", "^[^/?#]*", 0)
    rows = rows.select("page_id", F.translate(host, _UPPER.decode(), _UPPER.lower().decode()).alias("host"),
                       F.regexp_extract(F.expr("substr(rest, length(regexp_extract(rest, '^[^/?#]*', 0)) + 1)"), "^[^?#]*", 0).alias("path"))
    asked = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    probe = asked.select("host", "path", F.explode(above).alias("rule_host"))
    listed = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    fits = probe.join(listed, "rule_host").where(F.expr("startswith(path, rule_path)"))
    text = F.concat("rule_host", "rule_path")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.octet_length(text), F.octet_length("rule_host"), "rule_verdict", text.alias("rule"))).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(read_table(spark, sf_dir, "pages", "page_id", "url"), rules, Scratch(spark, "urls"))


ORACLE = r"""
with rules(rule_host, rule_path, rule_verdict) as (values {rules}),
rests as (select page_id, url, row_number() over () as k,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
split as (select page_id, k, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') as path from rests),
fits as (select k, rule_host || rule_path as rule, rule_verdict,
    row_number() over (partition by k order by strlen(rule_host || rule_path) desc, strlen(rule_host) desc) as n
  from split join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
from split left join (select * from fits where n = 1) using (k)
""".replace("{rules}", ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES))
