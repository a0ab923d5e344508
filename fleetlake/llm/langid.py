"""Language by fusing evidence: text, declared markup language, address suffix, host.

Text: byte trigrams of the lower-cased text, hashed to ``BUCKETS``; a multinomial model per language is fitted on
at most ``EXAMPLES`` labelled documents of each language that documents name (smallest hash of doc_id). A text's mean log-likelihood counts as
``EVIDENCE`` trigrams at most, since neighbouring ones are not independent. Every row's text posterior is then
summed by host, by address suffix and by declared language over all rows; a row's prior is its host's share of
each language, smoothed towards its suffix's, which is smoothed towards the whole table's (``HOST``, ``SUFFIX``:
the weight of the upper level in rows); its own part is taken out first. The declaration counts by how often rows
that declare it were found in each language. The posterior is the normalised product.

For ``pages`` the text is the markup without tags, scripts, styles and comments; for ``documents`` the source
stands for the host and there is no suffix or declaration.

Defined cases: a null or empty text has no likelihood, so priors decide; no address, suffix or declaration: that
evidence is the upper level's; equal posteriors go to the first language by name; repeated rows are judged alike;
an empty table gives an empty table; without labelled documents every language is null; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlake.llm.common import Scratch, arrow_slices, read_table, utf8

BUCKETS = 1 << 15
EXAMPLES = 1000
AT_ONCE = 8  # languages whose likelihoods are summed in one go
EVIDENCE = 100.0
HOST, SUFFIX, DECLARED = 5.0, 20.0, 5.0
_drop = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_declared = re.compile(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})")
_host = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def visible(markup: str | None) -> str:
    return html.unescape(_drop.sub(" ", markup or ""))


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every trigram, start of each text's) of lower-cased texts."""
    raw, off = utf8(pc.utf8_lower(texts))
    x = raw.astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    g = ((x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761)) >> np.uint32(17)
    inside = np.ones(len(g), bool)  # no trigram reaches over a text's end
    for back in (1, 2):
        at = off[1:-1] - back
        inside[at[(at >= 0) & (at < len(g))]] = False
    return (g & np.uint32(BUCKETS - 1))[inside].astype(np.int64), np.concatenate([[0], np.cumsum(inside)])[np.minimum(off, len(g))]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for b in arrow_slices(batches):
        g, start = trigrams(b.column("text"))
        for lang, lo, hi in zip(b.column("lang").to_pylist(), start[:-1], start[1:]):
            c = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            c += np.bincount(g[lo:hi], minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([c.tobytes() for c in total.values()], pa.binary())], ["lang", "counts"])


def fit(docs: DataFrame, scratch: Scratch) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities (buckets, languages) from a bounded sample of labelled documents."""
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    # ids only; Spark keeps the first EXAMPLES of each language before the shuffle too
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = known.select("doc_id", "lang").withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= EXAMPLES)
    picked = scratch.cut(picked.select("doc_id", "lang").distinct())  # its written size lets Spark choose the join
    part = known.select("doc_id", "text", "lang").join(picked, ["doc_id", "lang"], "left_semi").repartition("lang")
    total = {r.lang: np.frombuffer(r.counts, np.int64)
             for r in part.select("text", "lang").mapInArrow(_counts, "lang string, counts binary").collect()}  # a row a language
    names = sorted(total)
    c = np.array([total[n] for n in names], np.float64).reshape(len(names), BUCKETS) + 0.5
    return names, np.log(c / c.sum(1, keepdims=True)).T.copy()


def _likelihoods(model, markup: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, logp = model.value
        for b in arrow_slices(batches, "body"):
            body, declared = b.column("body"), [None] * b.num_rows
            hosts = b.column("host").to_pylist()
            if markup:
                raw = body.to_pylist()
                found = [_declared.search(x or "") for x in raw]
                declared = [m.group(1).lower() if m else None for m in found]
                body = pa.array([visible(x) for x in raw], pa.string())
                found = [_host.match(x or "") for x in hosts]
                hosts = [m.group(1).lower() if m else None for m in found]
            g, start = trigrams(body)
            n = np.diff(start)
            ll = np.empty((len(n), logp.shape[1]))
            for k in range(0, logp.shape[1], AT_ONCE):
                part = logp[:, k:k + AT_ONCE]
                run_ = np.concatenate([np.zeros((1, part.shape[1])), np.cumsum(part[g], axis=0)])
                ll[:, k:k + AT_ONCE] = run_[start[1:]] - run_[start[:-1]]
            ll *= (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
            ll -= ll.max(1, keepdims=True)
            p = np.exp(ll)
            p /= p.sum(1, keepdims=True)
            suffix = [h.rsplit(".", 1)[-1] if markup and h and "." in h else None for h in hosts]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(hosts, pa.string()), pa.array(suffix, pa.string()), pa.array(declared, pa.string()),
                 pa.array(list(ll), pa.list_(pa.float64())), pa.array(list(p), pa.list_(pa.float64()))],
                ["id", "host", "suffix", "declared", "ll", "p"])
    return run


def identify(rows: DataFrame, model, names: list[str], scratch: Scratch, markup: bool) -> DataFrame:
    """id, lang, posterior and the evidence, for rows of (id, body, host)."""
    n = len(names)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers a language
    kind = "id long, host string, suffix string, declared string, ll array<double>, p array<double>"
    scored = scratch.cut(rows.mapInArrow(_likelihoods(shared, markup), kind))
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(n)]

    def table(by: str, name: str) -> DataFrame:
        """Posterior sums per value of ``by``; its written size lets Spark choose the join."""
        return scratch.cut(scored.where(F.col(by).isNotNull()).groupBy(by).agg(*sums).select(
            by, F.array(*(F.col(f"s{i}") for i in range(n))).alias(name)))

    whole = scored.agg(*sums).first()  # one number per language
    out = scored.withColumn("all", F.array(*(F.lit(float(x or 0.0)) for x in whole)))
    for by in ("host", "suffix", "declared"):
        out = out.join(table(by, f"by_{by}"), by, "left")

    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)

    def smooth(counts: str, upper: str, weight: float):
        own = F.zip_with(counts, "p", lambda c, p: F.greatest(c - p, F.lit(0.0)))
        blend = F.zip_with(own, upper, lambda c, u: (c + weight * u) / (total(own) + weight))
        return F.when(F.col(counts).isNull(), F.col(upper)).otherwise(blend)

    out = out.withColumn("base", F.transform("all", lambda x: (x + 1.0) / (total(F.col("all")) + n)))
    out = out.withColumn("suffix_prior", smooth("by_suffix", "base", SUFFIX))
    out = out.withColumn("host_prior", smooth("by_host", "suffix_prior", HOST))
    # how much likelier a declaration is in a language than the language itself
    out = out.withColumn("declared_share", smooth("by_declared", "base", DECLARED))
    out = out.withColumn("lp", F.zip_with(F.zip_with("ll", "host_prior", lambda a, b: a + F.log(b)),
                                          F.zip_with("declared_share", "base", lambda a, b: F.log(a / b)), lambda a, b: a + b))
    out = out.withColumn("w", F.transform("lp", lambda x: F.exp(x - F.array_max("lp"))))
    at = F.array_position("w", F.array_max("w"))
    return out.select("id", F.element_at(F.array(*map(F.lit, names)), at.cast("int")).alias("lang"),
                      (F.array_max("w") / total(F.col("w"))).alias("posterior"),
                      F.element_at(F.array(*map(F.lit, names)), F.array_position("p", F.array_max("p")).cast("int")).alias("text_lang"),
                      "host", "suffix", "declared")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents (``doc_id``) and all pages (``page_id``)."""
    scratch = Scratch(spark, "language")
    docs = read_table(spark, sf_dir, "documents")
    pages = read_table(spark, sf_dir, "pages")
    names, logp = fit(docs, scratch)
    if not names:
        names, logp = ["und"], np.zeros((BUCKETS, 1))
    parts = [(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("body"), F.col("source").alias("host")), False),
             (pages.select(F.col("page_id").cast("long").alias("id"), F.col("html").alias("body"), F.col("url").alias("host")), True)]
    out = None
    for rows, markup in parts:
        got = identify(rows, (names, logp), names, scratch, markup)
        none = F.lit(None).cast("long")
        got = got.select((none if markup else F.col("id")).alias("doc_id"), (F.col("id") if markup else none).alias("page_id"), "*").drop("id")
        out = got if out is None else out.unionByName(got)
    return out
