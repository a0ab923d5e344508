"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

Every document gets a repetition rate: its group's target weight, times the wanted total, over the group's
own bytes. A uniform number hashed from (seed, doc_id) is put through the inverse Poisson distribution with
that mean, the document is exploded by the count, and the copies are dealt over all partitions by a hash of
(seed, doc_id, copy) and sorted by it.

Defined cases: a null group is a group of its own; a null or empty text counts one byte, so its group keeps
a finite rate; rows that repeat a doc_id draw the same count; an empty table gives an empty table; columns of
the input that clash with an added one are replaced by it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch, read_table, row_ids, unused_name

SEED = "mix-1"
ADDED = ("copy_no", "n_copies", "rate", "shuffle_key")


def uniform(*parts: Column) -> Column:
    """A double in [0, 1) from the first 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_quantile(u: Column, rate: Column) -> Column:
    """Smallest n with u < P(N <= n), N Poisson with mean ``rate``. Means above 700 (exp(-mean) has no full double
    there) start 12 deviations under the mean, where P(N = n) comes from Stirling's series; what lies below is
    under 1e-30."""
    large, wide = rate > 700, 12 * F.sqrt(rate) + 30
    low = F.when(large, F.floor(rate - wide)).otherwise(F.lit(0)).cast("int")
    steps = F.sequence(low + 1, (rate + wide).cast("int"))
    x = F.greatest(low, F.lit(1)).cast("double")
    far = x * F.log1p((F.greatest(rate, x) - x) / x) - (rate - x) - 0.5 * F.log(2 * math.pi * x) - 1 / (12 * x) + 1 / (360 * x * x * x)
    none = F.when(large, F.exp(far)).otherwise(F.exp(-rate))
    start = F.struct(none.alias("p"), none.alias("c"), low.alias("n"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.when(acc["c"] <= u, F.struct(p.alias("p"), (acc["c"] + p).alias("c"), k.alias("n"))).otherwise(acc)

    return F.aggregate(steps, start, step, lambda acc: acc["n"])


def mix(docs: DataFrame, scratch: Scratch, by: str = "source", weights: dict | None = None, alpha: float = 0.5,
        epochs: float = 1.0, seed: str = SEED, row: str = "doc_id") -> DataFrame:
    """Replicate ``docs`` so that each ``by`` group's expected bytes have its share of the total.

    ``weights``: share per group value (a group it doesn't name gets none); default: the group's bytes to the
    power ``alpha``. The expected total is ``epochs`` times the input's bytes. Rows of one ``row`` draw the same count.
    """
    size = F.greatest(F.octet_length(F.coalesce(F.col("text"), F.lit(""))), F.lit(1)).cast("long")
    groups = docs.groupBy(F.col(by).alias("_by")).agg(F.sum(size).alias("_bytes"))
    if weights is None:
        share = F.sqrt("_bytes") if alpha == 0.5 else F.pow(F.col("_bytes").cast("double"), F.lit(float(alpha)))
    else:
        share = F.lit(0.0)
        for k, v in weights.items():
            share = F.when(F.col("_by").eqNullSafe(F.lit(k)), F.lit(float(v))).otherwise(share)
    # one row per group; its written size lets Spark choose the join below
    groups = scratch.cut(groups.withColumn("_share", share))
    total = groups.agg(F.sum("_share").alias("share"), F.sum("_bytes").alias("bytes")).first()
    rates = groups.select("_by", F.coalesce(F.try_divide(
        F.col("_share") * F.lit(float(epochs)) * F.lit(total.bytes or 0),
        F.lit(float(total.share or 0)) * F.col("_bytes")), F.lit(0.0)).alias("_rate"))
    body = docs.drop(*ADDED)
    own, rate = unused_name("by", body.columns), unused_name("rate_of_by", body.columns)
    rates = rates.select(F.col("_by").alias(own), F.col("_rate").alias(rate))
    key = F.coalesce(F.col(row).cast("string"), F.lit("null"))
    n = body.join(rates, body[by].eqNullSafe(rates[own]), "left").drop(own)
    n = n.withColumn("n_copies", poisson_quantile(uniform(F.lit(seed), key), F.col(rate)))
    copies = (n.where("n_copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
              .withColumn("rate", F.round(rate, 9)).drop(rate)
              .withColumn("shuffle_key", F.conv(F.substring(F.md5(F.concat_ws(
                  ":", F.lit(seed), key, F.col("copy_no").cast("string"))), 1, 15), 16, 10).cast("long")))
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed by source with square-root weights to one epoch."""
    return mix(read_table(spark, sf_dir, "documents"), Scratch(spark, "mix"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row draws a count of its own, also one that shares its doc_id or has none."""
    scratch = Scratch(spark, "mix")
    rows, key = row_ids(docs, scratch)
    return mix(rows, scratch, row=key).select(*docs.columns)


ORACLE = """
WITH g AS (SELECT source, sum(greatest(strlen(coalesce(text, '')), 1))::BIGINT AS b FROM documents GROUP BY source),
t AS (SELECT sum(sqrt(b)) AS s, sum(b) AS b FROM g),
r AS (SELECT g.source, sqrt(g.b) * 1.0 * t.b / (t.s * g.b) AS rate FROM g, t),
pois AS (
  WITH RECURSIVE p(source, rate, k, p, c) AS (
    SELECT source, rate, 0, exp(-rate), exp(-rate) FROM r
    UNION ALL SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM p WHERE k < rate + 12 * sqrt(rate) + 29)
  SELECT * FROM p),
u AS (SELECT *, coalesce(doc_id::VARCHAR, 'null') AS id,
        ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents),
n AS (SELECT u.doc_id, u.id, any_value(u.text) AS text, any_value(u.lang) AS lang, any_value(u.source) AS source,
        any_value(u.n_chars) AS n_chars, any_value(pois.rate) AS rate, count(*) FILTER (pois.c <= u.u)::INTEGER AS n_copies
      FROM u JOIN pois ON u.source IS NOT DISTINCT FROM pois.source GROUP BY u.doc_id, u.id),
e AS (SELECT n.*, unnest(range(1, n_copies + 1))::INTEGER AS copy_no FROM n WHERE n_copies > 0)
SELECT doc_id, text, lang, source, n_chars, n_copies, copy_no, round(rate, 9) AS rate,
  ('0x' || substr(md5('mix-1:' || id || ':' || copy_no), 1, 15))::BIGINT AS shuffle_key FROM e
"""
