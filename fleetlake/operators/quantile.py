"""Exact continuous quantiles without one task per group (F5 at scale).

Spark's ``percentile`` is exact, but its final merge holds every distinct value
of a group in one task; a device-day holding a third of all rows would not fit.
``exact_quantiles`` computes the same numbers as a sequence of bounded steps:

1. count rows per (group, value) -- partial aggregation, shuffled by (group, value);
2. range-partition those (group, value, count) rows, so a group with very many
   distinct values spans many partitions, and write them once (``checkpoint``)
   so partition ids stay fixed for the next steps and across executor loss;
3. running counts inside each (partition, group) plus per-partition offsets of
   every group (a small table) give each distinct value its rank interval;
4. keep the (at most two per quantile) values whose interval contains the
   floor/ceil rank of ``q * (n - 1)`` and interpolate linearly -- the formula of
   ``percentile``, so both strategies agree exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.session import checkpoint_dir


def _rank_intervals(counts: DataFrame, group_cols: Sequence[str], value_col: str,
                    partitions: int | None = None) -> DataFrame:
    keys = [*group_cols, value_col]
    # without a given number AQE sizes the partitions by bytes
    dealt = counts.repartitionByRange(*keys) if partitions is None else counts.repartitionByRange(partitions, *keys)
    ranged = dealt.withColumn("_pid", F.spark_partition_id())
    checkpoint_dir(counts.sparkSession)
    ranged = ranged.checkpoint(eager=True)
    inside = Window.partitionBy("_pid", *group_cols).orderBy(value_col) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = ranged.withColumn("_cum", F.sum("_c").over(inside))
    seg = ranged.groupBy("_pid", *group_cols).agg(F.sum("_c").alias("_pn"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select("_pid", *group_cols,
                     F.coalesce(F.sum("_pn").over(before), F.lit(0)).alias("_off"),
                     F.sum("_pn").over(Window.partitionBy(*group_cols)).alias("_n"))
    # one row per (range partition, group): bounded by partitions + groups
    end = F.col("_off") + F.col("_cum")
    return rows.join(seg, ["_pid", *group_cols]).select(
        *group_cols, value_col, (end - F.col("_c")).alias("_start"), end.alias("_end"), "_n")


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    quantiles: Mapping[str, float], partitions: int | None = None) -> DataFrame:
    """One row per group with one column per named quantile of ``value_col`` (nulls ignored)."""
    counts = (df.where(F.col(value_col).isNotNull())
              .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_c")))
    iv = _rank_intervals(counts, group_cols, value_col, partitions)

    def pos(q: float) -> Column:
        return (F.col("_n") - 1) * F.lit(q)

    def covers(rank: Column) -> Column:
        return (F.col("_start") <= rank) & (rank < F.col("_end"))

    hit = F.lit(False)
    for q in quantiles.values():
        hit = hit | covers(F.floor(pos(q))) | covers(F.ceil(pos(q)))
    picked = iv.where(hit)
    aggs = []
    for name, q in quantiles.items():
        lo, hi = F.floor(pos(q)), F.ceil(pos(q))
        aggs += [F.max(F.when(covers(lo), F.col(value_col))).alias(f"_lo_{name}"),
                 F.max(F.when(covers(hi), F.col(value_col))).alias(f"_hi_{name}"),
                 F.max(pos(q)).alias(f"_h_{name}")]
    g = picked.groupBy(*group_cols).agg(*aggs)
    out = []
    for name in quantiles:
        h, lo_v, hi_v = F.col(f"_h_{name}"), F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        lo_r, hi_r = F.floor(h), F.ceil(h)
        out.append(F.when((lo_r == hi_r) | (lo_v == hi_v), lo_v)
                   .otherwise((hi_r - h) * lo_v + (h - lo_r) * hi_v).alias(name))
    return g.select(*group_cols, *out)
