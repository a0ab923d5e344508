"""Join operators: dimension join (E1), chained left joins at a
shared grain (E2), and lateral number expansion (E3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join a fact to a dimension. Spark broadcasts it while its bytes are known to be
    under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond, splitting hot
    keys at run time; no hint overrides that bound and no job runs to measure it."""
    return fact.join(dim, on=on, how=how)


def left_join_all(driver: DataFrame, others: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """``driver left join o1 using (on) left join o2 using (on) ...``.

    All inputs are pre-aggregated to the same grain, so every side is one row per
    key; rows of the other sides without a driver row disappear (driver-led).
    """
    out = driver
    for o in others:
        out = out.join(o, on=list(on), how="left")
    return out


def expand_range(df: DataFrame, count_col: str, out_col: str) -> DataFrame:
    """One row per ``0 .. n-1`` for each input row (``cross join range(n)``).

    A non-positive or null ``n`` yields no rows (``sequence(0, -1)`` would give
    ``[0, -1]``, so it is guarded).
    """
    n = F.col(count_col)
    seq = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return df.select("*", F.explode(seq).alias(out_col))
