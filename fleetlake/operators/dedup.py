"""Latest row per key (D1) and latest group per entity (D3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``order_by`` tuple (all descending).

    Equivalent to ``row_number() over (partition by key order by o1 desc, o2 desc, ...) = 1``
    with NULLS LAST, but written as a grouped ``max`` over a struct whose leading
    fields are the ordering columns. As an aggregation it always combines
    map-side: each task reduces its share of a key to one row before the shuffle,
    so a key holding a third of all rows (replays) costs one row per task in the
    exchange. (Spark 3.5+ plans the ``row_number`` form with a partial
    WindowGroupLimit too -- measured equal here -- but only under its optimizer
    thresholds.) Remaining columns act as a final, deterministic tie-break when
    every ordering column is equal.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_w")
    out = df.groupBy(*keys).agg(F.max(packed).alias("_w"))
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_w.{c}").alias(c) for c in order + rest]) \
        .select(*df.columns)


def latest_group_per_entity(df: DataFrame, entity: str, order_col: str) -> DataFrame:
    """Rows of the latest ``order_col`` value per ``entity`` (D3: latest day per device).

    The input is already aggregated to one row per (entity, order_col), so the
    window holds one row per group day -- small and bounded by the calendar.
    """
    w = Window.partitionBy(entity).orderBy(F.col(order_col).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
