"""Global positions in a sort order, as a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.session import cut


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with each row's 1-based place in the order, without a window over all rows.

    Rows are range-partitioned and sorted by ``order``; a row's place is its place within its partition plus the
    rows of the partitions before it, which a table of one row per partition gives. The frame is written once, so
    that partitions and places are the same for both. Rows that are equal in ``order`` get places of their own
    in no particular order; name enough columns to tell rows apart.
    """
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("_pid", F.spark_partition_id())
                 # the row's number within its partition: ids start at partition << 33
                 .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ranked")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return ranged.join(offsets, "_pid").select(*df.columns, (F.col("_off") + F.col("_at") + 1).cast("long").alias(name))
