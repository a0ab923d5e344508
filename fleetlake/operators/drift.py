"""Rolling z-score drift detection.

For each series (``group_cols`` + metric) ordered by ``order_cols``, compare each
value with the mean and sample standard deviation of the *previous* ``window``
values (the current row excluded). Statistics need at least ``min_history``
non-null values; a zero deviation gives no z-score. Rows with
``abs(z) >= threshold`` are alerts.

All metrics are unpivoted first, so one shuffle and one sort serve every metric
(the metric is part of the window partition), instead of one pass per metric
followed by a union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.session import checkpoint_dir

# Detector defaults.
DEFAULT_METRICS = ("gate_error_1q", "gate_error_2q")
DEFAULT_WINDOW = 30
DEFAULT_THRESHOLD = 2.5
DEFAULT_MIN_HISTORY = 5

# Rows of a series that one window task takes; a longer series is several blocks.
BLOCK_ROWS = 2_000_000


def _series_positions(long: DataFrame, series: Sequence[str], order_cols: Sequence[str],
                      partitions: int | None = None) -> DataFrame:
    """Exact 0-based position of every row within its series, without a per-series task.

    Range partitioning on (series, order) splits even a very long series over
    many partitions; within a partition rows are sorted, so a row's position is
    the count of its series' rows in earlier partitions plus its rank inside the
    partition. Those counts come from a small (partition, series) aggregate.
    """
    keys = [*series, *order_cols]
    # without a given number AQE sizes the partitions by bytes
    dealt = long.repartitionByRange(*keys) if partitions is None else long.repartitionByRange(partitions, *keys)
    ranged = (dealt.sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_id", F.monotonically_increasing_id()))
    # Written once to the shared checkpoint folder: partition ids and row ids must
    # be the same for the offset aggregate and the rows, and must survive a lost
    # executor (a recomputation could sample different range bounds).
    checkpoint_dir(long.sparkSession)
    ranged = ranged.checkpoint(eager=True)
    seg = ranged.groupBy("_pid", *series).agg(F.min("_id").alias("_id0"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*series).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # one row per (range partition, series): bounded by partitions + series
    seg = seg.select("_pid", *series, "_id0", "_off")
    return (ranged.join(seg, ["_pid", *series])
            .withColumn("_pos", F.col("_off") + F.col("_id") - F.col("_id0"))
            .drop("_pid", "_id", "_id0", "_off"))


def _stats_columns(w, window_col: str = "value", min_history: int = DEFAULT_MIN_HISTORY):
    """Mean and sample standard deviation over the frame ``w``, null below ``min_history`` values."""
    n = F.count(window_col).over(w)
    enough = n >= min_history
    return F.when(enough, F.avg(window_col).over(w)), F.when(enough, F.stddev_samp(window_col).over(w))


def rolling_zscores(df: DataFrame, group_cols: Sequence[str] = ("device_id", "qubit_id"),
                    order_cols: Sequence[str] = ("timestamp", "event_id"),
                    metrics: Sequence[str] = DEFAULT_METRICS, window: int = DEFAULT_WINDOW,
                    min_history: int = DEFAULT_MIN_HISTORY, carry: Sequence[str] = (),
                    block_rows: int | None = None, partitions: int | None = None) -> DataFrame:
    """Every row with its rolling statistics, one row per (input row, metric).

    ``block_rows=None``: one window per series (one shuffle; a series is one task).
    ``block_rows=B``: the series is cut into blocks of ``B`` consecutive rows; each
    block also receives the last ``window`` rows of the previous block as read-only
    history, so every frame is complete and results are identical, while no task
    holds more than ``B + window`` rows of a series however long it is.
    """
    ids = list(dict.fromkeys([*group_cols, *order_cols, *carry]))
    long = unpivoted(df.select(*ids, *metrics), ids, metrics)
    return zscores(long, [*group_cols, "metric"], order_cols, window, min_history, block_rows, partitions)


def unpivoted(df: DataFrame, ids: Sequence[str], metrics: Sequence[str] = DEFAULT_METRICS) -> DataFrame:
    """One row per (input row, metric) with the columns ``metric`` and ``value``."""
    return df.unpivot(list(ids), list(metrics), "metric", "value")


def zscores(long: DataFrame, series: Sequence[str], order_cols: Sequence[str], window: int = DEFAULT_WINDOW,
            min_history: int = DEFAULT_MIN_HISTORY, block_rows: int | None = None,
            partitions: int | None = None) -> DataFrame:
    """Rows with a ``value`` each, with the rolling statistics of their series (see ``rolling_zscores``)."""
    columns = long.columns
    if block_rows is not None:
        if block_rows <= window:
            raise ValueError("block_rows must exceed the window")
        pos = _series_positions(long, series, order_cols, partitions)
        own = F.floor(F.col("_pos") / block_rows)
        tail = (F.col("_pos") % block_rows) >= block_rows - window
        blocked = pos.select("*", own.alias("_in"),
                             F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))).alias("_blk"))
        w = Window.partitionBy(*series, "_blk").orderBy("_pos").rowsBetween(-window, -1)
        mean, sd = _stats_columns(w, "value", min_history)
        stats = (blocked.select(*columns, "_blk", "_in", mean.alias("rolling_mean"), sd.alias("rolling_stddev"))
                 .where(F.col("_blk") == F.col("_in")).drop("_blk", "_in"))
    else:
        w = (Window.partitionBy(*series).orderBy(*[F.col(c).asc() for c in order_cols])
             .rowsBetween(-window, -1))
        mean, sd = _stats_columns(w, "value", min_history)
        stats = long.select(*columns, mean.alias("rolling_mean"), sd.alias("rolling_stddev"))
    z = (F.col("value") - F.col("rolling_mean")) / F.nullif(F.col("rolling_stddev"), F.lit(0.0))
    return stats.withColumn("zscore", z)


def drift_alerts(df: DataFrame, group_cols: Sequence[str] = ("device_id", "qubit_id"),
                 order_cols: Sequence[str] = ("timestamp", "event_id"),
                 metrics: Sequence[str] = DEFAULT_METRICS, window: int = DEFAULT_WINDOW,
                 threshold: float = DEFAULT_THRESHOLD, min_history: int = DEFAULT_MIN_HISTORY,
                 carry: Sequence[str] = (), block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Alert rows: device, qubit, timestamp, metric, value, rolling mean/stddev, z-score.

    The blocked plan runs at every size: no task holds more than ``block_rows`` rows
    of a series (see ``rolling_zscores``).
    """
    z = rolling_zscores(df, group_cols, order_cols, metrics, window, min_history, carry, block_rows)
    alerts = z.where(F.abs(F.col("zscore")) >= threshold)
    # The series' time column is reported; further ordering columns only break ties.
    shown = [*group_cols, order_cols[0], *[c for c in carry if c not in group_cols and c != order_cols[0]]]
    return alerts.select(*shown, "metric", "value", "rolling_mean", "rolling_stddev", "zscore")


def alert_order(metrics: Sequence[str] = DEFAULT_METRICS,
                order: Sequence[str] = ("device_id", "qubit_id", "timestamp")) -> list[Column]:
    """Alerts of metric 1 then metric 2 ..., each by device, qubit, time."""
    return [F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col("metric")), *[F.col(c) for c in order]]


def presentation_order(alerts: DataFrame, metrics: Sequence[str] = DEFAULT_METRICS,
                       order: Sequence[str] = ("device_id", "qubit_id", "timestamp")) -> DataFrame:
    """Alerts in ``alert_order`` (a global sort)."""
    return alerts.orderBy(*alert_order(metrics, order))
