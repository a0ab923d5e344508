"""Drift detection from run to run: each run reads only dates that are new or changed.

A rolling statistic needs the ``window`` rows before a row and nothing older. Every run stores, per series, the last
``window`` rows up to its last date (``tails/upto=<date>``); the next run puts these before the new dates' rows
as history. Alerts lie in a folder per event date. After late data on an old date, a run from that date on takes
the newest tail before it and replaces the alerts of that date and all later ones, so that any order of runs
leaves the alerts that one run over everything would give.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.operators import drift
from fleetlake.schemas import DRIFT_ALERT
from fleetlake.session import cut
from fleetlake.sources import files
from fleetlake.sources.alerts import to_alert_records

SERIES = ("device_id", "qubit_id", "metric")
ORDER = ("timestamp", "event_id")


def _dates_in(spark: SparkSession, where: str, column: str) -> list[dt.date]:
    return [dt.date.fromisoformat(f.split("=", 1)[1]) for f in files.folders(spark, where) if f.startswith(f"{column}=")]


def run(spark: SparkSession, fct: DataFrame, state: str, since: dt.date | None = None, window: int = drift.DEFAULT_WINDOW,
        threshold: float = drift.DEFAULT_THRESHOLD, min_history: int = drift.DEFAULT_MIN_HISTORY,
        metrics: tuple[str, ...] = drift.DEFAULT_METRICS, block_rows: int = drift.BLOCK_ROWS) -> None:
    """Bring the alerts under ``state`` up to date with the dates of ``fct`` from ``since`` on.

    Without ``since``: the dates after the last run's. The parameters are to stay the same from run to run.
    """
    tails, alerts = os.path.join(state, "tails"), os.path.join(state, "alerts")
    before = [d for d in _dates_in(spark, tails, "upto") if since is None or d < since]
    last = max(before, default=None)
    fresh = fct if last is None else fct.where(F.col("event_date") > F.lit(last))
    long = drift.unpivoted(fresh.select("device_id", "qubit_id", *ORDER, "event_date", *metrics),
                           ["device_id", "qubit_id", *ORDER, "event_date"], metrics).withColumn("_own", F.lit(True))
    if last is not None:
        history = spark.read.parquet(os.path.join(tails, f"upto={last.isoformat()}")).withColumn("_own", F.lit(False))
        long = long.unionByName(history)
    long = cut(long, "drift")
    scored = drift.zscores(long, SERIES, ORDER, window, min_history, block_rows)
    found = scored.where(F.col("_own") & (F.abs("zscore") >= threshold))
    records = to_alert_records(found).withColumn("event_date", F.to_date(F.substring("timestamp", 1, 10)))
    stale = [d for d in _dates_in(spark, alerts, "event_date") if last is None or d > last]
    written = cut(records, "alerts")
    for d in stale:
        files.remove(spark, os.path.join(alerts, f"event_date={d.isoformat()}"))
    written.hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").json(alerts)
    upto = long.where("_own").agg(F.max("event_date")).first()[0]
    if upto is None:
        return
    newest = Window.partitionBy(*SERIES).orderBy(*[F.col(c).desc() for c in ORDER])
    # Spark limits each group before the shuffle, so a long series sends ``window`` rows a task
    tail = long.drop("_own").withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= window).drop("_n")
    for d in _dates_in(spark, tails, "upto"):
        if last is None or d > last:
            files.remove(spark, os.path.join(tails, f"upto={d.isoformat()}"))
    tail.write.mode("overwrite").parquet(os.path.join(tails, f"upto={upto.isoformat()}"))


def read(spark: SparkSession, state: str) -> DataFrame:
    """The alerts of all runs; none if there was no run, or none found any."""
    path = os.path.join(state, "alerts")
    if not _dates_in(spark, path, "event_date"):
        return spark.createDataFrame([], DRIFT_ALERT)
    return spark.read.schema(DRIFT_ALERT).json(path).select(*DRIFT_ALERT.fieldNames())
