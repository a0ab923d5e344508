"""Written tables that are replaced as a whole or by date.

A table's folder holds one folder per version and a small file, ``_current``, that names the one readers use. A
build writes a new version beside the old one and then replaces that file in one step, so readers see the old
table or the new one, and a build that fails leaves the old table as it was. Replaced versions stay until
``KEEP`` newer ones exist, for readers that still hold them.

Tables with an ``event_date`` have a folder per date. ``replace_dates`` rewrites only some of these within the
version in use (dynamic partition overwrite) and leaves the files of all other dates untouched.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import scratch_path
from fleetlake.sources import files

LAYER_OF = {"stg": "silver", "fct": "gold", "dim": "gold", "device": "gold"}
KEEP = 2
DATE = "event_date"


class TableMissing(RuntimeError):
    pass


def table_path(root: str, name: str) -> str:
    return os.path.join(root, LAYER_OF.get(name.split("_")[0], "gold"), name)


def current_path(spark: SparkSession, root: str, name: str) -> str:
    """Folder of the version in use."""
    version = files.read_text(spark, os.path.join(table_path(root, name), "_current"))
    if version is None:
        raise TableMissing(f"no table {name!r} under {root}; build the pipeline first")
    return os.path.join(table_path(root, name), version)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, root, name))


def _laid_out(df: DataFrame) -> DataFrame:
    """Few, large files per date: the hint clusters by date and AQE splits a date that is large."""
    return df.hint("rebalance", DATE) if DATE in df.columns else df


def write_version(spark: SparkSession, df: DataFrame, root: str, name: str, observed=None) -> str:
    """Write ``df`` as a version that nobody reads yet; returns its name. ``observed`` may add metrics to the write.

    The metrics are taken behind the last shuffle, in the tasks that write: Spark counts each of those once.
    """
    versions = [v for v in files.folders(spark, table_path(root, name)) if v.startswith("v")]
    number = 1 + max((int(v[1:].split("-")[0]) for v in versions), default=0)
    version = f"v{number:06d}-{uuid.uuid4().hex[:8]}"
    path = os.path.join(table_path(root, name), version)
    out = _laid_out(df)
    columns = out.columns
    if observed is not None:
        out = observed(out)
    writer = out.write.partitionBy(DATE) if DATE in columns else out.write
    try:
        writer.parquet(path)
    except BaseException:
        files.remove(spark, path)
        raise
    return version


def publish(spark: SparkSession, root: str, name: str, version: str, keep: int = KEEP) -> None:
    """Make ``version`` the one readers use, then remove versions older than the newest ``keep``."""
    folder = table_path(root, name)
    files.write_text(spark, os.path.join(folder, "_current"), version)
    old = [v for v in files.folders(spark, folder) if v.startswith("v") and v <= version]
    for v in old[:-keep]:
        files.remove(spark, os.path.join(folder, v))


def replace(spark: SparkSession, df: DataFrame, root: str, name: str, observed=None) -> DataFrame:
    """``create or replace table``: the new table as read back."""
    publish(spark, root, name, write_version(spark, df, root, name, observed))
    out = read_table(spark, root, name)
    return out.select(*[c for c in df.columns if c in out.columns])  # partition columns back in their place


def replace_dates(spark: SparkSession, df: DataFrame, root: str, name: str, dates: Sequence[dt.date]) -> DataFrame:
    """Let ``df`` be all rows of ``dates``; the files of other dates are not touched.

    ``df`` may read the table itself: it is written aside first. A date without rows loses its folder. A step that
    fails can be repeated as it is.
    """
    path = current_path(spark, root, name)
    aside = scratch_path(spark, f"dates-{uuid.uuid4().hex}")
    df.write.parquet(aside)
    fresh = spark.read.schema(df.schema).parquet(aside)
    (_laid_out(fresh).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(path))
    left = {r[0] for r in fresh.select(DATE).distinct().collect()}  # dates, bounded by the calendar
    for date in set(dates) - left:
        files.remove(spark, os.path.join(path, f"{DATE}={date.isoformat()}"))
    files.remove(spark, aside)
    return read_table(spark, root, name)


def of_dates(df: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    """Rows of these dates (a literal list, so that folders are pruned)."""
    return df.where(F.col(DATE).isin([F.lit(d) for d in dates]) if dates else F.lit(False))
