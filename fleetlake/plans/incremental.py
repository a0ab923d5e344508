"""Late data: bring silver, fact and mart up to date from new bronze rows only.

A row that arrives late may be the latest of its key, on the same event date as the row it replaces or on another
one, and it may be older than what is there. An index beside each silver table says for every key on which date its
row lies, with the columns that order rows of a key. From new rows, filtered and reduced as in a full build:

1. the index gives the date and order of each new row's key; rows older than what is there go;
2. the dates that change are those of the remaining rows and those that their keys' old rows lie on;
3. these dates alone are read, the keys concerned are decided anew, and their folders are rewritten;
4. the index gets the new places appended (its latest entry of a key counts).

Silver is written before the index, and each step gives the same when it is repeated, so a run that fails may simply
be started again. The fact is a function of silver rows, so its folders of the same dates are rewritten; mart rows
of these dates are computed anew and put in place of the old ones. The fact's daily rows, with their percentiles, are
kept as a small table of their own: late rows of other streams don't change them. The result equals a full rebuild.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.operators import aggregates as agg
from fleetlake.operators.dedup import latest_per_key
from fleetlake.plans import gold, silver
from fleetlake.schemas import STREAMS
from fleetlake.session import cut
from fleetlake.sources import bronze, files, tables
from fleetlake.sources.tables import DATE


def index_path(root: str, stream: str) -> str:
    return os.path.join(root, "silver", f"_index_{stream}")


def _order(df: DataFrame, tie_break: Sequence[str]) -> list[str]:
    return ["timestamp", *[c for c in tie_break if c in df.columns]]


def build_silver(spark: SparkSession, root: str, stream: str, raw: DataFrame,
                 tie_break: Sequence[str] = silver.DEFAULT_TIE_BREAK, write: Callable = tables.replace) -> DataFrame:
    """Full build of a silver table (written by ``write``) together with its index."""
    rows = silver.SILVER[stream](raw, tie_break, keep_ties=True)
    ties = [c for c in tie_break if c in raw.columns]
    if ties:
        rows = cut(rows, "silver")
    name = f"stg_{stream}"
    out = write(spark, rows.drop(*ties), root, name)
    kept = rows if ties else out
    kept.select(STREAMS[stream].key, DATE, *_order(kept, tie_break)).write.mode("overwrite").parquet(index_path(root, stream))
    return out


def _places(spark: SparkSession, root: str, stream: str, keys: DataFrame, order: Sequence[str]) -> DataFrame:
    """Date (``_date``) and order columns (``_was``) of the row that silver holds for each of ``keys``."""
    key = STREAMS[stream].key
    index = spark.read.parquet(index_path(root, stream)).join(keys.select(key), key, "left_semi")
    latest = index.groupBy(key).agg(F.max(F.struct(*order, DATE)).alias("_p"))
    return latest.select(key, F.col(f"_p.{DATE}").alias("_date"), F.struct(*[F.col(f"_p.{c}").alias(c) for c in order]).alias("_was"))


def refresh_silver(spark: SparkSession, root: str, stream: str, fresh: DataFrame,
                   tie_break: Sequence[str] = silver.DEFAULT_TIE_BREAK) -> list[dt.date]:
    """Bring the silver table of ``stream`` up to date with ``fresh`` raw rows; the dates that changed."""
    key, name = STREAMS[stream].key, f"stg_{stream}"
    candidates = cut(silver.SILVER[stream](fresh, tie_break, keep_ties=True), "candidates")
    order = _order(candidates, tie_break)
    ties = order[1:]
    places = _places(spark, root, stream, candidates, order)
    newer = F.col("_was").isNull() | (F.struct(*order) >= F.col("_was"))
    moved = cut(candidates.join(places, key, "left").where(newer), "moved")
    dates = sorted({r[0] for r in moved.select(DATE).union(moved.select("_date")).distinct().collect()} - {None})
    if not dates:
        return []
    held = tables.of_dates(tables.read_table(spark, root, name), dates)
    columns = candidates.drop(*ties).columns
    untouched = held.select(*columns).join(moved.select(key), key, "left_anti")
    was = held.join(moved.where(F.col("_was").isNotNull()).select(key, *[F.col(f"_was.{c}").alias(c) for c in ties]), key)
    decided = cut(latest_per_key(was.select(*candidates.columns).unionByName(moved.select(*candidates.columns)), key, order), "decided")
    tables.replace_dates(spark, untouched.unionByName(decided.select(*columns)), root, name, dates)
    decided.select(key, DATE, *order).write.mode("append").parquet(index_path(root, stream))
    return dates


DAILY = "telemetry_daily"


def build_telemetry_daily(spark: SparkSession, root: str, fct: DataFrame) -> DataFrame:
    """The fact's daily rows as a table."""
    return tables.replace(spark, agg.telemetry_daily(fct), root, DAILY)


def _on(dates: Sequence[dt.date]):
    return F.col("date").isin([F.lit(d) for d in dates])


def _refresh_telemetry_daily(spark: SparkSession, root: str, dates: Sequence[dt.date], fact: bool) -> DataFrame:
    """The fact's daily rows of ``dates``: anew where the ``fact`` changed (or no table was built), else as they are."""
    known = files.exists(spark, os.path.join(tables.table_path(root, DAILY), "_current"))
    if known and not fact:
        return tables.read_table(spark, root, DAILY).where(_on(dates))
    daily = agg.telemetry_daily(tables.of_dates(tables.read_table(spark, root, "fct_telemetry"), dates))
    if not known:
        return daily
    rest = tables.read_table(spark, root, DAILY).where(~_on(dates))
    return tables.replace(spark, rest.unionByName(daily), root, DAILY).where(_on(dates))


def refresh_gold(spark: SparkSession, root: str, dates: Sequence[dt.date], fact: bool) -> DataFrame:
    """Mart rows of ``dates`` (and, with ``fact``, the fact's) computed anew from silver; the mart as read back."""
    def some(name: str) -> DataFrame:
        return tables.of_dates(tables.read_table(spark, root, name), dates)
    if fact:
        dim = tables.read_table(spark, root, "dim_device")
        tables.replace_dates(spark, gold.fct_telemetry(some("stg_telemetry"), dim), root, "fct_telemetry", dates)
    mart = gold.mart_from_layers(some("fct_telemetry"), some("stg_calibration"), some("stg_jobs"), some("stg_health"),
                                 telemetry_daily=_refresh_telemetry_daily(spark, root, dates, fact))
    old = tables.read_table(spark, root, "device_reliability_mart")
    return tables.replace(spark, old.where(~_on(dates)).select(*mart.columns).unionByName(mart), root, "device_reliability_mart")


def refresh(spark: SparkSession, root: str, stream: str, fresh: DataFrame,
            tie_break: Sequence[str] = silver.DEFAULT_TIE_BREAK) -> list[dt.date]:
    """Silver of ``stream``, then what is built on it, from new raw rows; the dates that changed."""
    dates = refresh_silver(spark, root, stream, fresh, tie_break)
    if dates and files.exists(spark, os.path.join(tables.table_path(root, "device_reliability_mart"), "_current")):
        refresh_gold(spark, root, dates, fact=stream == "telemetry")
    return dates


def fresh_rows(spark: SparkSession, bronze_root: str, stream: str, since: str) -> DataFrame:
    """Raw rows that were ingested at ``since`` (ISO text, UTC) or later."""
    spec = STREAMS[stream]
    return bronze.typed_projection(bronze.scan_bronze(spark, bronze_root, spec).where(F.col("_ingested_at") >= since), spec)
