"""Ingestion: validate messages against the stream contract, enrich the valid ones,
route the rest to rejects (B1-B7). Batch and streaming share this code."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import contracts
from fleetlake.functions.timestamps import iso_text
from fleetlake.schemas import StreamSpec


def validate(messages: DataFrame, spec: StreamSpec, value_col: str = "value",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """Parse once, type every field, and list every violation per message.

    Output: ``value``, typed stream fields, ``_violations`` (empty = accepted) and
    the ``carry`` columns.
    """
    p = contracts.parse(messages, F.col(value_col), spec, [F.col(value_col).alias("value"), *carry])
    return p.select("value", *carry, *spec.names, contracts.violations(spec).alias("_violations"))


def enrich(valid: DataFrame, spec: StreamSpec, topic: Column | None = None,
           now: Column | None = None) -> DataFrame:
    """Add ``_ingested_at`` (ISO text, UTC), ``_source_topic`` and the UTC event ``date``."""
    now = now if now is not None else F.current_timestamp()
    return valid.select(
        *spec.names,
        iso_text(now).alias("_ingested_at"),
        (topic if topic is not None else F.lit(spec.topic)).alias("_source_topic"),
        F.to_date("timestamp").alias("date"),
        *[c for c in valid.columns if c not in spec.names and not c.startswith("_") and c != "value"],
    )


@dataclass
class Ingested:
    valid: DataFrame      # enriched, bronze-shaped rows
    rejects: DataFrame    # (value, _violations, carry...)
    checked: DataFrame | None = None

    def release(self) -> None:
        if self.checked is not None:
            self.checked.unpersist()


def split(messages: DataFrame, spec: StreamSpec, value_col: str = "value",
          carry: tuple[str, ...] = (), persist: bool = True) -> Ingested:
    """Accepted rows (enriched) and rejects with their violation names.

    Both outputs derive from one validated frame, which is persisted (memory,
    spilling to disk): the JSON is parsed and checked once for both outputs, and
    the cached relation is a plan boundary -- without it the optimizer pushes the
    two row filters below the rule projections and inlines every rule (and the
    parse) into each filter. Call ``Ingested.release()`` after writing.
    With ``persist=False`` (for a caller of one output) nothing is cached.
    """
    checked = validate(messages, spec, value_col, carry)
    if persist:
        checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
        ok = checked.where(F.size("_violations") == 0)
    else:
        # an empty list gives one row with a null name; no filter can move below the rules
        ok = checked.withColumn("_v", F.explode_outer("_violations")).where(F.col("_v").isNull()).drop("_v")
    bad = checked.where(F.size("_violations") > 0).select("value", "_violations", *carry)
    return Ingested(enrich(ok.drop("value", "_violations"), spec), bad, checked if persist else None)


def reject_summary(checked: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Rejected records counted per violation name (a record with two violations
    counts twice). Works on validated or rejected rows alike: accepted records have
    an empty list and contribute nothing.

    ``explode_outer`` + a null filter above it, rather than ``explode``: for
    ``explode`` the optimizer infers ``size(list) > 0`` and pushes it below the
    rule projections, inlining every rule into that filter.
    """
    return (checked.select(*by, F.explode_outer("_violations").alias("rule"))
            .where(F.col("rule").isNotNull())
            .groupBy(*by, "rule").agg(F.count(F.lit(1)).alias("rejected")))
