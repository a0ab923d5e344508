"""Dashboard reports as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.operators.dedup import latest_group_per_entity


def mart_listing(mart: DataFrame) -> DataFrame:
    """G1: the mart, newest day first, then device."""
    return mart.orderBy(*listing_order())


def listing_order() -> list[Column]:
    return [F.col("date").desc(), F.col("device_id").asc()]


def latest_per_device(mart: DataFrame) -> DataFrame:
    """D3: each device's latest mart day."""
    return latest_group_per_entity(mart, "device_id", "date")


def fleet_kpis(mart: DataFrame) -> DataFrame:
    """devices, mean of avg T1, min readout fidelity, mean job SLA -- on each device's latest day."""
    latest = latest_per_device(mart)
    return latest.agg(
        F.countDistinct("device_id").alias("devices"),
        F.avg("avg_T1_us").alias("avg_T1_us"),
        F.min("min_readout_fidelity").alias("min_readout_fidelity"),
        F.avg("job_sla_pct").alias("job_sla_pct"),
    )


def telemetry_trend(fct: DataFrame) -> DataFrame:
    """F8: per timestamp and device, the mean of the four coherence/error metrics, by time."""
    return (fct.groupBy("timestamp", "device_id").agg(
        F.avg("T1_us").alias("avg_T1_us"),
        F.avg("T2_us").alias("avg_T2_us"),
        F.avg("gate_error_1q").alias("avg_gate_error_1q"),
        F.avg("gate_error_2q").alias("avg_gate_error_2q"),
    ).orderBy("timestamp"))


def job_status_breakdown(stg_jobs: DataFrame) -> DataFrame:
    """jobs and SLA % per device and status over all silver jobs (not gated)."""
    return (stg_jobs.groupBy("device_id", "status").agg(
        F.count(F.lit(1)).alias("jobs"),
        F.round(F.lit(100.0).cast("double") * F.avg(F.col("sla_met").cast("double")), 2).alias("sla_pct"),
    ).orderBy("device_id", "status"))


def latest_health(stg_health: DataFrame, limit: int = 500) -> DataFrame:
    """Newest health events (top-k; ``event_id`` breaks timestamp ties)."""
    return (stg_health.select("timestamp", "device_id", "cryo_temp_mk", "network_latency_ms",
                              "system_health_score", "control_elec_status", "network_status", "event_id")
            .orderBy(F.col("timestamp").desc(), F.col("event_id").asc())
            .limit(limit))
