"""Gold tables: qubit dimension (E3), telemetry fact (C7-C9, E1), daily aggregates
and the device reliability mart (F1-F7, E2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.exprs import composite_key, safe_ratio
from fleetlake.operators import aggregates as agg
from fleetlake.operators.joins import expand_range, join_dimension, left_join_all

BASELINES = ("baseline_T1_us", "baseline_T2_us", "baseline_gate_error_1q",
             "baseline_gate_error_2q", "baseline_readout_fidelity")


def dim_qubit(dim_device: DataFrame) -> DataFrame:
    """One row per qubit ``0 .. num_qubits-1`` of every device, with its composite key."""
    q = expand_range(dim_device.select("device_id", "num_qubits"), "num_qubits", "qubit_id")
    return q.select("device_id", "qubit_id", composite_key("device_id", "qubit_id").alias("qubit_key"))


def fct_telemetry(stg_telemetry: DataFrame, dim_device: DataFrame) -> DataFrame:
    """Physically valid telemetry joined to device baselines (left: unknown devices stay)."""
    c = F.col
    valid = stg_telemetry.where(c("t2_within_physical_limit") & c("two_qubit_error_expected")
                                & c("readout_fidelity_valid"))
    dim = dim_device.select("device_id", *[b for b in BASELINES if b in dim_device.columns])
    joined = join_dimension(valid, dim, "device_id", "left")
    return joined.select(
        "event_id", "device_id", "qubit_id",
        composite_key("device_id", "qubit_id").alias("qubit_key"),
        "T1_us", "T2_us", "gate_error_1q", "gate_error_2q", "readout_fidelity", "timestamp", "event_date",
        safe_ratio("gate_error_1q", "baseline_gate_error_1q").alias("gate_error_1q_ratio"),
        safe_ratio("gate_error_2q", "baseline_gate_error_2q").alias("gate_error_2q_ratio"),
        (c("readout_fidelity") - c("baseline_readout_fidelity")).alias("readout_fidelity_delta"),
    )


def device_reliability_mart(telemetry_daily: DataFrame, calibration_daily: DataFrame,
                            jobs_daily: DataFrame, health_daily: DataFrame) -> DataFrame:
    """Telemetry-led daily mart: other sides default to 'healthy' when absent."""
    c = F.col
    j = left_join_all(telemetry_daily, [calibration_daily, jobs_daily, health_daily], agg.GRAIN)
    return j.select(
        "device_id", "date",
        F.round("avg_T1_us", 3).alias("avg_T1_us"),
        F.round("avg_T2_us", 3).alias("avg_T2_us"),
        F.round("p99_gate_error_1q", 6).alias("p99_gate_error_1q"),
        F.round("p99_gate_error_2q", 6).alias("p99_gate_error_2q"),
        F.round("min_readout_fidelity", 5).alias("min_readout_fidelity"),
        "telemetry_count",
        F.coalesce(c("calibration_count"), F.lit(0).cast("bigint")).alias("calibration_count"),
        F.coalesce(c("successful_calibration_count"), F.lit(0).cast("bigint")).alias("successful_calibration_count"),
        (F.coalesce(c("pre_cal_drift_seen"), F.lit(False)) | c("drift_flag")).alias("drift_flag"),
        F.coalesce(c("job_count"), F.lit(0).cast("bigint")).alias("job_count"),
        F.round(F.coalesce(c("job_sla_pct"), F.lit(100.0)), 2).alias("job_sla_pct"),
        F.round(F.coalesce(c("avg_system_health_score"), F.lit(1.0)), 3).alias("avg_system_health_score"),
        F.round(F.coalesce(c("min_system_health_score"), F.lit(1.0)), 3).alias("min_system_health_score"),
        F.coalesce(c("health_alert_seen"), F.lit(False)).alias("health_alert_seen"),
    )


def mart_from_layers(fct: DataFrame, stg_calibration: DataFrame, stg_jobs: DataFrame,
                     stg_health: DataFrame, quantile_strategy: str = "distributed",
                     telemetry_daily: DataFrame | None = None) -> DataFrame:
    """The mart from fact and silver; ``telemetry_daily``: the fact's daily rows, if they are at hand."""
    if telemetry_daily is None:
        telemetry_daily = agg.telemetry_daily(fct, quantile_strategy=quantile_strategy)
    return device_reliability_mart(telemetry_daily,
                                   agg.calibration_daily(stg_calibration),
                                   agg.jobs_daily(stg_jobs), agg.health_daily(stg_health))
