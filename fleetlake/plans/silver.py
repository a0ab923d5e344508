"""Silver tables: filter -> validity flags -> latest row per key.

The filter runs *before* the dedup: an invalid newest row must not hide a valid
older one. Dedup is global over all dates (a key may appear under several event
dates), ordered by ``timestamp desc`` then the caller's tie-break columns, which
``keep_ties`` returns as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.operators.dedup import latest_per_key

DEFAULT_TIE_BREAK: tuple[str, ...] = ("tie",)


def _ties(df: DataFrame, tie_break: Sequence[str], keep: bool) -> list[str]:
    return [c for c in tie_break if c in df.columns] if keep else []


def _order(df: DataFrame, tie_break: Sequence[str]) -> list[str]:
    return ["timestamp"] + [c for c in tie_break if c in df.columns]


def stg_telemetry(raw: DataFrame, tie_break: Sequence[str] = DEFAULT_TIE_BREAK, keep_ties: bool = False) -> DataFrame:
    c = F.col
    kept = raw.where(
        c("device_id").isNotNull() & c("qubit_id").isNotNull()
        & (c("T1_us") > 0) & (c("T2_us") > 0)
        & (c("gate_error_1q") >= 0) & (c("gate_error_2q") >= 0)
        & c("readout_fidelity").between(0.5, 1.0))
    latest = latest_per_key(kept.select("event_id", "device_id", "qubit_id", "T1_us", "T2_us",
                                        "gate_error_1q", "gate_error_2q", "readout_fidelity",
                                        "timestamp", "event_date", *[t for t in tie_break if t in raw.columns]),
                            "event_id", _order(raw, tie_break))
    return latest.select(
        "event_id", "device_id", "qubit_id", "T1_us", "T2_us", "gate_error_1q", "gate_error_2q",
        "readout_fidelity", "timestamp", "event_date",
        (c("T2_us") <= 2 * c("T1_us")).alias("t2_within_physical_limit"),
        (c("gate_error_2q") >= c("gate_error_1q")).alias("two_qubit_error_expected"),
        c("readout_fidelity").between(0.5, 1.0).alias("readout_fidelity_valid"),
        *_ties(raw, tie_break, keep_ties),
    )


def stg_calibration(raw: DataFrame, tie_break: Sequence[str] = DEFAULT_TIE_BREAK, keep_ties: bool = False) -> DataFrame:
    c = F.col
    cols = ["run_id", "device_id", "triggered_by", "duration_seconds", "qubits_total",
            "qubits_calibrated", "pre_cal_drift_flag", "status", "backend_version", "timestamp", "event_date"]
    kept = raw.where(
        c("device_id").isNotNull() & (c("qubits_total") > 0)
        & c("qubits_calibrated").between(F.lit(0), c("qubits_total"))
        & c("duration_seconds").between(60, 3600))
    latest = latest_per_key(kept.select(*cols, *[t for t in tie_break if t in raw.columns]),
                            "run_id", _order(raw, tie_break))
    return latest.select(
        *cols,
        (c("qubits_calibrated") <= c("qubits_total")).alias("qubit_count_valid"),
        c("duration_seconds").between(60, 3600).alias("duration_valid"),
        *_ties(raw, tie_break, keep_ties),
    )


def error_code_valid(status="status", error_code="error_code"):
    """completed/cancelled need no code; failed/timeout need one; any other status is invalid."""
    s, e = F.col(status), F.col(error_code)
    return (F.when(s.isin("completed", "cancelled"), e.isNull())
             .when(s.isin("failed", "timeout"), e.isNotNull())
             .otherwise(F.lit(False)))


def stg_jobs(raw: DataFrame, tie_break: Sequence[str] = DEFAULT_TIE_BREAK, keep_ties: bool = False) -> DataFrame:
    c = F.col
    cols = ["job_id", "device_id", "user_id", "circuit_depth", "num_shots", "queue_wait_seconds",
            "exec_time_seconds", "total_time_seconds", "status", "error_code", "sla_met", "timestamp",
            "event_date"]
    kept = raw.where(
        c("device_id").isNotNull() & (c("queue_wait_seconds") >= 0)
        & (c("exec_time_seconds") >= 0) & (c("total_time_seconds") >= 0))
    latest = latest_per_key(kept.select(*cols, *[t for t in tie_break if t in raw.columns]),
                            "job_id", _order(raw, tie_break))
    return latest.select(
        *cols,
        (F.abs(c("total_time_seconds") - (c("queue_wait_seconds") + c("exec_time_seconds"))) <= 0.05)
        .alias("total_time_valid"),
        error_code_valid().alias("error_code_valid"),
        *_ties(raw, tie_break, keep_ties),
    )


def stg_health(raw: DataFrame, tie_break: Sequence[str] = DEFAULT_TIE_BREAK, keep_ties: bool = False) -> DataFrame:
    c = F.col
    cols = ["event_id", "device_id", "cryo_temp_mk", "cryo_temp_stable", "control_elec_status",
            "network_latency_ms", "network_status", "system_health_score", "active_alerts",
            "timestamp", "event_date"]
    kept = raw.where(
        c("device_id").isNotNull() & c("system_health_score").between(0, 1)
        & c("cryo_temp_mk").between(5, 100))
    latest = latest_per_key(kept.select(*cols, *[t for t in tie_break if t in raw.columns]),
                            "event_id", _order(raw, tie_break))
    return latest.select(
        *cols,
        c("system_health_score").between(0, 1).alias("health_score_valid"),
        c("cryo_temp_mk").between(5, 100).alias("cryo_temp_valid"),
        *_ties(raw, tie_break, keep_ties),
    )


SILVER = {"telemetry": stg_telemetry, "calibration": stg_calibration, "jobs": stg_jobs, "health": stg_health}
