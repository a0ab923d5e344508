"""Stream, dimension and alert schemas.

One ``StreamSpec`` per event stream is the single source of truth: it yields the
wire contract (functions/contracts.py), the bronze StructType (sources/bronze.py)
and the typed projection (raw_* tables).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class FieldSpec:
    """One wire field: JSON type, stored Spark type and value rules (all inclusive)."""

    name: str
    json_type: str                      # string | integer | number | boolean | array | date-time
    spark_type: T.DataType
    nullable_json: bool = False         # JSON type union with "null"
    minimum: float | None = None
    maximum: float | None = None
    min_length: int | None = None
    enum: tuple[str, ...] | None = None
    pattern: str | None = None
    item_type: str | None = None        # for arrays: JSON type of the items


@dataclass(frozen=True)
class StreamSpec:
    name: str                           # logical stream: telemetry | calibration | jobs | health
    topic: str                          # default topic name
    key: str                            # dedup key of the silver table
    fields: tuple[FieldSpec, ...]
    partition_cols: tuple[str, ...] = ("date", "device_id")
    extra_bronze: tuple[str, ...] = field(default=("_ingested_at", "_source_topic"))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def struct(self, with_bronze: bool = False) -> T.StructType:
        """Wire-side StructType (timestamp already parsed); optionally bronze columns."""
        cols = [T.StructField(f.name, f.spark_type, True) for f in self.fields]
        if with_bronze:
            cols += [T.StructField("_ingested_at", T.StringType(), True),
                     T.StructField("_source_topic", T.StringType(), True),
                     T.StructField("date", T.DateType(), True)]
        return T.StructType(cols)


S, I, D, B, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType()

# ---------------------------------------------------------------------------
# Event contracts of the four streams (names, JSON types,
# inclusive bounds, enums, patterns, topics and keys) as the reference declares them.
# ---------------------------------------------------------------------------
TELEMETRY = StreamSpec(
    name="telemetry", topic="qpu.telemetry", key="event_id",
    fields=(
        FieldSpec("event_id", "string", S),
        FieldSpec("device_id", "string", S, min_length=1),
        FieldSpec("qubit_id", "integer", I, minimum=0),
        FieldSpec("T1_us", "number", D, minimum=10.0, maximum=500.0),
        FieldSpec("T2_us", "number", D, minimum=5.0, maximum=1000.0),
        FieldSpec("gate_error_1q", "number", D, minimum=0.0, maximum=0.05),
        FieldSpec("gate_error_2q", "number", D, minimum=0.0, maximum=0.15),
        FieldSpec("readout_fidelity", "number", D, minimum=0.5, maximum=1.0),
        FieldSpec("timestamp", "date-time", TS),
    ),
)

CALIBRATION = StreamSpec(
    name="calibration", topic="qpu.calibration", key="run_id",
    fields=(
        FieldSpec("run_id", "string", S),
        FieldSpec("device_id", "string", S, min_length=1),
        FieldSpec("triggered_by", "string", S, enum=("scheduled", "manual", "drift_alert")),
        FieldSpec("duration_seconds", "number", D, minimum=60.0, maximum=3600.0),
        FieldSpec("qubits_total", "integer", I, minimum=1),
        FieldSpec("qubits_calibrated", "integer", I, minimum=0),
        FieldSpec("pre_cal_drift_flag", "boolean", B),
        FieldSpec("status", "string", S, enum=("success", "partial", "failed")),
        FieldSpec("backend_version", "string", S, min_length=1),
        FieldSpec("timestamp", "date-time", TS),
    ),
)

JOBS = StreamSpec(
    name="jobs", topic="qpu.jobs", key="job_id",
    fields=(
        FieldSpec("job_id", "string", S),
        FieldSpec("device_id", "string", S, min_length=1),
        FieldSpec("user_id", "string", S, pattern="^user_[0-9a-f]{8}$"),
        FieldSpec("circuit_depth", "integer", I, minimum=1),
        FieldSpec("num_shots", "integer", I, minimum=1),
        FieldSpec("queue_wait_seconds", "number", D, minimum=0.0),
        FieldSpec("exec_time_seconds", "number", D, minimum=0.0),
        FieldSpec("total_time_seconds", "number", D, minimum=0.0),
        FieldSpec("status", "string", S, enum=("completed", "failed", "cancelled", "timeout")),
        FieldSpec("error_code", "string", S, nullable_json=True),
        FieldSpec("sla_met", "boolean", B),
        FieldSpec("timestamp", "date-time", TS),
    ),
)

HEALTH = StreamSpec(
    name="health", topic="qpu.health", key="event_id",
    fields=(
        FieldSpec("event_id", "string", S),
        FieldSpec("device_id", "string", S, min_length=1),
        FieldSpec("cryo_temp_mk", "number", D, minimum=5.0, maximum=100.0),
        FieldSpec("cryo_temp_stable", "boolean", B),
        FieldSpec("control_elec_status", "string", S, enum=("nominal", "degraded", "fault")),
        FieldSpec("network_latency_ms", "number", D, minimum=0.0),
        FieldSpec("network_status", "string", S, enum=("ok", "degraded", "down")),
        FieldSpec("system_health_score", "number", D, minimum=0.0, maximum=1.0),
        FieldSpec("active_alerts", "array", T.ArrayType(S), item_type="string"),
        FieldSpec("timestamp", "date-time", TS),
    ),
)

STREAMS: dict[str, StreamSpec] = {s.name: s for s in (TELEMETRY, CALIBRATION, JOBS, HEALTH)}

DIM_DEVICE = T.StructType([
    T.StructField("device_id", S, False),
    T.StructField("num_qubits", I, True),
    T.StructField("backend_version", S, True),
    T.StructField("region", S, True),
    T.StructField("baseline_T1_us", D, True),
    T.StructField("baseline_T2_us", D, True),
    T.StructField("baseline_gate_error_1q", D, True),
    T.StructField("baseline_gate_error_2q", D, True),
    T.StructField("baseline_readout_fidelity", D, True),
])

DRIFT_ALERT = T.StructType([
    T.StructField("device_id", S, True),
    T.StructField("qubit_id", I, True),
    T.StructField("timestamp", S, True),
    T.StructField("metric", S, True),
    T.StructField("value", D, True),
    T.StructField("rolling_mean", D, True),
    T.StructField("rolling_stddev", D, True),
    T.StructField("zscore", D, True),
])
