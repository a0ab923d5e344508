"""Bind the supplied test tables to the four device streams.

The test data has no device streams, so each stream is derived from one table by
deterministic arithmetic (FIXTURES.md part B). Every frame keeps a ``tie`` column
(the source row's own key) so "latest per key" is deterministic on equal
timestamps. The derivation is a pure projection: Catalyst prunes the scan to the
columns used and the work grows linearly with the table.

All timestamps are TIMESTAMP_NTZ (the test parquet carries no zone); the session
runs in UTC, so NTZ and UTC instants coincide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions import derive
from fleetlake.schemas import CALIBRATION, HEALTH, JOBS, TELEMETRY

EPOCH = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"
DAY0 = "DATE'1995-01-01'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def minutes_after_epoch(n: Column) -> Column:
    """``2024-01-01 00:00`` plus ``n`` minutes, as TIMESTAMP_NTZ."""
    return F.timestamp_add("MINUTE", n, F.expr(EPOCH))


def folded_day(c: str) -> Column:
    """Fold a 1992-1998 date into January 2024: 17 minutes per day after 1995-01-01."""
    return minutes_after_epoch(F.lit(17) * F.datediff(F.col(c).cast("date"), F.expr(DAY0)))


def _device(c: str) -> Column:
    return F.concat(F.lit("dev_"), (F.col(c) % 4).cast("string"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> telemetry (natural duplicate event ids from the composite key)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("event_id"),
        _device("l_suppkey").alias("device_id"),
        (F.col("l_partkey") % 16).cast("int").alias("qubit_id"),
        (F.lit(100.0) + F.col("l_quantity") * 2).alias("T1_us"),
        (F.lit(100.0) + F.col("l_extendedprice") % 200).alias("T2_us"),
        (F.lit(0.0005) + F.col("l_discount") / 100).alias("gate_error_1q"),
        (F.lit(0.0004) + F.col("l_tax") / 10
         + F.when(F.col("l_partkey") % 997 == 0, F.lit(0.02)).otherwise(F.lit(0.0))).alias("gate_error_2q"),
        (F.lit(0.45) + F.col("l_quantity") / 90).alias("readout_fidelity"),
        folded_day("l_shipdate").alias("timestamp"),
        F.col("l_extendedprice").alias("tie"),
    )


def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> calibration runs (every fifth run id comes twice)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("run_"), F.expr("o_orderkey * 4 div 5").cast("string")).alias("run_id"),
        _device("o_custkey").alias("device_id"),
        F.when(F.col("o_orderpriority").startswith("1"), "drift_alert")
         .when(F.col("o_orderpriority").startswith("2"), "manual")
         .otherwise("scheduled").alias("triggered_by"),
        (F.col("o_totalprice") / 100).alias("duration_seconds"),
        F.lit(127).cast("int").alias("qubits_total"),
        (F.col("o_custkey") % 140).cast("int").alias("qubits_calibrated"),
        (F.col("o_orderkey") % 211 == 0).alias("pre_cal_drift_flag"),
        F.when(F.col("o_orderstatus") == "F", "success")
         .when(F.col("o_orderstatus") == "O", "partial")
         .otherwise("failed").alias("status"),
        F.concat(F.lit("1."), (F.col("o_custkey") % 5).cast("string"), F.lit(".0")).alias("backend_version"),
        folded_day("o_orderdate").alias("timestamp"),
        F.col("o_orderkey").alias("tie"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> jobs (every ninth job id comes twice; 2 % inconsistent totals)."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object(F.col("props"), "$.k").cast("double")
    return e.select(
        F.concat(F.lit("job_"), F.expr("event_id * 9 div 10").cast("string")).alias("job_id"),
        _device("user_id").alias("device_id"),
        F.format_string("user_%08x", F.col("user_id")).alias("user_id"),
        (F.lit(5) + F.col("event_id") % 495).cast("int").alias("circuit_depth"),
        (F.lit(512) * (F.lit(1) + F.col("event_id") % 16)).cast("int").alias("num_shots"),
        F.col("value").alias("queue_wait_seconds"),
        k.alias("exec_time_seconds"),
        (F.col("value") + k + F.when(F.col("event_id") % 50 == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .alias("total_time_seconds"),
        F.when(F.col("event_type") == "click", "cancelled")
         .when(F.col("event_type") == "error", "failed")
         .when(F.col("event_type") == "signup", "timeout")
         .otherwise("completed").alias("status"),
        F.when(F.col("event_type").isin("error", "signup") & (F.col("event_id") % 97 != 0), "ERR_X")
         .when(F.col("event_id") % 89 == 0, "ERR_Y").alias("error_code"),
        (F.col("value") + k <= 100).alias("sla_met"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("tie"),
    )


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> health events (every fourteenth id comes twice; out-of-range values occur)."""
    c = table(spark, sf_dir, "customer")
    cryo = F.lit(4.0) + F.col("c_nationkey") * F.lit(4.2)
    ctrl = F.when(F.col("c_custkey") % 101 == 0, "fault").otherwise("nominal")
    net = F.when(F.col("c_custkey") % 173 == 0, "degraded").otherwise("ok")
    stable = derive.cryo_stable(cryo)
    return c.select(
        F.concat(F.lit("h_"), F.expr("c_custkey * 14 div 15").cast("string")).alias("event_id"),
        _device("c_custkey").alias("device_id"),
        cryo.alias("cryo_temp_mk"),
        stable.alias("cryo_temp_stable"),
        ctrl.alias("control_elec_status"),
        ((F.col("c_custkey") % 50) / 10).alias("network_latency_ms"),
        net.alias("network_status"),
        (F.col("c_acctbal") / 10000).alias("system_health_score"),
        derive.active_alerts(stable, ctrl, net).alias("active_alerts"),
        minutes_after_epoch(((F.col("c_custkey") % 1500) * 28).cast("int")).alias("timestamp"),
        F.col("c_custkey").alias("tie"),
    )


BINDINGS = {"telemetry": telemetry, "calibration": calibration, "jobs": jobs, "health": health}
SPECS = {"telemetry": TELEMETRY, "calibration": CALIBRATION, "jobs": JOBS, "health": HEALTH}


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BINDINGS[name](spark, sf_dir)


def device_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices of the fleet, derived from ``supplier`` the same way telemetry is."""
    s = table(spark, sf_dir, "supplier")
    return s.select(_device("s_suppkey").alias("device_id")).distinct()


# Baseline profiles of the bound fleet (FIXTURES.md part B). dev_3 has
# no profile on purpose, so its ratios are null after the left join.
BINDING_PROFILES = [
    ("dev_0", 16, "1.0.0", "region-a", 150.0, 100.0, 0.0010, 0.0060, 0.985),
    ("dev_1", 16, "1.1.0", "region-b", 150.0, 100.0, 0.0020, 0.0050, 0.990),
    ("dev_2", 16, "1.2.0", "region-c", 150.0, 100.0, 0.0030, 0.0150, 0.978),
]
