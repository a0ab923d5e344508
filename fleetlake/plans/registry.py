"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the supplied test tables (through the stream bindings) and runs
over them whole. Array columns are returned joined to text so results compare as
scalars against the SQL oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions import contracts, derive
from fleetlake.operators import drift, quality
from fleetlake.operators.ranking import with_position
from fleetlake.plans import drift_runs, gold, incremental, ingest, reports, silver
from fleetlake.plans.pipeline import Layers, build_all, materialize, refresh_mart, register_all
from fleetlake.schemas import STREAMS, FieldSpec, StreamSpec
from fleetlake.session import cut, scratch_path
from fleetlake.sources import alerts as alert_io
from fleetlake.sources import bindings, bronze, files
from fleetlake.sources.catalog import find_table
from fleetlake.sources.events import encode_events, land_events
from fleetlake.sources.rejects import read_rejects, scan_rejects
from fleetlake.sources.tables import read_table
from fleetlake.streaming.ingest import BATCH_BYTES, BRONZE, REJECTS, file_messages, ingest_files, start_ingest

Query = Callable[[SparkSession, str], DataFrame]


def _scalar_arrays(df: DataFrame) -> DataFrame:
    cols = [F.array_join(F.col(n), "|").alias(n) if t.startswith("array") else F.col(n) for n, t in df.dtypes]
    return df.select(*cols)


def _on_layers(fn: Callable[[Layers], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _scalar_arrays(fn(Layers.from_test_tables(spark, sf_dir)))
    return run


QUERIES: dict[str, Query] = {}
for _s in ("telemetry", "calibration", "jobs", "health"):
    QUERIES[f"raw_{_s}"] = _on_layers(lambda L, s=_s: L.raw(s))
    QUERIES[f"stg_{_s}"] = _on_layers(lambda L, s=_s: L.stg(s))
    QUERIES[f"{_s}_daily"] = _on_layers(lambda L, s=_s: L.daily(s))

QUERIES.update({
    "dim_device": _on_layers(lambda L: L.dim_device),
    "dim_qubit": _on_layers(lambda L: L.dim_qubit),
    "fct_telemetry": _on_layers(lambda L: L.fct_telemetry),
    # F5 through the daily aggregate: the same exact-quantile strategy choice
    "p99_by_device_day": _on_layers(lambda L: L.daily("telemetry").select(
        "device_id", "date", "p99_gate_error_1q", "p99_gate_error_2q")),
    "device_reliability_mart": _on_layers(lambda L: L.mart),
    "drift_alerts": _on_layers(lambda L: L.drift_alerts()),
    "mart_listing": _on_layers(lambda L: reports.mart_listing(L.mart)),
    "latest_per_device": _on_layers(lambda L: reports.latest_per_device(L.mart)),
    "fleet_kpis": _on_layers(lambda L: reports.fleet_kpis(L.mart)),
    "telemetry_trend": _on_layers(lambda L: reports.telemetry_trend(L.fct_telemetry)),
    "job_status_breakdown": _on_layers(lambda L: reports.job_status_breakdown(L.stg("jobs"))),
    "latest_health": _on_layers(lambda L: reports.latest_health(L.stg("health"))),
})


# ---------------------------------------------------------------------------
# Ingestion: the bound streams are encoded as JSON messages (A3) and go through
# the contract (B1-B5), enrichment (B6) and reject routing.
# ---------------------------------------------------------------------------
def _messages(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The bound stream as messages, dealt evenly like a topic's partitions at every size."""
    return encode_events(bindings.stream(spark, sf_dir, name).hint("rebalance"), STREAMS[name], carry=("tie",))


def _ntz(df: DataFrame) -> DataFrame:
    """Report parsed UTC instants as zone-less timestamps (the test tables' type)."""
    return df.select(*[F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n)
                       for n, t in df.dtypes])


def _contract(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = STREAMS[name]
        checked = ingest.validate(_messages(spark, sf_dir, name), spec, carry=("tie",))
        return checked.select(spec.key, "tie", F.array_join("_violations", "|").alias("violations"))
    return run


def _validate(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = STREAMS[name]
        rows = bindings.stream(spark, sf_dir, name)
        return rows.select(spec.key, "tie",
                           F.array_join(contracts.domain_violations(spec), "|").alias("violations"))
    return run


def _enrich(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = STREAMS[name]
        valid = ingest.split(_messages(spark, sf_dir, name), spec, carry=("tie",), persist=False).valid
        return _scalar_arrays(_ntz(valid.drop("_ingested_at")))
    return run


for _s in STREAMS:
    QUERIES[f"contract_{_s}"] = _contract(_s)
    QUERIES[f"validate_{_s}"] = _validate(_s)
    QUERIES[f"enrich_{_s}"] = _enrich(_s)


def _land(spark: SparkSession, sf_dir: str, name: str, path: str) -> None:
    """The bound stream's messages as JSON-lines files. They aren't dealt anew: the files spread the reading."""
    land_events(encode_events(bindings.stream(spark, sf_dir, name), STREAMS[name]), path)


def _all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for s in STREAMS:
        m = _messages(spark, sf_dir, s).drop("tie")
        out = m if out is None else out.unionByName(m)
    return out


def encode_events_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: every bound stream as keyed JSON messages."""
    return _all_messages(spark, sf_dir)


def ingest_batch_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: each stream's messages land as JSON-lines files, are read back and ingested: checked, enriched and
    appended to bronze or routed to rejects. The rows that the two then hold, per stream."""
    root = scratch_path(spark, f"ingest-{uuid.uuid4().hex}")
    parts = []
    for name, spec in STREAMS.items():
        landing = f"{root}/landing/{name}"
        _land(spark, sf_dir, name, landing)
        ingest_files(spark, landing, spec, f"{root}/bronze", f"{root}/rejects", clean=True)
        files.remove(spark, landing)
        written = bronze.scan_bronze(spark, f"{root}/bronze", spec).select(F.lit(True).alias("ok")).unionByName(
            scan_rejects(spark, f"{root}/rejects", spec).select(F.lit(False).alias("ok")))
        parts.append(written.agg(F.count_if("ok").alias("accepted"), F.count_if(~F.col("ok")).alias("rejected"))
                     .select(F.lit(name).alias("stream"), "accepted", "rejected"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reject_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages per stream and violation name."""
    parts = []
    for name, spec in STREAMS.items():
        # exploding the violation list drops accepted records (empty lists) without a filter
        checked = ingest.validate(_messages(spark, sf_dir, name), spec)
        parts.append(ingest.reject_summary(checked.withColumn("stream", F.lit(name)), by=("stream",)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bronze_roundtrip_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + A5: accepted telemetry appended to hive-partitioned bronze, scanned back,
    counted per partition."""
    spec = STREAMS["telemetry"]
    root = scratch_path(spark, f"bronze-{uuid.uuid4().hex}")
    valid = ingest.split(_messages(spark, sf_dir, "telemetry"), spec, persist=False).valid
    bronze.write_bronze(valid, root, spec)
    raw = bronze.typed_projection(bronze.scan_bronze(spark, root, spec), spec)
    return raw.groupBy("event_date", "device_id").agg(F.count(F.lit(1)).alias("rows"))


def _bronze_values(name: str) -> Query:
    """A4 + A5 by value: accepted rows appended to bronze and scanned back as typed rows."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = STREAMS[name]
        root = scratch_path(spark, f"bronze-{uuid.uuid4().hex}")
        bronze.write_bronze(ingest.split(_messages(spark, sf_dir, name), spec, persist=False).valid, root, spec)
        raw = bronze.typed_projection(bronze.scan_bronze(spark, root, spec), spec)
        return _scalar_arrays(_ntz(raw.drop("_ingested_at")))
    return run


def _encoded(name: str) -> Query:
    """A3 by value: key, topic and the fields decoded from the JSON text of every message."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = STREAMS[name]
        schema = T.StructType([T.StructField(f.name, f.spark_type) for f in spec.fields])
        m = _messages(spark, sf_dir, name).select("key", "topic", "tie", F.from_json("value", schema).alias("v"))
        return _scalar_arrays(_ntz(m.select("key", "topic", "tie", "v.*")))
    return run


for _s in STREAMS:
    QUERIES[f"bronze_values_{_s}"] = _bronze_values(_s)
    QUERIES[f"encoded_{_s}"] = _encoded(_s)


def _mutated(value: str, which, changes: list[tuple[str, str]]):
    """The JSON text with the change numbered ``which`` (from 1); any other number leaves it."""
    out = F.col(value)
    for i, (pattern, text) in enumerate(changes, 1):
        out = F.when(which == i, F.regexp_replace(F.col(value), pattern, text)).otherwise(out)
    return out


# one change per structural rule: pattern in the message, what takes its place
JOB_CHANGES = [
    ('"status":"[a-z]+",', ""),                           # required
    (r"^\{", '{"zz":1,'),                                 # additional
    (r'"num_shots":(\d+)', '"num_shots":"$1"'),           # type
    (r'"num_shots":\d+', '"num_shots":3000000000'),       # beyond the stored integer
    ('"status":"[a-z]+"', '"status":"lost"'),             # enum
    ('"user_id":"user_', '"user_id":"usr_'),              # pattern
    (r"\}$", ""),                                         # not JSON
    ('"timestamp":"[^"]*"', '"timestamp":"20240101"'),    # not an ISO date-time
    (r'"circuit_depth":\d+', '"circuit_depth":true'),     # type
]
HEALTH_CHANGES = [
    (r'"active_alerts":\[[^\]]*\]', '"active_alerts":["a",null]'),  # items
    (r'"active_alerts":\[[^\]]*\]', '"active_alerts":["a",1]'),     # items
    ('"device_id":"[^"]*"', '"device_id":""'),                       # minLength
]


def contract_structural_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: every job and health message, most with one change that breaks one structural rule."""
    parts = []
    for name, changes in (("jobs", JOB_CHANGES), ("health", HEALTH_CHANGES)):
        m = _messages(spark, sf_dir, name)
        m = m.withColumn("value", _mutated("value", F.col("tie") % (len(changes) + 1), changes))
        checked = ingest.validate(m, STREAMS[name], carry=("tie",))
        parts.append(checked.select(F.lit(name).alias("stream"), F.col("tie").cast("long").alias("tie"),
                                    F.array_join(F.array_sort("_violations"), "|").alias("violations")))
    return parts[0].unionByName(parts[1])


QUERIES["contract_structural"] = contract_structural_q


def alerts_roundtrip_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + A9: drift alerts written as JSON lines and read back with the declared schema."""
    path = scratch_path(spark, f"alerts-{uuid.uuid4().hex}")
    alert_io.write_alerts(Layers.from_test_tables(spark, sf_dir).drift_alerts(), path)
    return alert_io.read_alerts(spark, path)


def contract_props_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 on a real JSON column: ``events.props`` must be ``{"k": integer in 10..90}``."""
    spec = StreamSpec(name="props", topic="events.props", key="event_id",
                      fields=(FieldSpec("k", "integer", T.LongType(), minimum=10, maximum=90),))
    ev = bindings.table(spark, sf_dir, "events")
    p = contracts.parse(ev, F.col("props"), spec, ["event_id"])
    return p.select("event_id", F.array_join(contracts.violations(spec), "|").alias("violations"))


def _health_rows(spark, sf_dir):
    return bindings.stream(spark, sf_dir, "health")


QUERIES.update({
    "encode_events": encode_events_q,
    "ingest_batch": ingest_batch_q,
    "reject_summary": reject_summary_q,
    "bronze_roundtrip": bronze_roundtrip_q,
    "alerts_roundtrip": alerts_roundtrip_q,
    "contract_props": contract_props_q,
    "derive_health_score": lambda spark, sf_dir: _health_rows(spark, sf_dir).select(
        "event_id", "tie", derive.health_score("cryo_temp_stable", "control_elec_status", "network_status")
        .alias("derived_health_score")),
    "derive_active_alerts": lambda spark, sf_dir: _health_rows(spark, sf_dir).select(
        "event_id", "tie", F.array_join(derive.active_alerts(
            derive.cryo_stable("cryo_temp_mk"), "control_elec_status", "network_status"), "|")
        .alias("derived_active_alerts")),
    "derive_sla": lambda spark, sf_dir: bindings.stream(spark, sf_dir, "jobs").select(
        "job_id", "tie", "total_time_seconds", derive.sla_met("total_time_seconds").alias("derived_sla_met")),
    "dq_duplicate_keys": _on_layers(lambda L: quality.duplicate_keys(L.raw("calibration"), "run_id")),
    "dq_not_null": _on_layers(lambda L: quality.not_null(L.mart, "device_id")),
    "dq_not_null_raw": _on_layers(lambda L: quality.not_null(L.raw("jobs"), "error_code")),
    "dq_range": _on_layers(lambda L: quality.out_of_range(L.raw("telemetry"), "readout_fidelity", 0.5, 1.0)),
})


def dq_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: violation counts of the standard checks, taken while the tables are written, plus the same
    checks on the raw inputs (which do have violations)."""
    L = Layers.from_test_tables(spark, sf_dir)
    root, results = scratch_path(spark, f"checked-{uuid.uuid4().hex}"), []
    stg = {s: materialize(spark, L.stg(s), root, f"stg_{s}", results) for s in STREAMS}
    fct = materialize(spark, gold.fct_telemetry(stg["telemetry"], L.dim_device), root, "fct_telemetry", results)
    refresh_mart(spark, root, {"fct_telemetry": fct, **{f"stg_{s}": df for s, df in stg.items()}}, results=results)
    raw = quality.run_checks(spark, {
        "raw_duplicate_calibration_runs": quality.duplicate_keys(L.raw("calibration"), "run_id"),
        "raw_fidelity_range": quality.out_of_range(L.raw("telemetry"), "readout_fidelity", 0.5, 1.0)})
    return quality.report_of(spark, results).unionByName(raw)


QUERIES["dq_report"] = dq_report_q


def refresh_mart_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + Q5: write silver, dimensions, fact and mart as tables (with the quality
    gate), then rebuild only the mart from the written tables."""
    root = scratch_path(spark, f"tables-{uuid.uuid4().hex}")
    build_all(spark, Layers.from_test_tables(spark, sf_dir), root)
    return refresh_mart(spark, root)


def named_tables_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: build and register twice (each name then shows the second build), then count the rows of every table,
    found by its name."""
    root = scratch_path(spark, f"named-{uuid.uuid4().hex}")
    layers = Layers.from_test_tables(spark, sf_dir)
    names = list(build_all(spark, layers, root, register=True))
    refresh_mart(spark, root)
    register_all(spark, root, ["device_reliability_mart"])
    parts = [spark.table(find_table(spark, n)).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Streaming (J1-J3, B7): bound streams land as JSON-lines files and go through the bounded ingest.
# ---------------------------------------------------------------------------
def _streamed(spark: SparkSession, sf_dir: str, name: str, fail_after: str | None = None) -> str:
    """Ingest one stream; the folder that holds its bronze and rejects. With ``fail_after`` every batch fails once
    behind that write, and the query is started again from its checkpoint."""
    spec, failed, passed = STREAMS[name], [], []
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    _land(spark, sf_dir, name, f"{root}/landing")

    def fail(write: str) -> None:
        if write == fail_after:
            again = len(failed) > len(passed)  # the batch that failed last
            (passed if again else failed).append(write)
            if not again:
                raise RuntimeError(f"failed behind the {write} write")

    done = False
    while not done:
        before = len(failed)
        messages = file_messages(spark, f"{root}/landing", spec.topic, max_bytes_per_trigger=BATCH_BYTES, clean=True)
        try:
            start_ingest(messages, spec, f"{root}/bronze", f"{root}/rejects", f"{root}/checkpoint", available_now=True,
                         on_written=fail).awaitTermination()
            done = True
        except StreamingQueryException:
            if len(failed) == before:
                raise
    files.remove(spark, f"{root}/landing")
    return root


def _bronze_rows(spark: SparkSession, root: str, name: str) -> DataFrame:
    return bronze.typed_projection(bronze.scan_bronze(spark, f"{root}/bronze", STREAMS[name]), STREAMS[name])


def stream_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bound telemetry lands as JSON-lines files, a bounded streaming
    ingest (availableNow) appends accepted rows to bronze; rows per partition."""
    raw = _bronze_rows(spark, _streamed(spark, sf_dir, "telemetry"), "telemetry")
    return raw.groupBy("event_date", "device_id").agg(F.count(F.lit(1)).alias("rows"))


def _stream_values(name: str) -> Query:
    """J1/J2 by value: every accepted row of a stream, as the bounded ingest wrote it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _scalar_arrays(_ntz(_bronze_rows(spark, _streamed(spark, sf_dir, name), name).drop("_ingested_at")))
    return run


def replay_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every telemetry batch fails behind its bronze write and is replayed; silver of the bronze rows."""
    root = _streamed(spark, sf_dir, "telemetry", fail_after=BRONZE)
    return _ntz(silver.stg_telemetry(_bronze_rows(spark, root, "telemetry")))


def replay_rejects_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B7 + J3: every batch of every stream fails behind its rejects write and is replayed; rejects by content, per rule."""
    parts = []
    for name, spec in STREAMS.items():
        root = _streamed(spark, sf_dir, name, fail_after=REJECTS)
        parts.append(ingest.reject_summary(read_rejects(spark, f"{root}/rejects", spec).withColumn("stream", F.lit(name)), by=("stream",)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Late data (J4) and drift from run to run (D2). All rows are used: some arrive first, the others late.
# ---------------------------------------------------------------------------
def _late(name: str):
    """Whether a raw row arrives late: about a quarter of all rows, on every date."""
    return F.pmod(F.xxhash64(STREAMS[name].key, "tie"), F.lit(4)) == 0


def late_data_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver telemetry built from the rows in time, then brought up to date with the late ones."""
    root = scratch_path(spark, f"late-{uuid.uuid4().hex}")
    raw, late = Layers.from_test_tables(spark, sf_dir).raw("telemetry"), _late("telemetry")
    columns = incremental.build_silver(spark, root, "telemetry", raw.where(~late)).columns
    incremental.refresh_silver(spark, root, "telemetry", raw.where(late))
    return read_table(spark, root, "stg_telemetry").select(*columns)


def late_mart_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables built from the rows in time, then silver, fact and mart brought up to date stream by stream."""
    root = scratch_path(spark, f"late-{uuid.uuid4().hex}")
    L = Layers.from_test_tables(spark, sf_dir)
    build_all(spark, Layers(lambda s: L.raw(s).where(~_late(s)), lambda: L.dim_device), root, late_data=True)
    for s in STREAMS:
        incremental.refresh(spark, root, s, L.raw(s).where(_late(s)))
    return read_table(spark, root, "device_reliability_mart")


def drift_runs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over the first dates, one over the rest; the alerts of both."""
    state = scratch_path(spark, f"drift-{uuid.uuid4().hex}")
    fct = cut(Layers.from_test_tables(spark, sf_dir).fct_telemetry, "fact")
    first, last = fct.agg(F.min("event_date"), F.max("event_date")).first()
    if first is not None:
        drift_runs.run(spark, fct.where(F.col("event_date") <= F.lit(first + (last - first) / 2)), state)
        drift_runs.run(spark, fct, state)
    return drift_runs.read(spark, state)


def alerts_ranked_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each alert with its place in the listing."""
    alerts = Layers.from_test_tables(spark, sf_dir).drift_alerts(carry=("event_id",))
    order = [*drift.alert_order(), F.col("event_id")]  # rows of one instant are told apart by event
    return with_position(alerts, order)


QUERIES.update({
    "refresh_mart": refresh_mart_q,
    "named_tables": named_tables_q,
    "stream_ingest": stream_ingest_q,
    **{f"stream_values_{s}": _stream_values(s) for s in STREAMS},
    "replay_ingest": replay_ingest_q,
    "replay_rejects": replay_rejects_q,
    "late_data": late_data_q,
    "late_mart": late_mart_q,
    "drift_runs": drift_runs_q,
    "alerts_ranked": alerts_ranked_q,
    # G1, F8, F9 with the order as a column
    "mart_ranked": _on_layers(lambda L: with_position(L.mart, reports.listing_order())),
    "trend_ranked": _on_layers(lambda L: with_position(reports.telemetry_trend(L.fct_telemetry), [F.col("timestamp"), F.col("device_id")])),
    "breakdown_ranked": _on_layers(lambda L: with_position(reports.job_status_breakdown(L.stg("jobs")), [F.col("device_id"), F.col("status")])),
})
