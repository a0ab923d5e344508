"""Bronze sink/scan, alerts sink/source, table lookup, and the streaming ingest
driver on a file source (replay, late data, bad records)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fleetlake.plans import ingest, silver
from fleetlake.schemas import DRIFT_ALERT, TELEMETRY
from fleetlake.sources import alerts as alert_io
from fleetlake.sources import bronze
from fleetlake.sources.catalog import TableNotFound, find_table
from fleetlake.streaming.ingest import file_messages, start_ingest


def _event(i, device="dev_0", ts="2024-01-01T00:00:00Z", **kv):
    d = {"event_id": f"e{i}", "device_id": device, "qubit_id": i % 4, "T1_us": 100.0, "T2_us": 120.0,
         "gate_error_1q": 0.001, "gate_error_2q": 0.006, "readout_fidelity": 0.98, "timestamp": ts}
    d.update(kv)
    return json.dumps(d)


def test_bronze_roundtrip_keeps_partition_strings(spark, scratch):
    msgs = spark.createDataFrame([(_event(1, device="007"),), (_event(2, ts="2023-12-01T10:00:00Z"),)],
                                 "value string")
    valid = ingest.split(msgs, TELEMETRY).valid
    bronze.write_bronze(valid, scratch, TELEMETRY)
    dirs = sorted(os.listdir(os.path.join(scratch, "telemetry")))
    assert "date=2023-12-01" in dirs and "date=2024-01-01" in dirs
    raw = bronze.typed_projection(bronze.scan_bronze(spark, scratch, TELEMETRY), TELEMETRY)
    got = {(r["device_id"], r["event_date"].isoformat()) for r in raw.collect()}
    assert got == {("007", "2024-01-01"), ("dev_0", "2023-12-01")}
    assert dict(raw.dtypes)["device_id"] == "string"
    # appends never overwrite
    bronze.write_bronze(valid, scratch, TELEMETRY)
    assert bronze.scan_bronze(spark, scratch, TELEMETRY).count() == 4


def test_alerts_roundtrip_and_missing_path(spark, scratch):
    missing = alert_io.read_alerts(spark, os.path.join(scratch, "nope"))
    assert missing.count() == 0 and missing.schema == DRIFT_ALERT
    rows = spark.createDataFrame([("d", 1, "2024-01-01 00:00:00+00:00", "gate_error_1q", 0.5, 0.1, 0.01, 40.0)],
                                 DRIFT_ALERT)
    path = os.path.join(scratch, "alerts")
    alert_io.write_alerts(rows, path)
    assert alert_io.read_alerts(spark, path).collect() == rows.collect()


def test_find_table(spark, scratch):
    spark.sql("create database if not exists zz_gold")
    spark.sql("create database if not exists aa_gold")
    spark.range(3).write.mode("overwrite").saveAsTable("zz_gold.lookup_me")
    spark.range(3).write.mode("overwrite").saveAsTable("aa_gold.lookup_me")
    assert find_table(spark, "lookup_me") == "`aa_gold`.`lookup_me`"
    with pytest.raises(TableNotFound):
        find_table(spark, "no_such_table")
    assert find_table(spark, "no_such_table", strict=False) == "no_such_table"


def test_streaming_ingest_replay_late_and_bad(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    batch = [_event(i) for i in range(10)] + ["{bad", _event(99, T1_us=1.0)]
    with open(os.path.join(landing, "b1.json"), "w") as fh:
        fh.write("\n".join(batch))
    # the same batch again (a replay after a failed commit) and a month-late event
    with open(os.path.join(landing, "b2.json"), "w") as fh:
        fh.write("\n".join(batch[:10] + [_event(50, ts="2023-12-01T00:00:00Z")]))
    broot, rroot = os.path.join(scratch, "bronze"), os.path.join(scratch, "rejects")
    q = start_ingest(file_messages(spark, landing, TELEMETRY.topic, max_files_per_trigger=1), TELEMETRY,
                     broot, rroot, os.path.join(scratch, "ckpt"), available_now=True)
    q.awaitTermination(120)
    raw = bronze.typed_projection(bronze.scan_bronze(spark, broot, TELEMETRY), TELEMETRY)
    assert raw.count() == 21  # 10 + 10 replayed + 1 late
    assert raw.where(F.col("event_date") == "2023-12-01").count() == 1
    stg = silver.stg_telemetry(raw.withColumn("tie", F.lit(0)))
    assert stg.count() == 11  # replays collapse
    rej = spark.read.parquet(os.path.join(rroot, "telemetry"))
    assert rej.count() == 2
    assert {v for r in rej.collect() for v in r["_violations"]} >= {"unparsable_json", "minimum:T1_us"}
    assert raw.select("_source_topic").distinct().collect()[0][0] == TELEMETRY.topic


def test_event_date_filter_prunes_bronze_partitions(spark, scratch):
    from tools.plan_audit import plan_text
    msgs = spark.createDataFrame([(_event(1),), (_event(2, ts="2023-12-01T10:00:00Z"),)], "value string")
    bronze.write_bronze(ingest.split(msgs, TELEMETRY).valid, scratch, TELEMETRY)
    raw = bronze.typed_projection(bronze.scan_bronze(spark, scratch, TELEMETRY), TELEMETRY)
    q = raw.where(F.col("event_date") == F.lit("2023-12-01").cast("date"))
    text = plan_text(q)
    pf = [line for line in text.splitlines() if line.startswith("PartitionFilters")]
    assert pf and "date" in pf[0] and "2023-12-01" in pf[0]
    assert q.count() == 1


def test_continuous_ingest_picks_up_new_files(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    broot, rroot = os.path.join(scratch, "bronze"), os.path.join(scratch, "rejects")
    q = start_ingest(file_messages(spark, landing, TELEMETRY.topic), TELEMETRY, broot, rroot,
                     os.path.join(scratch, "ckpt"), processing_time="1 second")
    try:
        for n, name in ((3, "a.json"), (4, "b.json")):
            with open(os.path.join(landing, name), "w") as fh:
                fh.write("\n".join(_event(i + 10 * n) for i in range(n)))
            q.processAllAvailable()
        assert bronze.scan_bronze(spark, broot, TELEMETRY).count() == 7
        assert q.lastProgress is not None
    finally:
        q.stop()


def test_continuous_ingest_from_a_producing_stream(spark, scratch):
    """A stand-in for a Kafka topic: Spark's rate source produces telemetry JSON
    continuously (every 7th event violates T2 <= 2*T1); the same driver ingests it."""
    src = spark.readStream.format("rate").option("rowsPerSecond", 40).load()
    v = F.col("value")
    events = src.select(
        F.concat(F.lit("dev_"), (v % 4).cast("string")).alias("key"),
        F.to_json(F.struct(
            F.concat(F.lit("e-"), v.cast("string")).alias("event_id"),
            F.concat(F.lit("dev_"), (v % 4).cast("string")).alias("device_id"),
            (v % 16).cast("int").alias("qubit_id"),
            F.lit(100.0).alias("T1_us"),
            F.when(v % 7 == 0, F.lit(250.0)).otherwise(F.lit(120.0)).alias("T2_us"),
            F.lit(0.001).alias("gate_error_1q"), F.lit(0.006).alias("gate_error_2q"),
            F.lit(0.98).alias("readout_fidelity"),
            F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        )).alias("value"),
        F.lit(TELEMETRY.topic).alias("topic"))
    broot, rroot = os.path.join(scratch, "bronze"), os.path.join(scratch, "rejects")
    q = start_ingest(events, TELEMETRY, broot, rroot, os.path.join(scratch, "ckpt"), processing_time="1 second")
    try:
        import time
        deadline = time.time() + 60
        while time.time() < deadline and (q.lastProgress is None or q.lastProgress["batchId"] < 3):
            time.sleep(0.5)
        assert q.isActive and q.exception() is None
    finally:
        q.stop()
    good = bronze.scan_bronze(spark, broot, TELEMETRY).count()
    bad = spark.read.parquet(os.path.join(rroot, "telemetry"))
    assert good > 0 and bad.count() > 0
    assert {v for r in bad.collect() for v in r["_violations"]} == {"t2_exceeds_2x_t1"}


def test_bronze_scan_unions_files_by_name(spark, scratch):
    # an older file without readout_fidelity next to a current one
    msgs = spark.createDataFrame([(_event(1),), (_event(2),)], "value string")
    valid = ingest.split(msgs, TELEMETRY).valid
    old = valid.where("event_id = 'e1'").drop("readout_fidelity")
    old.write.mode("append").partitionBy("date", "device_id").parquet(os.path.join(scratch, "telemetry"))
    bronze.write_bronze(valid.where("event_id = 'e2'"), scratch, TELEMETRY)
    raw = bronze.typed_projection(bronze.scan_bronze(spark, scratch, TELEMETRY), TELEMETRY)
    got = {r["event_id"]: r["readout_fidelity"] for r in raw.collect()}
    assert got == {"e1": None, "e2": 0.98}


def test_bronze_sink_writes_few_files_per_partition(spark, scratch):
    from fleetlake.sources import bindings
    from fleetlake.sources.events import encode_events
    valid = ingest.split(encode_events(bindings.stream(spark, "/root/testdata/sf0.001", "telemetry"), TELEMETRY),
                         TELEMETRY).valid
    bronze.write_bronze(valid, scratch, TELEMETRY)
    per_dir = [sum(f.endswith(".parquet") for f in fs) for _, _, fs in os.walk(os.path.join(scratch, "telemetry"))]
    per_dir = [n for n in per_dir if n]
    assert len(per_dir) > 50 and max(per_dir) <= 2
