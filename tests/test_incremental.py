"""Late data, replay, rejects by content, drift from run to run, ranks and mixed bronze files."""

import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fleetlake.operators.drift import drift_alerts
from fleetlake.operators.ranking import with_position
from fleetlake.plans import drift_runs, incremental, ingest, silver
from fleetlake.schemas import TELEMETRY
from fleetlake.session import scratch_path
from fleetlake.sources import bronze, tables
from fleetlake.sources.alerts import to_alert_records
from fleetlake.sources.rejects import read_rejects
from fleetlake.streaming.ingest import BRONZE, REJECTS, file_messages, start_ingest

RAW = ("event_id string, device_id string, qubit_id int, T1_us double, T2_us double, gate_error_1q double, gate_error_2q double, "
       "readout_fidelity double, timestamp timestamp_ntz, event_date date, tie long")


def raw_row(key, day, tie, t1=100.0, device="d0"):
    at = dt.datetime(2024, 1, day, 12)
    return (key, device, 1, t1, 120.0, 0.001, 0.006, 0.98, at, at.date(), tie)


def files_of(root):
    path = tables.table_path(root, "stg_telemetry")
    return {os.path.join(p, f): os.path.getmtime(os.path.join(p, f)) for p, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_late_rows_rewrite_only_the_dates_they_touch(spark):
    root = scratch_path(spark, f"late-{uuid.uuid4().hex}")
    first = [raw_row(f"k{i}", 1 + i % 5, i) for i in range(50)] + [raw_row("solo", 9, 1)]
    late = [raw_row("k0", 3, 0),               # a later date: leaves day 1 for day 3
            raw_row("k1", 1, 99),              # an earlier date: nothing changes
            raw_row("k2", 3, 99, t1=111.0),    # same instant, larger tie: replaced in place
            raw_row("k7", 3, 0, t1=112.0),     # same instant, smaller tie: nothing changes
            raw_row("new", 7, 1),              # a new key on a new date
            raw_row("k3", 4, 3, t1=0.0),       # does not pass the filter
            raw_row("solo", 10, 1),            # empties day 9
            raw_row("twice", 2, 1), raw_row("twice", 2, 2, t1=113.0)]
    frame = lambda rows: spark.createDataFrame(rows, RAW)
    incremental.build_silver(spark, root, "telemetry", frame(first))
    before = files_of(root)
    dates = incremental.refresh_silver(spark, root, "telemetry", frame(late))
    assert dates == [dt.date(2024, 1, d) for d in (1, 2, 3, 7, 9, 10)]
    want = silver.stg_telemetry(frame(first + late))
    got = tables.read_table(spark, root, "stg_telemetry").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    after = files_of(root)
    kept = {p for p in before if "event_date=2024-01-04" in p or "event_date=2024-01-05" in p}
    assert kept and {p: after.get(p) for p in kept} == {p: before[p] for p in kept}  # the same files, untouched
    assert not any("event_date=2024-01-09" in p for p in after)
    # the same rows again change nothing that is read, and a second late arrival finds the moved keys by the index
    incremental.refresh_silver(spark, root, "telemetry", frame(late))
    more = [raw_row("k0", 5, 7), raw_row("solo", 2, 0)]
    incremental.refresh_silver(spark, root, "telemetry", frame(more))
    want = silver.stg_telemetry(frame(first + late + more))
    got = tables.read_table(spark, root, "stg_telemetry").select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert incremental.refresh_silver(spark, root, "telemetry", frame([])) == []


def test_late_rows_of_other_streams_keep_the_daily_rows_of_the_fact(spark, monkeypatch):
    from fleetlake.operators import aggregates
    from fleetlake.plans.pipeline import Layers, build_all
    root = scratch_path(spark, f"late-{uuid.uuid4().hex}")
    L = Layers.from_test_tables(spark, "/root/testdata/sf0.001")
    late = lambda s: F.pmod(F.xxhash64("tie"), F.lit(4)) == 0
    build_all(spark, Layers(lambda s: L.raw(s).where(~late(s)), lambda: L.dim_device), root, run_tests=False, late_data=True)
    computed, daily = [], aggregates.telemetry_daily
    monkeypatch.setattr(aggregates, "telemetry_daily", lambda *a, **kw: computed.append(1) or daily(*a, **kw))
    for s in ("jobs", "telemetry", "health"):
        incremental.refresh(spark, root, s, L.raw(s).where(late(s)))
    assert len(computed) == 1
    got = tables.read_table(spark, root, "telemetry_daily")
    want = daily(tables.read_table(spark, root, "fct_telemetry"))
    rounded = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*want.columns).collect())
    assert rounded(got) == rounded(want) and got.count() > 50


def event(i, **kv):
    return json.dumps({"event_id": f"e{i}", "device_id": "dev_0", "qubit_id": i % 4, "T1_us": 100.0, "T2_us": 120.0, "gate_error_1q": 0.001,
                       "gate_error_2q": 0.006, "readout_fidelity": 0.98, "timestamp": "2024-01-01T00:00:00Z"} | kv)


@pytest.mark.parametrize("fail_after, bronze_rows, reject_files", [(BRONZE, 20, 3), (REJECTS, 10, 6)])
def test_a_replayed_batch_repeats_only_the_write_without_a_marker(spark, scratch, fail_after, bronze_rows, reject_files):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.json"), "w") as fh:
        fh.write("\n".join([event(i) for i in range(10)] + ["{bad", "{bad", event(98, T1_us=1.0)]))
    broot, rroot, checkpoint = (os.path.join(scratch, d) for d in ("bronze", "rejects", "ckpt"))

    def fail(write):
        if write == fail_after:
            raise RuntimeError("lost")

    def start(**kw):
        return start_ingest(file_messages(spark, landing, TELEMETRY.topic), TELEMETRY, broot, rroot, checkpoint, available_now=True, **kw)

    with pytest.raises(StreamingQueryException):
        start(on_written=fail).awaitTermination()
    start().awaitTermination()
    raw = bronze.typed_projection(bronze.scan_bronze(spark, broot, TELEMETRY), TELEMETRY)
    assert raw.count() == bronze_rows and silver.stg_telemetry(raw).count() == 10
    assert spark.read.parquet(os.path.join(rroot, "telemetry")).count() == reject_files
    rejects = read_rejects(spark, rroot, TELEMETRY).collect()
    assert sorted(r.value for r in rejects) == sorted(["{bad", event(98, T1_us=1.0)])
    with open(os.path.join(checkpoint, "_batches", f"0.{REJECTS}")) as fh:
        assert fh.read() == "10 3"
    start().awaitTermination()  # nothing new: nothing written
    assert bronze.scan_bronze(spark, broot, TELEMETRY).count() == bronze_rows


@pytest.mark.parametrize("fail_after", [BRONZE, REJECTS])
def test_a_replayed_batch_is_checked_once(spark, scratch, fail_after, monkeypatch):
    from fleetlake.plans import ingest as plans_ingest
    landing, checkpoint = os.path.join(scratch, "landing"), os.path.join(scratch, "ckpt")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.json"), "w") as fh:
        fh.write("\n".join([event(1), "{bad"]))
    checks, validate = [], plans_ingest.validate
    monkeypatch.setattr(plans_ingest, "validate", lambda *a, **kw: checks.append(1) or validate(*a, **kw))

    def fail(write):
        if write == fail_after:
            raise RuntimeError("lost")

    for on_written in (fail, lambda write: None):
        q = start_ingest(file_messages(spark, landing, TELEMETRY.topic), TELEMETRY, os.path.join(scratch, "b"), os.path.join(scratch, "r"),
                         checkpoint, available_now=True, on_written=on_written)
        if on_written is fail:
            with pytest.raises(StreamingQueryException):
                q.awaitTermination()
            assert len(read_rejects(spark, os.path.join(scratch, "r"), TELEMETRY).collect()) == (fail_after == REJECTS)
    q.awaitTermination()
    assert len(checks) == 1
    assert [r.value for r in read_rejects(spark, os.path.join(scratch, "r"), TELEMETRY).collect()] == ["{bad"]
    assert not os.path.exists(os.path.join(checkpoint, "_batches", "0.rows"))  # gone with the batch


def test_no_rejects_no_second_write(spark, scratch):
    from fleetlake.streaming.ingest import ingest_batch
    msgs = spark.createDataFrame([(event(i), "t") for i in range(5)], "value string, topic string")
    writes = []
    got = ingest_batch(msgs, TELEMETRY, os.path.join(scratch, "b"), os.path.join(scratch, "r"), on_written=writes.append)
    assert got == (5, 0) and writes == [BRONZE]
    assert ingest_batch(msgs.limit(0), TELEMETRY, os.path.join(scratch, "b"), os.path.join(scratch, "r")) == (0, 0)
    assert read_rejects(spark, os.path.join(scratch, "r"), TELEMETRY).count() == 0


def series(spark, days, seed=0):
    rows = [(f"d{i % 2}", i % 3, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), f"e{i:05d}", (dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)).date(),
             0.001 + 0.0001 * ((i * 7 + seed) % 11) + (0.05 if i % 97 == 0 else 0.0), None if i % 13 == 0 else 0.005 + 0.0001 * (i % 5))
            for i in range(24 * days)]
    return spark.createDataFrame(rows, "device_id string, qubit_id int, timestamp timestamp_ntz, event_id string, event_date date, "
                                       "gate_error_1q double, gate_error_2q double")


def alerts_of(df):
    return sorted(tuple(round(x, 12) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_drift_from_run_to_run_equals_one_run(spark):
    state = scratch_path(spark, f"drift-{uuid.uuid4().hex}")
    fct = series(spark, 40)
    want = alerts_of(to_alert_records(drift_alerts(fct)))
    assert want and drift_runs.read(spark, state).count() == 0
    for upto in (3, 4, 17, 40):
        drift_runs.run(spark, fct.where(F.col("event_date") < dt.date(2024, 1, 1) + dt.timedelta(days=upto)), state)
    assert alerts_of(drift_runs.read(spark, state)) == want
    drift_runs.run(spark, fct, state)  # no new dates
    assert alerts_of(drift_runs.read(spark, state)) == want
    # late data changes day 10: run again from there on
    changed = fct.where("event_date <> date'2024-01-10'").unionByName(series(spark, 40, seed=5).where("event_date = date'2024-01-10'"))
    drift_runs.run(spark, changed, state, since=dt.date(2024, 1, 10))
    assert alerts_of(drift_runs.read(spark, state)) == alerts_of(to_alert_records(drift_alerts(changed)))


def test_positions_are_a_global_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("b")).repartition(7)
    got = with_position(df, [F.col("b").desc(), F.col("a").asc()]).orderBy("position").collect()
    assert [r.position for r in got] == list(range(1, 1001))
    key = lambda r: (r.b is None, -(r.b or 0), r.a)  # noqa: E731 -- descending puts nulls last
    assert got == sorted(got, key=key)
    assert with_position(df.limit(0), [F.col("a")]).count() == 0


def test_bronze_files_of_other_types_are_united_by_name(spark, scratch):
    msgs = spark.createDataFrame([(event(i),) for i in range(6)], "value string")
    valid = ingest.split(msgs, TELEMETRY).valid
    path = os.path.join(scratch, "telemetry")

    def other(rows, **types):
        cast = rows.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in rows.columns])
        cast.write.mode("append").partitionBy("date", "device_id").parquet(path)

    bronze.write_bronze(valid.where("event_id in ('e0', 'e1')"), scratch, TELEMETRY)
    other(valid.where("event_id = 'e2'"), qubit_id="long")
    other(valid.where("event_id = 'e3'"), T1_us="long", qubit_id="decimal(10,2)")
    other(valid.where("event_id = 'e4'").drop("readout_fidelity"), T2_us="float")
    other(valid.where("event_id = 'e5'"), gate_error_1q="string")
    raw = bronze.typed_projection(bronze.scan_bronze_mixed(spark, scratch, TELEMETRY), TELEMETRY)
    want = {r.event_id: r for r in bronze.typed_projection(bronze.as_bronze_rows(valid.drop("date", "_ingested_at", "_source_topic"), TELEMETRY), TELEMETRY).collect()}
    got = {r.event_id: r for r in raw.collect()}
    assert set(got) == set(want)
    for k, r in got.items():
        for c in TELEMETRY.names:
            assert r[c] == (None if (k, c) == ("e4", "readout_fidelity") else want[k][c]), (k, c)
    assert dict(raw.dtypes) == dict(bronze.typed_projection(bronze.scan_bronze(spark, scratch, TELEMETRY), TELEMETRY).dtypes)
    assert bronze.scan_bronze_mixed(spark, scratch, TELEMETRY).where("device_id = 'dev_0'").count() == 6
