"""The ingestion queries: the whole job is done, in bounded batches whose files go when they are done."""

import os

import pytest
from pyspark.sql import functions as F

from fleetlake.plans import ingest as plans_ingest
from fleetlake.plans import registry
from fleetlake.schemas import STREAMS, TELEMETRY
from fleetlake.sources import bronze, events, files
from fleetlake.sources.rejects import read_rejects, scan_rejects, write_rejects
from fleetlake.streaming import ingest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def root(monkeypatch, scratch):
    """The queries' scratch folder, with landed files of 500 messages and batches of one file."""
    monkeypatch.setattr(registry, "scratch_path", lambda spark, name: os.path.join(scratch, "q"))
    monkeypatch.setattr(events, "LANDED", 500, raising=False)
    monkeypatch.setattr(registry, "BATCH_BYTES", 1, raising=False)
    return os.path.join(scratch, "q")


def all_files(where):
    return [os.path.join(d, f) for d, _, fs in os.walk(where) for f in fs if f.startswith("part-")]


def test_ingest_batch_writes_bronze_and_rejects(spark, root):
    got = {r.stream: (r.accepted, r.rejected) for r in registry.QUERIES["ingest_batch"](spark, SF).collect()}
    assert set(got) == set(STREAMS)
    for name, spec in STREAMS.items():
        want = registry.QUERIES[f"contract_{name}"](spark, SF)
        assert got[name] == (want.where("violations = ''").count(), want.where("violations <> ''").count())
        rows = bronze.scan_bronze(spark, f"{root}/bronze", spec)
        assert rows.where("_ingested_at is not null and _source_topic is not null").count() == got[name][0]
        assert rows.where(F.col("date") != F.to_date("timestamp")).count() == 0
        assert scan_rejects(spark, f"{root}/rejects", spec).where("value is not null and size(_violations) > 0").count() == got[name][1]
    assert not all_files(f"{root}/landing")


def test_ingest_batch_of_empty_tables(spark, root, scratch):
    for t in ("lineitem", "orders", "events", "customer"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{scratch}/empty/{t}.parquet")
    got = registry.QUERIES["ingest_batch"](spark, f"{scratch}/empty").collect()
    assert {tuple(r) for r in got} == {(s, 0, 0) for s in STREAMS}


def test_landed_files_are_compressed_and_small(spark, scratch, monkeypatch):
    monkeypatch.setattr(events, "LANDED", 500)
    msgs = registry._messages(spark, SF, "telemetry")
    events.land_events(msgs, f"{scratch}/landing")
    landed = all_files(f"{scratch}/landing")
    plain = msgs.agg(F.sum(F.octet_length("value"))).first()[0]
    assert len(landed) >= msgs.count() / 500 and sum(map(os.path.getsize, landed)) < plain / 3
    back = events.text_events(spark, [p for p, _ in files.data_files(spark, f"{scratch}/landing")], "t")
    assert back.select("value").exceptAll(msgs.select("value")).count() == 0 and back.count() == msgs.count()


def test_files_are_ingested_a_batch_at_a_time(spark, scratch, monkeypatch):
    monkeypatch.setattr(events, "LANDED", 500)
    events.land_events(registry._messages(spark, SF, "telemetry"), f"{scratch}/landing")
    landed, left, one = files.data_files(spark, f"{scratch}/landing"), [], ingest.ingest_batch
    monkeypatch.setattr(ingest, "ingest_batch", lambda *a, **kw: left.append(len(all_files(f"{scratch}/landing"))) or one(*a, **kw))
    got = ingest.ingest_files(spark, f"{scratch}/landing", TELEMETRY, f"{scratch}/b", f"{scratch}/r", batch_bytes=2 * max(n for _, n in landed), clean=True)
    assert len(left) > 2 and left == sorted(left, reverse=True) and left[-1] <= 3 and not all_files(f"{scratch}/landing")
    assert got == (bronze.scan_bronze(spark, f"{scratch}/b", TELEMETRY).count(), scan_rejects(spark, f"{scratch}/r", TELEMETRY).count())
    assert sum(got) == registry._messages(spark, SF, "telemetry").count()


def test_a_batch_frees_its_shuffle_files(spark, scratch, monkeypatch):
    freed = []
    monkeypatch.setattr(ingest, "free_shuffles", lambda s: freed.append(len(all_files(f"{scratch}/b"))))
    msgs = registry._messages(spark, SF, "health").select("value", "topic")
    ingest.ingest_batch(msgs, STREAMS["health"], f"{scratch}/b", f"{scratch}/r")
    assert len(freed) == 1 and freed[0] > 0  # when bronze is written


def test_a_stream_runs_in_bounded_batches(spark, root, monkeypatch):
    left, one = [], ingest.ingest_batch
    monkeypatch.setattr(ingest, "ingest_batch", lambda *a, **kw: left.append(len(all_files(f"{root}/landing"))) or one(*a, **kw))
    got = registry.QUERIES["stream_ingest"](spark, SF).agg(F.sum("rows")).first()[0]
    want = registry.QUERIES["contract_telemetry"](spark, SF).where("violations = ''").count()
    assert got == want and len(left) > 5
    assert left[-1] < left[0] and not all_files(f"{root}/landing")  # files of finished batches go


def test_every_batch_is_replayed(spark, root, monkeypatch):
    batches, one = [], ingest.ingest_batch
    monkeypatch.setattr(ingest, "ingest_batch", lambda *a, **kw: batches.append(a[4].stem) or one(*a, **kw))
    got = registry.QUERIES["replay_ingest"](spark, SF)
    accepted = registry.QUERIES["contract_telemetry"](spark, SF).where("violations = ''")
    assert len(batches) == 2 * len(set(batches)) > 10
    assert registry._bronze_rows(spark, root, "telemetry").count() == 2 * accepted.count()
    want = registry.QUERIES["stg_telemetry"](spark, SF).columns
    assert got.columns == want and got.count() == got.select("event_id").distinct().count() == accepted.select("event_id").distinct().count()


def test_replayed_rejects_of_many_batches_count_once(spark, root, monkeypatch):
    roots = iter("abcd")
    monkeypatch.setattr(registry, "scratch_path", lambda spark, name: f"{root}-{next(roots)}")
    got = {tuple(r) for r in registry.QUERIES["replay_rejects"](spark, SF).select("stream", "rule", "rejected").collect()}
    want = registry.QUERIES["reject_summary"](spark, SF).select("stream", "rule", "rejected")
    assert got == {tuple(r) for r in want.collect()}
    written = scan_rejects(spark, f"{root}-a/rejects", TELEMETRY).count()
    assert written == 2 * read_rejects(spark, f"{root}-a/rejects", TELEMETRY).count() > 0


def test_a_failure_that_was_not_asked_for_is_raised(spark, root, monkeypatch):
    def broken(*a, **kw):
        raise RuntimeError("no space")
    monkeypatch.setattr(bronze, "write_bronze", broken)
    with pytest.raises(Exception, match="no space"):
        registry.QUERIES["replay_ingest"](spark, SF)


def test_a_summary_of_rejects_does_not_read_the_messages(spark, scratch):
    from tools.plan_audit import plan_text
    rows = spark.createDataFrame([("{bad", "t", ["unparsable_json"]), (None, "t", ["unparsable_json"])] * 2, "value string, topic string, _violations array<string>")
    write_rejects(rows, scratch, TELEMETRY)
    rejects = read_rejects(spark, scratch, TELEMETRY)
    assert sorted((r.value or "", r.topic, r._violations) for r in rejects.collect()) == [("", "t", ["unparsable_json"]), ("{bad", "t", ["unparsable_json"])]
    scans = [x for x in plan_text(plans_ingest.reject_summary(rejects)).splitlines() if x.startswith("ReadSchema")]
    assert scans and not any("value" in x for x in scans)
