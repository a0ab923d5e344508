"""Full build with the quality gate, and the mart-only refresh."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import quality
from fleetlake.plans.pipeline import Layers, build_all, refresh_mart, run_drift_detection
from fleetlake.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_build_all_and_refresh(spark):
    root = scratch_path(spark, f"build-test-{uuid.uuid4().hex}")
    out = build_all(spark, Layers.from_test_tables(spark, SF), root)
    first = sorted(map(tuple, out["device_reliability_mart"].collect()))
    assert len(first) > 0
    assert sorted(map(tuple, refresh_mart(spark, root).collect())) == first
    distributed = refresh_mart(spark, root, quantile_strategy="distributed")
    assert sorted(map(tuple, distributed.collect())) == first
    alerts = run_drift_detection(spark, root, scratch_path(spark, f"alerts-test-{uuid.uuid4().hex}"))
    assert alerts.count() == Layers.from_test_tables(spark, SF).drift_alerts().count()


def test_gate_raises_on_violations(spark):
    layers = Layers.from_test_tables(spark, SF)
    report = quality.run_checks(spark, {"dup_raw_runs": quality.duplicate_keys(layers.raw("telemetry"), "event_id")})
    with pytest.raises(quality.QualityGateError):
        quality.gate(report)


def test_end_to_end_from_bronze(spark):
    """Bound streams -> JSON messages -> contract -> bronze -> silver/gold -> mart and alerts."""
    from fleetlake.plans import ingest
    from fleetlake.schemas import STREAMS
    from fleetlake.sources import bindings, bronze
    from fleetlake.sources.events import encode_events

    root = scratch_path(spark, f"e2e-{uuid.uuid4().hex}")
    broot = f"{root}/bronze"
    for name, spec in STREAMS.items():
        out = ingest.split(encode_events(bindings.stream(spark, SF, name), spec), spec)
        bronze.write_bronze(out.valid, broot, spec)
        out.release()
    dim = Layers.from_test_tables(spark, SF).dim_device
    layers = Layers.from_bronze(spark, broot, dim=dim)
    assert dict(layers.raw("telemetry").dtypes)["timestamp"] == "timestamp"
    built = build_all(spark, layers, f"{root}/tables")
    mart = built["device_reliability_mart"]
    assert mart.count() > 0
    assert mart.where("device_id is null").count() == 0
    # ingest rejected T2 > 2*T1 rows, so every fact row is physically valid
    fct = built["fct_telemetry"]
    assert fct.where("T2_us > 2 * T1_us").count() == 0
    assert run_drift_detection(spark, f"{root}/tables", f"{root}/alerts").count() >= 0


def test_registered_tables_and_lookup_by_name(spark):
    from fleetlake.plans.pipeline import register_all
    from fleetlake.sources import tables
    from fleetlake.sources.catalog import find_table
    root = scratch_path(spark, f"catalog-{uuid.uuid4().hex}")
    layers = Layers.from_test_tables(spark, SF)
    built = build_all(spark, layers, root, register=True)
    assert find_table(spark, "fct_telemetry") == "`gold`.`fct_telemetry`"
    assert find_table(spark, "stg_jobs") == "`silver`.`stg_jobs`"
    want = {n: df.count() for n, df in built.items()}
    assert all(want.values()) and {n: spark.table(find_table(spark, n)).count() for n in built} == want
    alerts = run_drift_detection(spark, None, scratch_path(spark, f"alerts-{uuid.uuid4().hex}"))
    assert alerts.count() == layers.drift_alerts().count()

    # a second build shows its own version, and tables of earlier versions are gone from the catalog
    build_all(spark, Layers(lambda s: layers.raw(s).where("device_id <> 'dev_0'"), lambda: layers.dim_device), root, register=True)
    fact = spark.table("gold.fct_telemetry")
    assert 0 < fact.count() < want["fct_telemetry"] and fact.where("device_id = 'dev_0'").isEmpty()
    assert len([t for t in spark.catalog.listTables("gold") if t.name.startswith("fct_telemetry__")]) == 1

    # dates that come and go within a version
    dates = [r[0] for r in fact.select("event_date").distinct().orderBy("event_date").collect()]
    moved = tables.of_dates(fact, dates[:1]).withColumn("event_date", F.lit("2031-01-01").cast("date"))
    gone = fact.where(F.col("event_date") == dates[0]).count()
    tables.replace_dates(spark, moved.select(*fact.columns), root, "fct_telemetry", [dates[0], dt.date(2031, 1, 1)])
    register_all(spark, root, ["fct_telemetry"])
    now = spark.table("gold.fct_telemetry")
    assert now.where(F.col("event_date") == dates[0]).count() == 0
    assert now.where("event_date = date'2031-01-01'").count() == gone


def test_a_failed_build_leaves_the_old_table(spark):
    from fleetlake.sources import files, tables
    root = scratch_path(spark, f"versions-{uuid.uuid4().hex}")
    tables.replace(spark, spark.range(10).withColumn("event_date", F.lit("2024-01-01").cast("date")), root, "stg_x")
    held = tables.read_table(spark, root, "stg_x")  # a reader that is still at it
    broken = spark.range(20).select(F.when(F.col("id") < 19, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).cast("long").alias("id"),
                                    F.lit("2024-01-02").cast("date").alias("event_date"))
    with pytest.raises(Exception, match="broken"):
        tables.replace(spark, broken, root, "stg_x")
    assert tables.read_table(spark, root, "stg_x").count() == 10
    versions = [f for f in files.folders(spark, tables.table_path(root, "stg_x")) if f.startswith("v")]
    assert len(versions) == 1  # what the failed build wrote is gone
    tables.replace(spark, spark.range(3).withColumn("event_date", F.lit("2024-01-01").cast("date")), root, "stg_x")
    assert tables.read_table(spark, root, "stg_x").count() == 3 and held.count() == 10
    with pytest.raises(tables.TableMissing):
        tables.read_table(spark, root, "stg_y")


def test_checks_are_metrics_of_the_write(spark):
    from fleetlake.plans.pipeline import materialize
    root, results = scratch_path(spark, f"checks-{uuid.uuid4().hex}"), []
    day = F.lit("2024-01-01").cast("date")
    runs = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("c",), ("c",)], "run_id string").withColumn("event_date", day)
    out = materialize(spark, runs, root, "stg_calibration", results)
    assert out.columns == ["run_id", "event_date"] and out.count() == 6
    materialize(spark, spark.createDataFrame([(0.4,), (0.5,), (1.0,), (1.1,), (None,)], "readout_fidelity double").withColumn("event_date", day),
                root, "fct_telemetry", results)
    materialize(spark, spark.createDataFrame([(None,), ("d",)], "device_id string"), root, "device_reliability_mart", results)
    assert dict(results) == {"no_duplicate_calibration_runs": 2, "valid_fidelity_range": 2, "not_null_device_id": 1}
    with pytest.raises(quality.QualityGateError):
        quality.gate_results(results)
