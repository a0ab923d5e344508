"""Dashboard reports on hand-made mart rows."""

import datetime as dt

from fleetlake.plans import reports

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
SCHEMA = "device_id string, date date, avg_T1_us double, min_readout_fidelity double, job_sla_pct double"


def _mart(spark):
    return spark.createDataFrame([("a", D1, 100.0, 0.90, 50.0), ("a", D2, 200.0, 0.95, 100.0),
                                  ("b", D1, 300.0, 0.80, 80.0)], SCHEMA)


def test_latest_day_per_device(spark):
    got = sorted((r["device_id"], r["date"]) for r in reports.latest_per_device(_mart(spark)).collect())
    assert got == [("a", D2), ("b", D1)]


def test_fleet_kpis_use_each_devices_latest_day(spark):
    r = reports.fleet_kpis(_mart(spark)).collect()[0]
    assert (r["devices"], r["avg_T1_us"], r["min_readout_fidelity"], r["job_sla_pct"]) == (2, 250.0, 0.80, 90.0)


def test_mart_listing_newest_first_then_device(spark):
    got = [(r["date"], r["device_id"]) for r in reports.mart_listing(_mart(spark)).collect()]
    assert got == [(D2, "a"), (D1, "a"), (D1, "b")]
