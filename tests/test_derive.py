"""Producer rules (M1-M4) on hand-made values covering every branch."""

import pytest
from pyspark.sql import functions as F

from fleetlake.functions import derive

CASES = [
    # stable, control, network, score, alerts
    (True, "nominal", "ok", 1.0, ""),
    (False, "degraded", "degraded", 0.4, "HIGH_CRYO_TEMP|CONTROL_ELEC_DEGRADED|NETWORK_LATENCY_SPIKE"),
    (False, "fault", "down", 0.0, "HIGH_CRYO_TEMP|CONTROL_ELEC_DEGRADED|NETWORK_LATENCY_SPIKE"),
    (True, "fault", "ok", 0.5, "CONTROL_ELEC_DEGRADED"),
    (True, "nominal", "down", 0.6, "NETWORK_LATENCY_SPIKE"),
    (False, "nominal", "ok", 0.7, "HIGH_CRYO_TEMP"),
]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([c[:3] for c in CASES], "stable boolean, control string, network string")
    return df.select(derive.health_score("stable", "control", "network").alias("score"),
                     F.array_join(derive.active_alerts("stable", "control", "network"), "|").alias("alerts")
                     ).collect()


def test_health_score_and_alerts(rows):
    assert [(r["score"], r["alerts"]) for r in rows] == [(c[3], c[4]) for c in CASES]


def test_cryo_stability_and_sla(spark):
    df = spark.createDataFrame([(15.0, 300.0), (15.99, 300.01), (16.0, 0.0), (14.01, 299.0)], "t double, s double")
    out = df.select(derive.cryo_stable("t").alias("c"), derive.sla_met("s").alias("m")).collect()
    assert [(r["c"], r["m"]) for r in out] == [(True, True), (True, False), (False, True), (True, True)]
