"""Rolling z-score drift: the reference's ramp + spike case, edge cases, and a
brute-force pandas check of every alert on a small fixture."""

import datetime as dt

import numpy as np
import pandas as pd

from fleetlake.operators.drift import drift_alerts, rolling_zscores
from fleetlake.plans.pipeline import Layers

SF_SMALL = "/root/testdata/sf0.001"


def _frame(spark, values_1q, values_2q):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("fez", 0, t0 + dt.timedelta(minutes=i if i < 8 else 9), f"e{i}", a, b)
            for i, (a, b) in enumerate(zip(values_1q, values_2q))]
    return spark.createDataFrame(rows, "device_id string, qubit_id int, timestamp timestamp, event_id string, "
                                       "gate_error_1q double, gate_error_2q double")


def test_ramp_and_spike_alerts_both_metrics(spark):
    v1 = [0.001 + i * 0.00001 for i in range(8)] + [0.01]
    v2 = [0.006 + i * 0.00002 for i in range(8)] + [0.06]
    out = drift_alerts(_frame(spark, v1, v2), window=8, threshold=2.5, min_history=5).collect()
    assert {r["metric"] for r in out} == {"gate_error_1q", "gate_error_2q"}
    assert all(r["device_id"] == "fez" for r in out)


def test_constant_series_never_alerts(spark):
    out = drift_alerts(_frame(spark, [0.001] * 9, [0.002] * 9), window=8, min_history=5)
    assert out.count() == 0


def test_short_history_never_alerts(spark):
    out = drift_alerts(_frame(spark, [0.001, 0.0011, 0.0012, 0.0013, 0.5],
                              [0.001, 0.0011, 0.0012, 0.0013, 0.5]), window=8, min_history=5)
    assert out.count() == 0


def test_matches_pandas_rolling_on_fixture(spark):
    fct = Layers.from_test_tables(spark, SF_SMALL).fct_telemetry
    pdf = fct.select("device_id", "qubit_id", "timestamp", "event_id", "gate_error_1q", "gate_error_2q").toPandas()
    pdf = pdf.sort_values(["device_id", "qubit_id", "timestamp", "event_id"]).reset_index(drop=True)
    want = set()
    for m in ("gate_error_1q", "gate_error_2q"):
        g = pdf.groupby(["device_id", "qubit_id"])[m]
        mean = g.transform(lambda s: s.shift(1).rolling(30, min_periods=5).mean())
        std = g.transform(lambda s: s.shift(1).rolling(30, min_periods=5).std())
        z = (pdf[m] - mean) / std.replace(0, np.nan)
        hit = pdf[z.abs() >= 2.5]
        want |= {(r.device_id, int(r.qubit_id), r.event_id, m) for r in hit.itertuples()}
    got = drift_alerts(fct, carry=("event_id",)).select("device_id", "qubit_id", "event_id", "metric").collect()
    assert {tuple(r) for r in got} == want
    assert len(want) > 0


def test_rolling_stats_exclude_current_row(spark):
    df = _frame(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], [1.0] * 6)
    r = {x["event_id"]: x for x in rolling_zscores(df, window=3, min_history=2)
         .where("metric = 'gate_error_1q'").collect()}
    assert r["e4"]["rolling_mean"] == 3.0  # mean of 2, 3, 4
    assert r["e1"]["rolling_mean"] is None  # one prior value < min_history
    assert pd.isna(r["e0"]["rolling_stddev"])


def test_blocked_plan_equals_single_window(spark):
    fct = Layers.from_test_tables(spark, SF_SMALL).fct_telemetry
    cols = ["device_id", "qubit_id", "event_id", "metric", "value", "rolling_mean", "rolling_stddev", "zscore"]
    simple = rolling_zscores(fct, carry=("event_id",)).select(*cols)
    blocked = rolling_zscores(fct, carry=("event_id",), block_rows=40, partitions=7).select(*cols)

    def norm(rows):
        return sorted(tuple(round(x, 12) if isinstance(x, float) else x for x in r) for r in rows)

    a, b = norm(simple.collect()), norm(blocked.collect())
    assert len(a) == len(b) == 2 * fct.count()
    assert a == b
