"""Rule derivations of the event producers, as Column expressions (M1-M4).

The random sampling of the simulators is not rebuilt; only their deterministic
rules are, so they can derive or re-check fields of real events.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.functions.exprs import non_null

# Producer rules.
TARGET_CRYO_TEMP_MK = 15.0          # cryostat set point, mK
CRYO_STABLE_BAND_MK = 1.0           # stable when |temp - set point| < band
SLA_THRESHOLD_SECONDS = 300.0       # job SLA: total time <= threshold
SCORE_PENALTY_UNSTABLE_CRYO = 0.30
SCORE_PENALTY_CONTROL = {"degraded": 0.20, "fault": 0.50}
SCORE_PENALTY_NETWORK = {"degraded": 0.10, "down": 0.40}
ALERT_CRYO = "HIGH_CRYO_TEMP"
ALERT_CONTROL = "CONTROL_ELEC_DEGRADED"
ALERT_NETWORK = "NETWORK_LATENCY_SPIKE"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cryo_stable(temp, set_point: float = TARGET_CRYO_TEMP_MK, band: float = CRYO_STABLE_BAND_MK) -> Column:
    """M3: ``abs(temp - set_point) < band``."""
    return F.abs(_c(temp) - F.lit(set_point)) < F.lit(band)


def sla_met(total_time, threshold: float = SLA_THRESHOLD_SECONDS) -> Column:
    """M4: ``total_time <= threshold``."""
    return _c(total_time) <= F.lit(threshold)


def _penalty(status: Column, table: dict[str, float]) -> Column:
    expr = F.lit(0.0)
    for value, p in reversed(list(table.items())):
        expr = F.when(status == value, F.lit(p)).otherwise(expr)
    return expr


def health_score(stable, control, network) -> Column:
    """M1: 1.0 minus penalties for unstable cryo, control and network state; floor 0; 3 decimals."""
    score = (F.lit(1.0)
             - F.when(~_c(stable), F.lit(SCORE_PENALTY_UNSTABLE_CRYO)).otherwise(F.lit(0.0))
             - _penalty(_c(control), SCORE_PENALTY_CONTROL)
             - _penalty(_c(network), SCORE_PENALTY_NETWORK))
    return F.round(F.greatest(F.lit(0.0), score), 3)


def active_alerts(stable, control, network) -> Column:
    """M2: alert names appended by rule, in rule order (nulls dropped)."""
    return non_null(*(
        F.when(~_c(stable), F.lit(ALERT_CRYO)),
        F.when(_c(control) != "nominal", F.lit(ALERT_CONTROL)),
        F.when(_c(network) != "ok", F.lit(ALERT_NETWORK)),
    ))
