"""Drift-alert sink and source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.timestamps import alert_text
from fleetlake.schemas import DRIFT_ALERT


def to_alert_records(alerts: DataFrame) -> DataFrame:
    """The 8 alert fields, with the event time printed as text (as the detector reports it)."""
    cols = []
    for f in DRIFT_ALERT.fields:
        c = F.col(f.name)
        if f.name == "timestamp" and dict(alerts.dtypes)[f.name].startswith("timestamp"):
            c = alert_text(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return alerts.select(*cols)


def write_alerts(alerts: DataFrame, path: str) -> None:
    """Replace the whole alert set with JSON lines (one object per alert)."""
    to_alert_records(alerts).write.mode("overwrite").json(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Read alerts with the declared schema; an empty frame of that schema if absent."""
    try:
        return spark.read.schema(DRIFT_ALERT).json(path)
    except Exception as e:  # noqa: BLE001 -- only a missing path falls back
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return spark.createDataFrame([], DRIFT_ALERT)
        raise
