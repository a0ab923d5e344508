"""Inline dimension source (A7): small declared tables built with an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.schemas import DIM_DEVICE

# The reference fleet's device dimension (id, qubits, backend version,
# region, baseline T1, T2, 1q error, 2q error, readout fidelity).
REFERENCE_DEVICES = [
    ("ibm_fez", 127, "1.3.2", "us-east", 180.0, 120.0, 0.0008, 0.0060, 0.985),
    ("ibm_torino", 133, "2.0.1", "eu-west", 210.0, 150.0, 0.0006, 0.0050, 0.990),
    ("ibm_kyiv", 127, "1.2.8", "us-south", 160.0, 100.0, 0.0010, 0.0080, 0.978),
    ("ibm_osaka", 127, "1.4.0", "ap-northeast", 195.0, 130.0, 0.0007, 0.0055, 0.987),
]


def inline_dimension(spark: SparkSession, rows: Sequence[tuple], schema=DIM_DEVICE) -> DataFrame:
    """A declared dimension table (one local relation; it never grows with the facts)."""
    return spark.createDataFrame(list(rows), schema)


def conformed_devices(registry: DataFrame, profiles: DataFrame) -> DataFrame:
    """Devices seen in the fleet registry, with their declared profile where one exists."""
    prof = profiles.drop("device_id").columns
    return (registry.select("device_id").distinct()
            .join(F.broadcast(profiles), "device_id", "left")
            .select("device_id", *prof))
