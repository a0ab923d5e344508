"""The medallion chain: raw -> silver -> gold, plus materialisation (A6), full
build with quality gate (Q4) and mart-only refresh (Q5).

``Layers`` builds every table lazily from a source of raw rows, so Catalyst sees
a whole chain (pruning columns down to the scan); ``build_all`` writes silver,
fact and mart as versioned Parquet tables (``sources.tables``) and reads them back,
which cuts the lineage and lets a lost executor recompute from the last written table.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from fleetlake.operators import aggregates as agg
from fleetlake.operators import drift as drift_op
from fleetlake.operators import quality
from fleetlake.plans import gold, incremental, silver
from fleetlake.schemas import STREAMS
from fleetlake.session import cut
from fleetlake.sources import bindings, bronze, tables
from fleetlake.sources.dimension import conformed_devices, inline_dimension

RawSource = Callable[[str], DataFrame]


class Layers:
    """Lazily built tables of one pipeline run.

    ``raw_source(stream)`` returns the typed ``raw_<stream>`` relation and
    ``dim_source()`` the device dimension.
    """

    def __init__(self, raw_source: RawSource, dim_source: Callable[[], DataFrame]):
        self._raw_source = raw_source
        self._dim_source = dim_source

    # -- constructors -----------------------------------------------------
    @classmethod
    def from_test_tables(cls, spark: SparkSession, sf_dir: str) -> "Layers":
        """Bind the supplied test tables to the streams (FIXTURES.md part B)."""
        def raw(name: str) -> DataFrame:
            spec = STREAMS[name]
            rows = bronze.as_bronze_rows(bindings.stream(spark, sf_dir, name), spec)
            return bronze.typed_projection(rows, spec, keep=("tie",))

        def dim() -> DataFrame:
            profiles = inline_dimension(spark, bindings.BINDING_PROFILES)
            return conformed_devices(bindings.device_registry(spark, sf_dir), profiles)

        return cls(raw, dim)

    @classmethod
    def from_bronze(cls, spark: SparkSession, bronze_root: str, dim: DataFrame | None = None, mixed: bool = False) -> "Layers":
        """Scan real bronze Parquet written by the ingest jobs (``mixed``: and by others, with other types)."""
        def raw(name: str) -> DataFrame:
            spec = STREAMS[name]
            scan = bronze.scan_bronze_mixed if mixed else bronze.scan_bronze
            return bronze.typed_projection(scan(spark, bronze_root, spec), spec)

        from fleetlake.sources.dimension import REFERENCE_DEVICES
        return cls(raw, lambda: dim if dim is not None else inline_dimension(spark, REFERENCE_DEVICES))

    # -- tables -----------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return self._raw_source(name)

    def stg(self, name: str) -> DataFrame:
        return silver.SILVER[name](self.raw(name))

    @cached_property
    def dim_device(self) -> DataFrame:
        return self._dim_source()

    @property
    def dim_qubit(self) -> DataFrame:
        return gold.dim_qubit(self.dim_device)

    @property
    def fct_telemetry(self) -> DataFrame:
        return gold.fct_telemetry(self.stg("telemetry"), self.dim_device)

    def daily(self, name: str) -> DataFrame:
        if name == "telemetry":
            # averages, value counts and their range bounds all read the fact: it is computed once
            return agg.telemetry_daily(cut(self.fct_telemetry.select(*agg.TELEMETRY_COLUMNS), "fact"))
        return {"calibration": agg.calibration_daily, "jobs": agg.jobs_daily,
                "health": agg.health_daily}[name](self.stg(name))

    @property
    def mart(self) -> DataFrame:
        return gold.device_reliability_mart(self.daily("telemetry"), self.daily("calibration"),
                                            self.daily("jobs"), self.daily("health"))

    def drift_alerts(self, **params) -> DataFrame:
        """Drift alerts, by the blocked plan at every size."""
        return drift_op.drift_alerts(self.fct_telemetry, **params)

    def tables(self) -> dict[str, DataFrame]:
        return {"stg_calibration": self.stg("calibration"), "device_reliability_mart": self.mart,
                "fct_telemetry": self.fct_telemetry}


# ---------------------------------------------------------------------------
# Materialisation
# ---------------------------------------------------------------------------
def materialize(spark: SparkSession, df: DataFrame, root: str, name: str,
                results: list[tuple[str, int]] | None = None) -> DataFrame:
    """``create or replace table``: a new version is written and then shown in one step; a scan of it.

    The table's checks are metrics of that write; they are added to ``results``.
    """
    checks = quality.CheckedWrite(name)
    if results is None or not checks.checks:
        return tables.replace(spark, df, root, name)
    out = tables.replace(spark, checks.prepare(df), root, name, checks.observed)
    results += checks.results()
    return out.select(*df.columns)


def build_all(spark: SparkSession, layers: Layers, root: str, run_tests: bool = True,
              register: bool = False, results: list[tuple[str, int]] | None = None,
              late_data: bool = False) -> dict[str, DataFrame]:
    """Build silver, dims, fact and mart in dependency order; then run the quality gate.

    ``register`` also exposes every written table in the catalog, in databases
    named after their layer (``silver``, ``gold``), for lookup by name. The gate's
    checks are taken while the tables are written (``results``: where to put them).
    ``late_data`` also writes the indexes and daily rows that ``plans.incremental`` needs.
    """
    out: dict[str, DataFrame] = {}
    results = [] if results is None else results

    def write(spark: SparkSession, df: DataFrame, root: str, name: str) -> DataFrame:
        return materialize(spark, df, root, name, results)

    for name in STREAMS:
        out[f"stg_{name}"] = (incremental.build_silver(spark, root, name, layers.raw(name), write=write) if late_data
                              else write(spark, layers.stg(name), root, f"stg_{name}"))
    out["dim_device"] = materialize(spark, layers.dim_device, root, "dim_device")
    out["dim_qubit"] = materialize(spark, gold.dim_qubit(out["dim_device"]), root, "dim_qubit")
    out["fct_telemetry"] = materialize(spark, gold.fct_telemetry(out["stg_telemetry"], out["dim_device"]),
                                       root, "fct_telemetry", results)
    daily = incremental.build_telemetry_daily(spark, root, out["fct_telemetry"]) if late_data else None
    out["device_reliability_mart"] = refresh_mart(spark, root, out, results=results, telemetry_daily=daily)
    if register:
        register_all(spark, root, list(out))
    if run_tests:
        quality.gate_results(results)
    return out


def register_all(spark: SparkSession, root: str, names: Sequence[str]) -> None:
    """Show the written tables by name in the databases of their layers, with their present partitions."""
    from fleetlake.sources.catalog import register_table
    for name in names:
        layer = os.path.basename(os.path.dirname(tables.table_path(root, name)))
        register_table(spark, layer, name, tables.current_path(spark, root, name))


def refresh_mart(spark: SparkSession, root: str, built: dict[str, DataFrame] | None = None,
                 quantile_strategy: str = "distributed", results: list[tuple[str, int]] | None = None,
                 telemetry_daily: DataFrame | None = None) -> DataFrame:
    """Q5: rebuild only the mart from the written silver tables and fact."""
    t = built or {n: tables.read_table(spark, root, n)
                  for n in ("fct_telemetry", "stg_calibration", "stg_jobs", "stg_health")}
    mart = gold.mart_from_layers(t["fct_telemetry"], t["stg_calibration"], t["stg_jobs"], t["stg_health"],
                                 quantile_strategy=quantile_strategy, telemetry_daily=telemetry_daily)
    return materialize(spark, mart, root, "device_reliability_mart", results)


def run_drift_detection(spark: SparkSession, root: str | None, alerts_path: str, **params) -> DataFrame:
    """Drift job: read the written fact, compute alerts (blocked plan), replace the alert set (A8) and return it as read back.

    With ``root=None`` the fact is found by name in the catalog (A10): the first
    database, alphabetically, that holds a ``fct_telemetry`` table.
    """
    from fleetlake.sources import alerts as alert_io
    if root is None:
        from fleetlake.sources.catalog import find_table
        fct = spark.table(find_table(spark, "fct_telemetry"))
    else:
        fct = tables.read_table(spark, root, "fct_telemetry")
    alert_io.write_alerts(drift_op.presentation_order(drift_op.drift_alerts(fct, **params)), alerts_path)
    return alert_io.read_alerts(spark, alerts_path)
