"""Data-quality checks (Q1-Q4): each check returns its violating rows; a pass is
zero rows. ``run_checks`` counts them in one job and ``gate`` raises on failure."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Q1: keys occurring more than once, with their row count (map-side combined)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q2: rows whose ``column`` is null."""
    return df.where(F.col(column).isNull())


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Q3: rows with ``column`` below ``low`` or above ``high`` (nulls are not violations)."""
    return df.where((F.col(column) < low) | (F.col(column) > high))


class QualityGateError(RuntimeError):
    pass


def run_checks(spark: SparkSession, checks: Mapping[str, DataFrame]) -> DataFrame:
    """Q4: one row per check with its violation count, as one union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
             for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(report: DataFrame) -> list[tuple[str, int]]:
    """Raise ``QualityGateError`` when any check has violations (the report is tiny)."""
    return gate_results([(r["check"], int(r["violations"])) for r in report.collect()])


def gate_results(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The gate on (check, violations) at hand."""
    failed = [(c, n) for c, n in rows if n > 0]
    if failed:
        raise QualityGateError(f"data-quality checks failed: {failed}")
    return rows


CheckFactory = Callable[[Mapping[str, DataFrame]], DataFrame]

# The reference's three data tests, by table name.
STANDARD_CHECKS: dict[str, CheckFactory] = {
    "no_duplicate_calibration_runs": lambda t: duplicate_keys(t["stg_calibration"], "run_id"),
    "not_null_device_id": lambda t: not_null(t["device_reliability_mart"], "device_id"),
    "valid_fidelity_range": lambda t: out_of_range(t["fct_telemetry"], "readout_fidelity", 0.5, 1.0),
}


# ---------------------------------------------------------------------------
# The same checks as metrics of a table's own write: no written table is read again.
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class WriteCheck:
    """One check of a table: the SQL of a metric over its rows, and the key whose repeats it counts, if it does."""

    metric: str
    key: str | None = None


HELPER = "_second_of_key"


def with_second_of_key(df: DataFrame, key: str) -> DataFrame:
    """Marks the second row of every key, so that marked rows count the keys that occur more than once.

    A table that comes out of the per-key dedup is dealt by the key already, so this sorts and shuffles nothing anew.
    """
    return df.withColumn(HELPER, F.row_number().over(Window.partitionBy(key).orderBy(key)) == 2)


WRITE_CHECKS: dict[str, dict[str, WriteCheck]] = {
    "stg_calibration": {"no_duplicate_calibration_runs": WriteCheck(f"count_if({HELPER})", "run_id")},
    "device_reliability_mart": {"not_null_device_id": WriteCheck("count_if(device_id is null)")},
    "fct_telemetry": {"valid_fidelity_range": WriteCheck("count_if(readout_fidelity < 0.5 or readout_fidelity > 1.0)")},
}


def observed_counts(seen: Observation, names: Sequence[str]) -> dict[str, int]:
    """Counts that an observation took. A plan known to be empty has its metrics pruned away: all are 0 then."""
    if seen._jo.getRow().length() == 0:
        return dict.fromkeys(names, 0)
    return {name: int(seen.get[name] or 0) for name in names}


class CheckedWrite:
    """Takes a table's checks while it is written: ``prepare`` the frame, ``observed`` it in the writing tasks, then ``results``."""

    def __init__(self, table: str, checks: Mapping[str, Mapping[str, WriteCheck]] = WRITE_CHECKS):
        self.checks, self.seen = checks.get(table, {}), Observation()

    def prepare(self, df: DataFrame) -> DataFrame:
        for check in self.checks.values():
            df = with_second_of_key(df, check.key) if check.key else df
        return df

    def observed(self, df: DataFrame) -> DataFrame:
        if not self.checks:
            return df
        helpers = [c for c in df.columns if c == HELPER]
        return df.observe(self.seen, *[F.expr(c.metric).alias(name) for name, c in self.checks.items()]).drop(*helpers)

    def results(self) -> list[tuple[str, int]]:
        """(check, violations) of the finished write."""
        if not self.checks:
            return []
        return list(observed_counts(self.seen, list(self.checks)).items())


def report_of(spark: SparkSession, results: Sequence[tuple[str, int]]) -> DataFrame:
    """Check results as a report like ``run_checks`` gives."""
    return spark.createDataFrame(list(results), "check string, violations long")
