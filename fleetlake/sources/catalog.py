"""Named table lookup across schemas, and registered tables whose partitions follow the files (A10)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


class TableNotFound(RuntimeError):
    pass


def find_table(spark: SparkSession, name: str, strict: bool = True) -> str:
    """Qualified name of ``name`` in the first database (alphabetically) that has it.

    ``strict`` raises ``TableNotFound`` when no database has it (the detector's
    behaviour); otherwise the bare name is returned (the dashboard's).
    """
    for db in sorted(d.name for d in spark.catalog.listDatabases()):
        if spark.catalog.tableExists(f"`{db}`.`{name}`"):
            return f"`{db}`.`{name}`"
    if strict:
        raise TableNotFound(f"could not find table {name!r}; build the pipeline first")
    return name


def _version_tables(spark: SparkSession, database: str, name: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database, f"{name}__v*")]


def sync_partitions(spark: SparkSession, table: str, new: bool = False) -> None:
    """Bring a partitioned table's catalog entries in line with its folders: missing ones are added, gone ones dropped."""
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"msck repair table {table} {'add' if new else 'sync'} partitions")
    spark.catalog.refreshTable(table)


def register_table(spark: SparkSession, database: str, name: str, path: str) -> None:
    """Expose the version of a table that lies at ``path`` as ``database.name``.

    Each version is an external table of its own, with its partitions in the catalog; the name is a view on it. A
    new version is registered in full before the view is replaced, in one step, so that readers see the old table
    or the new one. A version registered already only has its partitions brought in line (new dates added,
    emptied ones dropped). Tables of versions no longer shown are dropped; dropping an external table keeps its files.
    """
    spark.sql(f"create database if not exists `{database}`")
    own = f"{name}__{os.path.basename(path).replace('-', '_')}"
    known = own in _version_tables(spark, database, name)
    table = f"`{database}`.`{own}`"
    if not known:
        spark.catalog.createTable(f"{database}.{own}", path=path, source="parquet")
    sync_partitions(spark, table, new=not known)
    if spark.catalog.tableExists(f"{database}.{name}") and spark.catalog.getTable(f"{database}.{name}").tableType != "VIEW":
        spark.sql(f"drop table `{database}`.`{name}`")  # registered as a plain table before
    spark.sql(f"create or replace view `{database}`.`{name}` as select * from {table}")
    for other in _version_tables(spark, database, name):
        if other != own:
            spark.sql(f"drop table `{database}`.`{other}`")
