"""Bronze layer: hive-partitioned Parquet sink (A4), explicit-schema scan (A5) and
the typed projection that turns bronze rows into ``raw_*`` relations (C1)."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.schemas import StreamSpec


def bronze_schema(spec: StreamSpec) -> T.StructType:
    """Data columns + ingest stamps + partition columns, all declared (never inferred).

    Declaring ``device_id`` as STRING and ``date`` as DATE keeps a partition value
    such as ``007`` a string instead of the integer 7 that type inference yields.
    """
    cols = [T.StructField(f.name, f.spark_type, True) for f in spec.fields if f.name != "device_id"]
    cols += [T.StructField("_ingested_at", T.StringType(), True),
             T.StructField("_source_topic", T.StringType(), True),
             T.StructField("date", T.DateType(), True),
             T.StructField("device_id", T.StringType(), True)]
    return T.StructType(cols)


def write_bronze(df: DataFrame, root: str, spec: StreamSpec) -> None:
    """Append enriched rows under ``root/<stream>/date=.../device_id=.../``.

    Spark names every file uniquely per job and ``append`` never replaces files,
    as the reference's uuid-named batches do. The REBALANCE hint clusters rows by
    partition directory (few, large files) while AQE splits a hot device-day over
    several tasks instead of funnelling it through one.
    """
    out = df.select(*[F.col(c) for c in bronze_schema(spec).fieldNames()])
    (out.hint("rebalance", "date", "device_id")
        .write.mode("append")
        .partitionBy("date", "device_id")
        .parquet(os.path.join(root, spec.name)))


def scan_bronze(spark: SparkSession, root: str, spec: StreamSpec) -> DataFrame:
    """Scan all bronze files of one stream with the declared schema.

    Columns a file lacks come back null (union by name); partition columns come
    from the directory names. A filter on ``date`` prunes directories.
    """
    path = os.path.join(root, spec.name)
    return spark.read.schema(bronze_schema(spec)).option("basePath", path).parquet(path)


# Spark's name of a Parquet file: the part, the write that made it, a counter
_WRITE_ID = re.compile(r"part-\d+-([0-9a-f-]{36})")


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files by footer schema: (schema, files) with one entry per set of types that can be read together.

    One file stands for all of the same write. Their footers are merged by executors; where types clash, the
    files are halved until they don't, and halves of one schema are put together again.
    """
    by_write: dict[str, list[str]] = {}
    for path in paths:
        found = _WRITE_ID.search(path.rsplit("/", 1)[-1])
        by_write.setdefault(found.group(1) if found else path, []).append(path)
    todo, groups = [sorted(by_write)] if by_write else [], {}
    while todo:
        writes = todo.pop()
        try:
            schema = spark.read.option("mergeSchema", True).parquet(*[by_write[w][0] for w in writes]).schema
        except Exception as e:  # noqa: BLE001 -- only clashing types are halved
            if len(writes) == 1 or "MERGE" not in str(e).upper():
                raise
            todo += [writes[:len(writes) // 2], writes[len(writes) // 2:]]
            continue
        key = tuple(sorted((f.name, f.dataType.simpleString()) for f in schema.fields))
        groups.setdefault(key, (schema, []))[1].extend(p for w in writes for p in by_write[w])
    return list(groups.values())


def scan_bronze_mixed(spark: SparkSession, root: str, spec: StreamSpec) -> DataFrame:
    """``scan_bronze`` over files whose column types differ (A5, union by name).

    The declared-schema scan fails on a file with other types, say a 64-bit integer where 32 bits are declared or
    a whole number where a double is. Here files are grouped by footer schema, each group is read with its own types
    and cast to the contract's, and the groups are united. It reads one footer per write beforehand, so use it
    for bronze that other writers fill too.
    """
    path, want = os.path.join(root, spec.name), bronze_schema(spec)
    parts = [f for f in want.fields if f.name in spec.partition_cols]
    out = scan_bronze(spark, root, spec).limit(0)
    for schema, paths in schema_groups(spark, scan_bronze(spark, root, spec).inputFiles()):
        own = T.StructType([f for f in schema.fields if f.name not in spec.partition_cols] + parts)
        rows = spark.read.schema(own).option("basePath", path).parquet(*paths)
        names = set(own.fieldNames())
        out = out.unionByName(rows.select(*[
            (F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in want.fields]))
    return out


def as_bronze_rows(df: DataFrame, spec: StreamSpec, ingested_at=None) -> DataFrame:
    """Give a stream-shaped frame the bronze columns without an ingest step.

    Used for bound test tables: ``_source_topic`` is the stream's topic,
    ``_ingested_at`` is unknown (null) and ``date`` is the UTC event date.
    """
    return df.select(
        "*",
        (ingested_at if ingested_at is not None else F.lit(None).cast("string")).alias("_ingested_at"),
        F.lit(spec.topic).alias("_source_topic"),
        F.to_date(F.col("timestamp")).alias("date"),
    )


def typed_projection(df: DataFrame, spec: StreamSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """``raw_*``: cast every measure to its declared type, ``date`` -> ``event_date``.

    Timestamps already typed (TIMESTAMP or TIMESTAMP_NTZ) are kept as they are;
    text is cast. ``keep`` carries extra columns through (e.g. a tie-break).
    """
    types = dict(df.dtypes)
    cols = []
    for f in spec.fields:
        if f.json_type == "date-time" and types.get(f.name, "").startswith("timestamp"):
            cols.append(F.col(f.name))
        elif f.name in (spec.key, "device_id") or isinstance(f.spark_type, T.ArrayType):
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).cast(f.spark_type).alias(f.name))
    cols += [F.col("_ingested_at").cast("string").alias("_ingested_at"),
             F.col("_source_topic").cast("string").alias("_source_topic"),
             F.col("date").cast("date").alias("event_date")]
    cols += [F.col(k) for k in keep]
    return df.select(*cols)
