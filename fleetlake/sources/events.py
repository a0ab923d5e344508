"""Keyed event sources and publishing (A1-A3).

Every source yields the same message shape -- ``key``, ``value`` (JSON text),
``topic`` -- so ingestion is one code path for Kafka, files and test frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.timestamps import iso_text
from fleetlake.schemas import StreamSpec

LANDED = 100_000  # messages of a landed file


def encode_events(df: DataFrame, spec: StreamSpec, key_col: str = "device_id",
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """A3: records -> ``(key, value, topic)`` messages; the key is the device id.

    ``ignoreNullFields=false`` keeps keys whose value is null (``error_code``),
    which the contract requires; timestamps become ISO-8601 text in UTC.
    """
    fields = [iso_text(F.col(f.name)).alias(f.name) if f.json_type == "date-time" else F.col(f.name)
              for f in spec.fields]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(F.col(key_col).cast("string").alias("key"), value.alias("value"),
                     F.lit(spec.topic).alias("topic"), *carry)


def land_events(messages: DataFrame, path: str) -> None:
    """Write messages as JSON lines, compressed, in files of at most ``LANDED`` messages.

    A compressed file is read by one task, so it is the number of files that spreads the reading.
    """
    (messages.select("value").write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", LANDED).text(path))


def text_events(spark: SparkSession, path: str | list[str], topic: str) -> DataFrame:
    """A2: a batch source of JSON lines (one event per line) for one topic: a folder, or some files."""
    return spark.read.text(path).select(F.lit(None).cast("string").alias("key"),
                                        F.col("value"), F.lit(topic).alias("topic"))


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str, min_partitions: int | None = None,
                 **options) -> DataFrame:
    """A1: subscribe one topic from the earliest offset; offsets live in the query checkpoint.

    Needs the spark-sql-kafka connector on the classpath (not installed here).
    ``maxOffsetsPerTrigger`` bounds a micro-batch like the reference's batch size.
    ``min_partitions`` splits the offset ranges of a topic with few partitions into
    at least that many tasks, so validation runs wide without a shuffle.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic)
              .option("startingOffsets", "earliest"))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("key").cast("string").alias("key"),
                                F.col("value").cast("string").alias("value"), "topic")


def publish_kafka(messages: DataFrame, bootstrap: str) -> None:
    """A3 sink: write ``(key, value, topic)`` messages to Kafka (connector required)."""
    (messages.selectExpr("key", "value", "topic").write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap).save())
