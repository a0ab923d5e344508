"""Contiguous shards of near-equal bytes from a global prefix sum. DataFrame functions only.

Documents are put in the order (hash of the text, doc_id), so equal texts lie side by side, by a range
partitioning on both columns (a large group of copies spreads over partitions). Every partition's bytes and
rows are totalled, the running sum of those few totals gives each partition its offset, and a window within
the partition completes every document's global byte position and row number. A document belongs to the
shard that holds the middle of its bytes, so no shard is off its target by more than one document.

Defined cases: a null text has no bytes and counts as an empty one; a null doc_id sorts first; rows repeated
in full take neighbouring slots; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch, read_table

SHARDS = 40
OVERHEAD = 16


def shard_by_bytes(docs: DataFrame, scratch: Scratch, shards: int = SHARDS, overhead: int = OVERHEAD) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): ``shards`` contiguous runs of near-equal total size."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
                         F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h"))
    laid = scratch.cut(narrow.repartitionByRange("h", "doc_id").withColumn("pid", F.spark_partition_id()))
    # one row per partition
    totals = laid.groupBy("pid").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = W.orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("pid", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes0"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row0"),
                            F.sum("bytes").over(W.partitionBy()).alias("total"))
    run = W.partitionBy("pid").orderBy("h", "doc_id", "size", "text_crc32").rowsBetween(W.unboundedPreceding, 0)
    placed = (laid.withColumn("upto", F.sum("size").over(run)).withColumn("rn", F.count("*").over(run))
              .join(F.broadcast(offsets), "pid"))  # as many rows as there are partitions
    middle = 2 * (F.col("bytes0") + F.col("upto")) - F.col("size")
    placed = scratch.cut(placed.select(
        "doc_id", "size", "text_crc32", (F.col("row0") + F.col("rn") - 1).alias("row"),
        F.least(F.floor(middle * F.lit(shards) / (2 * F.col("total"))).cast("int"), F.lit(shards - 1)).alias("shard")))
    first = placed.groupBy("shard").agg(F.min("row").alias("row0"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("row0")).alias("slot"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39 under the law ``bytes``."""
    out = shard_by_bytes(read_table(spark, sf_dir, "documents"), Scratch(spark, "sharding"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
