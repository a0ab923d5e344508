"""Session helpers: a configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every fleetlake job relies on. UTC is required: event dates are UTC dates.
# hugeMethodLimit 8000 = the JVM's JIT limit: a whole-stage method larger than that
# would run in the bytecode interpreter, so Spark falls back to per-expression
# code generation instead (measured 2x faster on the contract projections).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

CORE_CONF = {
    **RUNTIME_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of frames no longer referenced are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "fleetlake",
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with fleetlake's required settings.

    On a cluster, pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (about 128-256 MB per post-shuffle
    partition) -- AQE coalesces small ones at runtime.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings on a session fleetlake did not create."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder (HDFS/S3/...); we only invent a local
    one when the setting is absent, which is the case in tests on local mode.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="fleetlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables; it goes when the application ends."""
    from fleetlake.sources.files import folder_until_exit
    own = os.path.join(checkpoint_dir(spark), f"fleetlake-{spark.sparkContext.applicationId}")
    folder_until_exit(spark, own)
    return os.path.join(own, name)


def free_shuffles(spark: SparkSession) -> None:
    """The shuffle files of frames that nothing names any more go now, not when the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once, and no lost executor recomputes it."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
