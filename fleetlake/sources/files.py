"""Small file-system steps through Hadoop's API, so that they reach every store Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, where: str) -> bool:
    path, fs = _fs(spark, where)
    return fs.exists(path)


def folders(spark: SparkSession, where: str) -> list[str]:
    """Names of the folders in ``where``, in order; none if it is missing."""
    path, fs = _fs(spark, where)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())


def data_files(spark: SparkSession, where: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files in ``where`` that a reader sees, in order of their names; none if it is missing."""
    path, fs = _fs(spark, where)
    if not fs.exists(path):
        return []
    found = [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(path) if s.isFile()]
    return sorted(f for f in found if f[0].rsplit("/", 1)[-1][0] not in "._")


def remove(spark: SparkSession, where: str) -> None:
    path, fs = _fs(spark, where)
    fs.delete(path, True)


def folder_until_exit(spark: SparkSession, where: str) -> None:
    """Make a folder that goes with all in it when the application ends."""
    path, fs = _fs(spark, where)
    fs.mkdirs(path)  # only what exists can be marked
    fs.deleteOnExit(path)


def read_text(spark: SparkSession, where: str) -> str | None:
    """The text of a small file, or None if it is missing."""
    path, fs = _fs(spark, where)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, where: str, text: str) -> None:
    """Replace a small file: written beside its place, then renamed over it in one step."""
    jvm = spark._jvm
    target, fs = _fs(spark, where)
    fresh, _ = _fs(spark, f"{where}.tmp")
    out = fs.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(fresh), context.makeQualified(target), options)
