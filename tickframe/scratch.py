"""Tables kept for the length of a run, under the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` and read it back; its plan is a file scan from then on.

    The path is added to ``paths``, for ``drop``.
    """
    path = scratch_path(df.sparkSession, name)
    if paths is not None:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files under ``paths``."""
    total, conf = 0, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        total += where.getFileSystem(conf).getContentSummary(where).getLength()
    return total


def drop(spark: SparkSession, path: str) -> None:
    """Remove a table that no plan reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written beside, then renamed."""
    beside, fs = _file_system(spark, f"{path}.tmp-{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    where, _ = _file_system(spark, path)
    if fs.exists(where):
        fs.delete(where, False)
    if not fs.rename(beside, where):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    where, fs = _file_system(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is missing."""
    where, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
