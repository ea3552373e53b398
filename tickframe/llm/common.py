"""Shared pieces of the operators: scratch tables, readers, small expressions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set: a machine-local folder would be seen by one
    machine only.  A local session (tests) gets one of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage (a lost executor rereads files, nothing is recomputed) and
    fixes generated values such as row numbers once and for all.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


#: Tables stored inside the calls of ``kept`` that are running, innermost last.
_SCOPES: list[list[str]] = []


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(table: DataFrame) -> None:
    """Remove a ``stored`` table that no plan reads any more."""
    path = table.scratch_path
    for scope in _SCOPES:
        if path in scope:
            scope.remove(path)
    _remove(table.sparkSession, path)


def kept(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Store what ``make`` returns, then remove every table that was stored on the way.

    No other plan may read those tables afterwards.
    """
    inner: list[str] = []
    _SCOPES.append(inner)
    try:
        df = make()
        _SCOPES.pop()
        out = stored(df, name)
    except BaseException:
        if _SCOPES and _SCOPES[-1] is inner:
            _SCOPES.pop()
        raise
    for path in inner:
        _remove(out.sparkSession, path)
    return out


def local_path(uri: str) -> str:
    """The path of a ``file:`` URI, for readers in Python that need one."""
    parsed = urlparse(uri)
    return parsed.path if parsed.scheme in ("", "file") else uri


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes empty.

    ``lower`` equals that on pure ASCII and is far cheaper than ``translate``.
    """
    text = F.coalesce(text, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


#: Bits of the table that tells rows apart before they are joined, at most.
MAX_BITS = 26


def key_bits(keys: DataFrame, n: int) -> tuple[DataFrame, int]:
    """A bit table of about 16 bits a key, and how many bits it has.

    It has ``2 ** (MAX_BITS - 6)`` rows at most, so broadcasting it is bounded
    whatever the number of keys; the fuller it is, the more rows pass it in vain.
    """
    many = 1 << min(MAX_BITS, max(16, (16 * n).bit_length()))
    (key,) = keys.columns
    bit = F.pmod(F.xxhash64(key), F.lit(many))
    return (keys.groupBy(F.floor(bit / 64).cast("int").alias("__word"))
            .agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod(pmod(xxhash64({key}), {many}L), 64) "
                        "AS int)))").alias("__bits")), many)


def split_by_keys(rows: DataFrame, key: Column, keys: DataFrame,
                  name: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among ``keys``, stored; the rows whose key is not).

    No row is shuffled: a bit table is broadcast.  The first part holds every
    row with such a key and a few more, and is written, for the optimizer would
    move a later join below the test and shuffle all rows for it.  Rows with a
    null key are in the second part.
    """
    n = keys.count()
    bits, many = key_bits(keys, n)
    columns = rows.columns
    tested = rows.withColumn("__key", key).withColumn(
        "__bit", F.pmod(F.xxhash64("__key"), F.lit(many))).withColumn(
        "__word", F.floor(F.col("__bit") / 64).cast("int"))
    tested = tested.join(F.broadcast(bits), "__word", "left")
    hit = F.expr("__key IS NOT NULL AND coalesce((shiftrightunsigned(__bits, "
                 "cast(pmod(__bit, 64) AS int)) & 1L) = 1L, false)")
    return (stored(tested.where(hit).select(*columns), name),
            tested.where(~hit).select(*columns))
