"""Dimension and asset readers: unit definition CSV, unit definitions JSON,
game metadata, empty fallbacks (SRC-3..6)."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import clean_schema

log = logging.getLogger(__name__)

DEFS_MAP_SCHEMA = T.StructType([
    T.StructField("unit_def_id", T.LongType(), True),
    T.StructField("unit_name", T.StringType(), True),
    T.StructField("translated_human_name", T.StringType(), True),
])
UNIT_DEF_FIELDS = ("metalcost", "energycost", "health", "buildtime")
UNIT_DEFS_SCHEMA = T.StructType(
    [T.StructField("unit_name", T.StringType(), False)]
    + [T.StructField(c, T.DoubleType(), False) for c in UNIT_DEF_FIELDS])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def _first_existing(spark, dirs: Sequence[str], name: str) -> str | None:
    for d in dirs:
        p = f"{d.rstrip('/')}/{name}"
        if _exists(spark, p):
            return p
    return None


def read_defs_csv(spark: SparkSession, dirs: Sequence[str], name: str = "defs.csv") -> DataFrame:
    """Unit definition names (first directory that has the file wins).

    Columns id/name/translatedHumanName -> unit_def_id (long), unit_name,
    translated_human_name.  A missing file gives an empty table (warning);
    an id that is not an integer fails the read (FAILFAST)."""
    path = _first_existing(spark, dirs, name)
    if path is None:
        log.warning("%s not found in %s; defs_map is empty", name, list(dirs))
        return empty(spark, DEFS_MAP_SCHEMA)
    schema = "id long, name string, translatedTooltip string, translatedHumanName string"
    df = (spark.read.option("header", "true").option("multiLine", "true")
          .option("quote", '"').option("escape", '"').option("mode", "FAILFAST")
          .schema(schema).csv(path))
    return df.select(F.col("id").alias("unit_def_id"), F.col("name").alias("unit_name"),
                     F.col("translatedHumanName").alias("translated_human_name"))


def read_unit_defs_json(spark: SparkSession, path: str) -> DataFrame:
    """``{unit_name: {metalcost, energycost, health, buildtime, ...}}`` ->
    one row per unit; missing numbers default to 0.0, extra keys ignored."""
    value = T.MapType(T.StringType(), T.StructType(
        [T.StructField(c, T.DoubleType(), True) for c in UNIT_DEF_FIELDS]))
    txt = spark.read.option("wholetext", "true").text(path)
    m = txt.select(F.explode(F.from_json("value", value)).alias("unit_name", "d"))
    return m.select("unit_name", *[F.coalesce(F.col(f"d.{c}"), F.lit(0.0)).alias(c)
                                   for c in UNIT_DEF_FIELDS])


def read_game_meta(spark: SparkSession, dirs: Sequence[str],
                   name: str = "game_meta.json") -> DataFrame:
    """The game metadata file as opaque bytes (first directory wins), plus a
    few parsed fields for convenience."""
    path = _first_existing(spark, dirs, name)
    if path is None:
        log.warning("%s not found in %s", name, list(dirs))
        return empty(spark, "path string, content binary, game_id string, start_time string, "
                            "duration_ms long, map_name string")
    b = spark.read.format("binaryFile").load(path)
    meta = T.StructType([
        T.StructField("id", T.StringType()), T.StructField("startTime", T.StringType()),
        T.StructField("durationMs", T.LongType()),
        T.StructField("hostSettings", T.MapType(T.StringType(), T.StringType())),
    ])
    j = F.from_json(F.col("content").cast("string"), meta)
    return b.select("path", "content", j["id"].alias("game_id"),
                    j["startTime"].alias("start_time"), j["durationMs"].alias("duration_ms"),
                    j["hostSettings"]["mapname"].alias("map_name"))


def empty(spark: SparkSession, schema) -> DataFrame:
    """Empty table with a fixed schema (SRC-6 fallback)."""
    return spark.createDataFrame([], schema)


def empty_aspect(spark: SparkSession, aspect: str) -> DataFrame:
    return empty(spark, clean_schema(aspect))
