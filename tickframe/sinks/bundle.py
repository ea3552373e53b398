"""Hybrid bundle (SNK-6): chunks of all streams and assets, a directory and a header.

A bundle is a folder of two tables:

* ``chunks``: row-major and columnar chunks, the definitions lookup and the game
  metadata, by stream and data key.  ``byte_start`` is where a chunk begins in
  the uncompressed file that the chunks of its data key make up, so a reader can
  go to any byte of a column.
* ``header``: one ``schema_json`` a replay: version, static assets, and for every
  stream its layout, rows, bytes and columns with their data keys, types and
  transforms.

``read_stream`` opens one stream, or some columns of it, by the header alone.  No
replay passes one task: offsets and byte places are prefix sums over parts.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import stored
from . import writers as W
from .contracts import CONTRACTS, TYPES, lookup_rows

VERSION = "8.2-hybrid-mpk"
ANY_REPLAY = "*"
DEFS, META = "defs_map", "game_meta"


def _assets(defs: DataFrame | None, game_meta: DataFrame | None) -> list[DataFrame]:
    """Static assets as chunks that belong to every replay."""
    out = []
    if defs is not None:
        lines = lookup_rows(defs).select(F.to_json(F.struct("key", "values")).alias("line"))

        def pack_lines(batches):
            from pyspark import TaskContext
            part = TaskContext.get().partitionId()
            for seq, b in enumerate(batches):
                text = "".join(f"{line}\n" for line in b.column(0).to_pylist()).encode()
                yield pa.RecordBatch.from_pydict({
                    "replay_id": [ANY_REPLAY], "stream": [DEFS], "data_key": [f"{DEFS}.lookup"],
                    "part": [part], "seq": [seq], "num_rows": [b.num_rows],
                    "raw_bytes": [len(text)], "items": [None], "base": [None],
                    "blob": [W._zstd(text)]}, schema=W._CHUNK_ARROW)
        out.append(lines.mapInArrow(pack_lines, W.CHUNK_SCHEMA))
    if game_meta is not None:
        out.append(game_meta.select(
            F.lit(ANY_REPLAY).alias("replay_id"), F.lit(META).alias("stream"),
            F.lit(f"{META}.json").alias("data_key"), F.lit(0).alias("part"),
            F.lit(0).alias("seq"), F.lit(1).cast("long").alias("num_rows"),
            F.octet_length("content").cast("long").alias("raw_bytes"),
            F.lit(None).cast("long").alias("items"), F.lit(None).cast("long").alias("base"),
            F.col("content").alias("blob")))
    return out


def hybrid_bundle(streams: dict[str, DataFrame], defs: DataFrame | None = None,
                  game_meta: DataFrame | None = None,
                  orders: dict[str, Sequence[str]] | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """(chunks with ``byte_start``, header) of all streams and assets."""
    parts, docs = [], {}
    for name, df in streams.items():
        contract, order = CONTRACTS.get(name), (orders or {}).get(name, ("frame", "row_ord"))
        prepared = W.prepare(df, name, contract)
        if contract is not None and contract.layout == "row-major-mixed":
            try:
                docs[name] = _described(prepared, name, "row-major-mixed")
                parts.append(W.pack_row_major(prepared, name, order))
            except TypeError as e:      # unsupported column: skip the stream
                W.log.warning("stream %s skipped: %s", name, e)
        else:
            docs[name] = _described(prepared, name, "columnar")
            parts.append(W.pack_columnar(prepared, name, order))
    parts += _assets(defs, game_meta)
    if not parts:
        raise ValueError("a bundle needs a stream or an asset")
    chunks = parts[0]
    for part in parts[1:]:
        chunks = chunks.unionByName(part)
    chunks = stored(W.rebase(chunks), "bundle")
    key = ["replay_id", "data_key", "part", "seq"]
    places = W.running_before(chunks.select(*key, "raw_bytes"), "raw_bytes", "byte_start")
    chunks = stored(chunks.join(places.select(*key, "byte_start"), key), "bundle-directory")
    assets = [name for name, df in ((META, game_meta), (DEFS, defs)) if df is not None]
    return chunks, _header(chunks, docs, assets)


def _described(df: DataFrame, stream: str, layout: str) -> dict:
    doc = W.stream_schema(df, stream, layout)
    types = {f.name: f.dataType for f in df.schema}
    for column in doc["columns"]:
        transform = column["transform"]
        column["original_dtype"] = transform.pop("original_dtype", column["dtype"])
        column["spark_type"] = types[column["name"]].simpleString()
        column["data_keys"] = ([f"{stream}.rows"] if layout == "row-major-mixed" else
                               W.column_keys(types[column["name"]], f"{stream}.{column['name']}"))
    return doc


def _header(chunks: DataFrame, docs: dict[str, dict], assets: list[str]) -> DataFrame:
    """(replay_id, schema_json): the streams' documents with rows and bytes of each replay."""
    if not docs:
        return chunks.sparkSession.createDataFrame(
            [(ANY_REPLAY, json.dumps({"replay_id": ANY_REPLAY, "schema_version": VERSION,
                                      "static_assets": assets, "streams": {}}))],
            "replay_id string, schema_json string")
    spark = chunks.sparkSession
    doc = spark.createDataFrame([(k, json.dumps(v)) for k, v in docs.items()],
                                "stream string, doc string")
    chunk = chunks.where(F.col("replay_id") != ANY_REPLAY).groupBy(
        "replay_id", "stream", "part", "seq").agg(F.max("num_rows").alias("n"),
                                                  F.sum("raw_bytes").alias("b"))
    of = chunk.groupBy("replay_id", "stream").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    body = of.join(doc, "stream").select(
        "replay_id", "stream", F.concat(
            F.lit('{"num_rows": '), F.col("n").cast("string"), F.lit(', "byte_size": '),
            F.col("b").cast("string"), F.lit(", "), F.substr("doc", F.lit(2))).alias("body"))
    return body.groupBy("replay_id").agg(F.concat(
        F.lit('{"replay_id": '), F.to_json(F.array("replay_id")).substr(2, 1 << 20),
        F.lit(f', "schema_version": "{VERSION}", "static_assets": {json.dumps(assets)}, '
              '"streams": {'),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("stream", "body"))),
            lambda s: F.concat(F.lit('"'), s["stream"], F.lit('": '), s["body"])), ", "),
        F.lit("}}")).alias("schema_json")).withColumn(
        # to_json of a one-element array quotes the name; its closing bracket goes
        "schema_json", F.regexp_replace("schema_json", r'^(\{"replay_id": "(?:[^"\\]|\\.)*")\]',
                                        "$1"))


def write_bundle(bundle: tuple[DataFrame, DataFrame], out_dir: str, mode: str = "append") -> None:
    """``chunks`` by stream and data key, so a reader of a column opens its files only."""
    root = out_dir.rstrip("/")
    bundle[0].write.mode(mode).partitionBy("stream", "data_key").parquet(f"{root}/chunks")
    bundle[1].write.mode(mode).parquet(f"{root}/header")


CHUNKS = T.StructType([*(f for f in W.CHUNK_SCHEMA if f.name not in ("stream", "data_key")),
                       T.StructField("byte_start", T.LongType()),
                       T.StructField("stream", T.StringType()),
                       T.StructField("data_key", T.StringType())])


def read_header(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema("replay_id string, schema_json string").parquet(
        f"{out_dir.rstrip('/')}/header")


def stream_document(spark: SparkSession, out_dir: str, stream: str) -> dict:
    """The document of a stream, from the header of any replay that has it."""
    found = read_header(spark, out_dir).where(
        F.get_json_object("schema_json", f"$.streams.{stream}.layout").isNotNull()).first()
    if found is None:
        raise KeyError(f"the bundle has no stream {stream!r}")
    return json.loads(found["schema_json"])["streams"][stream]


def read_stream(spark: SparkSession, out_dir: str, stream: str,
                columns: Sequence[str] | None = None) -> DataFrame:
    """(replay_id, part, seq, row, columns...) of one stream, decoded as the header says."""
    doc = stream_document(spark, out_dir, stream)
    known = {c["name"]: c for c in doc["columns"]}
    names = list(known) if columns is None else list(columns)
    unknown = [n for n in names if n not in known]
    if unknown:
        raise KeyError(f"stream {stream!r} has no column {', '.join(unknown)}")
    chunks = spark.read.schema(CHUNKS).parquet(f"{out_dir.rstrip('/')}/chunks").where(
        F.col("stream") == stream)
    types = {n: T.StructType.fromDDL(f"x {c['spark_type']}")["x"].dataType
             for n, c in known.items()}
    if doc["layout"] == "row-major-mixed":
        dtype = np.dtype([(n, TYPES[c["dtype"]][2]) for n, c in known.items()])
        # unsigned values come back in a wider type
        wide = T.StructType([T.StructField(n, T.LongType() if dtype[n].kind in "iu"
                                           else T.DoubleType()) for n in dtype.names])
        return W.read_row_major(chunks, stream, dtype, wide).select(
            "replay_id", "part", "seq", "row", *names)
    return W.read_columnar(chunks, stream, [
        (n, known[n]["dtype"] if known[n]["dtype"] in TYPES else None, types[n]) for n in names])


def read_asset(spark: SparkSession, out_dir: str, asset: str) -> DataFrame:
    """The chunks of a static asset in order."""
    return spark.read.schema(CHUNKS).parquet(f"{out_dir.rstrip('/')}/chunks").where(
        F.col("stream") == asset).orderBy("part", "seq")
