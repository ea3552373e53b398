"""Sinks (SNK-1..7).

* Parquet and gzip JSON lines: a stream is stored once, cut into ranges of
  ``(replay_id, order...)`` by its size in bytes, and written with an index of
  the files that each replay is in; empty streams are skipped.  The number of
  files follows the bytes, not replays times tasks, and ``read_replays`` opens
  only the files of the replays asked for.
* Binary layouts: a stream is range-partitioned and sorted by
  ``(replay_id, order...)``; each Arrow batch of each task is packed into one
  zstd frame, keyed ``(replay_id, part, seq)``.  Fixed-stride rows and zstd
  frames both concatenate, so the full per-replay file is the chunks in key
  order -- no replay is ever gathered into a single task or the driver.
  Columnar string/list offsets restart at 0 in every chunk (recorded in the
  schema).  Chunk tables are written as Parquet; ``schema_rows`` gives the
  per-(replay, stream) ``schema.json`` document.
"""

from __future__ import annotations

import functools
import json
import logging
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..scratch import drop, size, stored
from .contracts import CONTRACTS, INTERNAL, TYPES, Contract, apply_contract, encode_nulls, \
    logical_type

log = logging.getLogger(__name__)

ROW_MAJOR_VERSION = "7.0-row-major-mixed"
COLUMNAR_VERSION = "6.0-columnar"

CHUNK_SCHEMA = T.StructType([
    T.StructField("replay_id", T.StringType(), False),
    T.StructField("stream", T.StringType(), False),
    T.StructField("data_key", T.StringType(), False),
    T.StructField("part", T.IntegerType(), False),
    T.StructField("seq", T.IntegerType(), False),
    T.StructField("num_rows", T.LongType(), False),
    T.StructField("raw_bytes", T.LongType(), False),   # of the blob, uncompressed
    T.StructField("items", T.LongType(), True),        # offsets: what the chunk's offsets span
    T.StructField("base", T.LongType(), True),         # offsets: where the chunk's items begin
    T.StructField("blob", T.BinaryType(), False),
])
#: Bytes of stored input (compressed) to one range of a sink.
RANGE_BYTES = 64 << 20
#: Bytes of stored input to one output file.
FILE_BYTES = 128 << 20
#: Rows of one output file or range; files that compress well hold many more than their bytes say.
FILE_ROWS = 1 << 20
#: Decoded rows that leave a task at once, at least a chunk's.
UNPACK_ROWS = 1 << 16
INDEX = "_replays"


# --------------------------------------------------------------------------- files
def _kept(streams: dict[str, DataFrame]):
    """(name, stored table, its bytes, where) of the streams that have rows."""
    for name, df in streams.items():
        paths: list[str] = []
        df = stored(df, f"sink-{name}", paths)
        if df.isEmpty():
            log.info("stream %s is empty; not written", name)
        else:
            yield name, df, size(df.sparkSession, paths)
        for path in paths:
            drop(df.sparkSession, path)


def _ranged(df: DataFrame, files: int, order: Sequence[Column | str]) -> DataFrame:
    """Rows in ``files`` ranges of the order, sorted."""
    if "replay_id" in df.columns:
        order = ["replay_id", *order]
    if not order:
        return df.coalesce(files)
    if files == 1:
        return df.coalesce(1).sortWithinPartitions(*order)
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)


def _write_files(df: DataFrame, total: int, path: str, order: Sequence[Column | str], mode: str,
                 form: str, file_bytes: int, **options: str) -> None:
    files = max(1, -(-total // file_bytes), -(-df.count() // FILE_ROWS))
    _ranged(df, files, order).write.mode(mode).format(form).options(**options).save(path)
    if "replay_id" in df.columns:
        rows = _read(df.sparkSession, path, form, df.schema)
        (rows.groupBy("replay_id", F.col("_metadata.file_name").alias("file"))
         .agg(F.count(F.lit(1)).alias("rows"))
         .repartitionByRange(max(1, files // 16), "replay_id").sortWithinPartitions("replay_id")
         .write.mode("overwrite").parquet(f"{path}/{INDEX}"))


def _read(spark: SparkSession, path: str | list[str], form: str, schema: T.StructType) -> DataFrame:
    return spark.read.format(form).schema(schema).load(path)


def write_parquet(streams: dict[str, DataFrame], out_dir: str, mode: str = "overwrite",
                  orders: dict[str, Sequence[Column | str]] | None = None,
                  file_bytes: int = FILE_BYTES) -> list[str]:
    """SNK-1: ``<out_dir>/<stream>/``, rows by replay and the stream's order."""
    written = []
    for name, df, total in _kept(streams):
        _write_files(df, total, f"{out_dir.rstrip('/')}/{name}", (orders or {}).get(name, ()),
                     mode, "parquet", file_bytes)
        written.append(name)
    return written


def write_jsonl_gz(streams: dict[str, DataFrame], out_dir: str, mode: str = "overwrite",
                   orders: dict[str, Sequence[Column | str]] | None = None,
                   file_bytes: int = FILE_BYTES // 4) -> list[str]:
    """SNK-2: as ``write_parquet``, gzip JSON lines (which are read whole, so smaller files)."""
    written = []
    for name, df, total in _kept(streams):
        _write_files(df, total, f"{out_dir.rstrip('/')}/{name}", (orders or {}).get(name, ()),
                     mode, "json", file_bytes, compression="gzip", ignoreNullFields="false")
        written.append(name)
    return written


def read_replays(spark: SparkSession, out_dir: str, name: str, replays: Sequence,
                 schema: T.StructType | str, form: str = "parquet") -> DataFrame:
    """The rows of some replays; only the files that hold them are opened."""
    path = f"{out_dir.rstrip('/')}/{name}"
    files = [r[0] for r in spark.read.parquet(f"{path}/{INDEX}").where(
        F.col("replay_id").isin(list(replays))).select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], schema)
    return _read(spark, [f"{path}/{f}" for f in sorted(files)], form, schema).where(
        F.col("replay_id").isin(list(replays)))


# --------------------------------------------------------------------------- packing
def _payload_columns(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name not in INTERNAL]


def _logical(f: T.StructField) -> str | None:
    meta = f.metadata.get("contract", {}) if f.metadata else {}
    return meta.get("to_type") or logical_type(f.dataType)


def row_major_dtype(df: DataFrame) -> np.dtype:
    """Packed (unaligned, little-endian) record dtype; raises TypeError for a
    column that has no fixed-width binary form."""
    fields = []
    for f in _payload_columns(df):
        lt = _logical(f)
        code = TYPES.get(lt, (None, None, None))[2] if lt else None
        if code is None or lt == "Boolean":
            raise TypeError(f"column {f.name!r} ({lt or f.dataType.simpleString()}) "
                            "cannot be packed row-major")
        fields.append((f.name, code))
    return np.dtype(fields)


def _ordered(df: DataFrame, order: Sequence[str], partitions: int | None) -> DataFrame:
    """The stream stored once and range-partitioned by its size in bytes."""
    keys = ["replay_id", *[o for o in order if o in df.columns]]
    paths: list[str] = []
    rules = {f.name: f.metadata for f in df.schema}
    df = stored(df, "ordered", paths)
    df = df.select(*[F.col(c).alias(c, metadata=rules[c]) for c in df.columns])
    if partitions is None:
        total = size(df.sparkSession, paths)
        partitions = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // RANGE_BYTES))
    return df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)


@functools.cache
def _compressor():
    import zstandard
    return zstandard.ZstdCompressor()


def _zstd(data: bytes) -> bytes:
    return _compressor().compress(data)


def _segments(batch: pa.RecordBatch):
    """(replay_id, first row, rows) of the runs of a batch sorted by replay_id."""
    runs = pc.run_end_encode(batch.column(batch.schema.get_field_index("replay_id")))
    start = 0
    for rid, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
        yield rid, start, end - start
        start = end


def pack_row_major(df: DataFrame, stream: str, order: Sequence[str] = ("frame", "row_ord"),
                   partitions: int | None = None) -> DataFrame:
    """Chunks of fixed-stride little-endian rows (one zstd frame each)."""
    dtype = row_major_dtype(df)
    names = list(dtype.names)
    src = _ordered(df.withColumn("replay_id", F.col("replay_id").cast("string")), order, partitions)

    def pack(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        seq = 0
        for batch in batches:
            runs = list(_segments(batch))
            rec = np.empty(batch.num_rows, dtype=dtype)
            for n in names:
                col = batch.column(batch.schema.get_field_index(n))
                # values beside a null would pass through floats
                for at, many in [(at, many) for _, at, many in runs] if col.null_count else [
                        (0, len(col))]:
                    rec[n][at:at + many] = col.slice(at, many).to_numpy(
                        zero_copy_only=False).astype(dtype[n], copy=False)
            many = len(runs)
            yield pa.RecordBatch.from_pydict({
                "replay_id": [rid for rid, _, _ in runs], "stream": [stream] * many,
                "data_key": [f"{stream}.rows"] * many, "part": [part] * many,
                "seq": range(seq, seq + many), "num_rows": [n for _, _, n in runs],
                "raw_bytes": [n * dtype.itemsize for _, _, n in runs],
                "items": [None] * many, "base": [None] * many,
                "blob": [_zstd(rec[at:at + n].tobytes()) for _, at, n in runs]},
                schema=_CHUNK_ARROW)
            seq += many

    return src.select("replay_id", *names).mapInArrow(pack, CHUNK_SCHEMA)


_CHUNK_ARROW = pa.schema([("replay_id", pa.string()), ("stream", pa.string()),
                          ("data_key", pa.string()), ("part", pa.int32()), ("seq", pa.int32()),
                          ("num_rows", pa.int64()), ("raw_bytes", pa.int64()),
                          ("items", pa.int64()), ("base", pa.int64()), ("blob", pa.binary())])

_NUMPY = {"Int8": "<i1", "Int16": "<i2", "Int32": "<i4", "Int64": "<i8", "UInt8": "<u1",
          "UInt16": "<u2", "UInt32": "<u4", "UInt64": "<u8", "Float32": "<f4",
          "Float64": "<f8", "Boolean": "u1"}


def encode_array(arr: pa.Array, key: str, logical: str | None = None) -> dict[str, bytes]:
    """Column encodings (SNK-5): primitive -> one buffer; string and
    list<primitive> -> uint32 offsets + data; list<struct> -> list offsets +
    each field's encoding (recursive)."""
    t = arr.type
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        raw = np.asarray(arr.offsets.to_numpy(zero_copy_only=False), dtype=np.int64)
        offs = (raw - raw[0]).astype("<u4")  # a batch slice may not start at 0
        child = arr.flatten()
        if pa.types.is_struct(t.value_type):
            out = {f"{key}_list_offs": offs.tobytes()}
            for i, fld in enumerate(t.value_type):
                out.update(encode_array(child.field(i), f"{key}.{fld.name}"))
            return out
        out = {f"{key}_offs": offs.tobytes()}
        out.update(encode_array(child, f"{key}_vals"))
        return out
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        enc = [v.encode("utf-8") for v in arr.fill_null("").to_pylist()]
        offs = np.zeros(len(enc) + 1, dtype="<u4")
        np.cumsum([len(v) for v in enc], out=offs[1:])
        return {f"{key}_offs": offs.tobytes(), f"{key}_data": b"".join(enc)}
    if pa.types.is_boolean(t):
        return {key: np.asarray(arr.fill_null(False).to_numpy(zero_copy_only=False), "u1").tobytes()}
    # values inside lists keep their own width; null numbers there are 0
    code = _NUMPY.get(logical or "") or np.dtype(t.to_pandas_dtype()).newbyteorder("<")
    if logical is None and pa.types.is_integer(t):
        arr = arr.fill_null(0)
    return {key: np.asarray(arr.to_numpy(zero_copy_only=False)).astype(code).tobytes()}


def offset_keys(t: pa.DataType, key: str) -> set[str]:
    """The keys of ``encode_array`` that hold offsets."""
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        if pa.types.is_struct(t.value_type):
            return {f"{key}_list_offs"}.union(*(
                offset_keys(f.type, f"{key}.{f.name}") for f in t.value_type))
        return {f"{key}_offs"} | offset_keys(t.value_type, f"{key}_vals")
    return {f"{key}_offs"} if pa.types.is_string(t) or pa.types.is_large_string(t) else set()


def pack_columnar(df: DataFrame, stream: str, order: Sequence[str] = ("frame", "row_ord"),
                  partitions: int | None = None) -> DataFrame:
    """Chunks of per-column buffers (one zstd frame per column per chunk)."""
    fields = _payload_columns(df)
    logicals = {f.name: _logical(f) for f in fields}
    names = [f.name for f in fields]
    src = _ordered(df.withColumn("replay_id", F.col("replay_id").cast("string")), order, partitions)

    def pack(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        seq = 0
        for batch in batches:
            rows = {k: [] for k in _CHUNK_ARROW.names}
            for rid, at, many in _segments(batch):
                seg = batch.slice(at, many)
                for n in names:
                    col = seg.column(seg.schema.get_field_index(n))
                    offsets = offset_keys(col.type, f"{stream}.{n}")
                    for key, buf in encode_array(col, f"{stream}.{n}", logicals[n]).items():
                        rows["replay_id"].append(rid)
                        rows["stream"].append(stream)
                        rows["data_key"].append(key)
                        rows["part"].append(part)
                        rows["seq"].append(seq)
                        rows["num_rows"].append(seg.num_rows)
                        rows["raw_bytes"].append(len(buf))
                        rows["items"].append(int.from_bytes(buf[-4:], "little")
                                             if key in offsets else None)
                        rows["base"].append(0 if key in offsets else None)
                        rows["blob"].append(_zstd(buf))
                seq += 1
            yield pa.RecordBatch.from_pydict(rows, schema=_CHUNK_ARROW)

    return src.select("replay_id", *names).mapInArrow(pack, CHUNK_SCHEMA)


def running_before(df: DataFrame, value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the chunks of a file before each chunk.

    In two phases, over the chunks of a part and over parts, so that no task
    holds all chunks of a replay; ``first`` marks a file's first chunk.
    """
    file = ["replay_id", "data_key"]
    parts = df.groupBy(*file, "part").agg(F.sum(value).alias("__sum"))
    by_part = Window.partitionBy(*file).orderBy("part")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*file, "part", F.coalesce(F.sum("__sum").over(before), F.lit(0))
                         .alias("__before"), (F.row_number().over(by_part) == 1).alias("__first"))
    by_seq = Window.partitionBy(*file, "part").orderBy("seq")
    inside = df.withColumn("__inside", F.coalesce(F.sum(value).over(
        by_seq.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn(
        "__chunk", F.row_number().over(by_seq))
    return inside.join(parts, [*file, "part"]).select(
        *df.columns, (F.col("__before") + F.col("__inside")).alias(out),
        (F.col("__first") & (F.col("__chunk") == 1)).alias("first"))


def rebase(chunks: DataFrame) -> DataFrame:
    """Chunks whose offsets count from the start of their replay's file.

    The first chunk of a file has num_rows + 1 offsets, the others num_rows, so
    that the chunks in key order are one valid offsets column.  ``base`` is where
    a chunk's items begin.
    """
    chunks = stored(chunks, "chunks")
    key = ["replay_id", "data_key", "part", "seq"]
    offsets = chunks.where("items IS NOT NULL")
    places = running_before(offsets.select(*key, "items"), "items", "at").select(
        *key, "at", "first")

    def move(batches):
        import zstandard
        d = zstandard.ZstdDecompressor()
        for batch in batches:
            blobs, raw = [], []
            for blob, at, first, name in zip(*(batch.column(c).to_pylist() for c in (
                    "blob", "at", "first", "data_key"))):
                offs = np.frombuffer(d.decompressobj().decompress(blob), "<u4").astype(np.int64)
                offs = (offs if first else offs[1:]) + at
                if len(offs) and offs[-1] >= 1 << 32:
                    raise OverflowError(f"{name}: more items than 32-bit offsets can count")
                blobs.append(_zstd(offs.astype("<u4").tobytes()))
                raw.append(4 * len(offs))
            columns = {c: batch.column(c) for c in _CHUNK_ARROW.names}
            columns.update(blob=pa.array(blobs, pa.binary()), raw_bytes=pa.array(raw, pa.int64()),
                           base=batch.column("at"))
            yield pa.RecordBatch.from_pydict(columns, schema=_CHUNK_ARROW)

    moved = offsets.join(places, key).select(*_CHUNK_ARROW.names, "at", "first").mapInArrow(
        move, CHUNK_SCHEMA)
    return chunks.where("items IS NULL").unionByName(moved)


# --------------------------------------------------------------------------- schema
def stream_schema(df: DataFrame, stream: str, layout: str) -> dict:
    """Static part of the schema document for one stream."""
    cols = []
    for f in _payload_columns(df):
        meta = dict(f.metadata.get("contract", {})) if f.metadata else {}
        table = meta.pop("table", {})
        entry = {"name": f.name, "dtype": _logical(f) or f.dataType.simpleString(),
                 "transform": meta or {"transform": "none"}}
        if layout == "row-major-mixed":
            entry["null_encoding"] = table.get("null_encoding")
        cols.append(entry)
    doc = {"layout": layout, "columns": cols}
    if layout == "row-major-mixed":
        doc["row_byte_stride"] = row_major_dtype(df).itemsize
        doc["file"] = f"{stream}.rows.bin.zst"
    else:
        doc["offsets"] = "per file"
    return doc


def schema_rows(chunks: DataFrame, docs: dict[str, dict], version: str) -> DataFrame:
    """One ``schema.json`` document per replay: the static stream docs plus
    row counts aggregated from the chunk table."""
    counts = (chunks.groupBy("replay_id", "stream", "part", "seq").agg(F.max("num_rows").alias("n"))
              .groupBy("replay_id", "stream").agg(F.sum("n").alias("num_rows")))
    doc_map = F.create_map(*[x for k, v in docs.items() for x in (F.lit(k), F.lit(json.dumps(v)))])
    doc = F.element_at(doc_map, F.col("stream"))
    per_stream = counts.select(
        "replay_id", "stream",
        F.concat(F.lit('{"num_rows": '), F.col("num_rows").cast("string"), F.lit(", "),
                 F.substring(doc, 2, 1 << 30)).alias("body"))
    return per_stream.groupBy("replay_id").agg(
        F.concat(F.lit('{"replay_id": "'), F.col("replay_id"),
                 F.lit(f'", "schema_version": "{version}", "streams": {{'),
                 F.array_join(F.array_sort(F.collect_list(F.concat(
                     F.lit('"'), F.col("stream"), F.lit('": '), F.col("body")))), ", "),
                 F.lit("}}")).alias("schema_json"))


# --------------------------------------------------------------------------- bundles
def prepare(df: DataFrame, stream: str, contract: Contract | None = None) -> DataFrame:
    contract = contract if contract is not None else CONTRACTS.get(stream)
    return encode_nulls(apply_contract(df, contract), contract)


def row_major_bundle(streams: dict[str, DataFrame], orders: dict[str, Sequence[str]] | None = None
                     ) -> tuple[DataFrame | None, DataFrame | None]:
    """SNK-3: streams whose contract layout is row-major -> (chunks, schema)."""
    chunks, docs = [], {}
    for name, df in streams.items():
        c = CONTRACTS.get(name)
        if c is None or c.layout != "row-major-mixed":
            continue
        p = prepare(df, name, c)
        try:
            docs[name] = stream_schema(p, name, "row-major-mixed")
        except TypeError as e:  # unsupported dtype: skip the stream
            log.warning("stream %s skipped for row-major output: %s", name, e)
            continue
        chunks.append(pack_row_major(p, name, (orders or {}).get(name, ("frame", "row_ord"))))
    if not chunks:
        return None, None
    allc = chunks[0]
    for c in chunks[1:]:
        allc = allc.unionByName(c)
    return allc, schema_rows(allc, docs, ROW_MAJOR_VERSION)


def columnar_bundle(streams: dict[str, DataFrame], orders: dict[str, Sequence[str]] | None = None
                    ) -> tuple[DataFrame | None, DataFrame | None]:
    """SNK-4: every stream not laid out row-major -> (chunks, schema)."""
    chunks, docs = [], {}
    for name, df in streams.items():
        c = CONTRACTS.get(name)
        if c is not None and c.layout == "row-major-mixed":
            continue
        p = prepare(df, name, c)
        docs[name] = stream_schema(p, name, "columnar")
        chunks.append(pack_columnar(p, name, (orders or {}).get(name, ("frame", "row_ord"))))
    if not chunks:
        return None, None
    allc = chunks[0]
    for c in chunks[1:]:
        allc = allc.unionByName(c)
    allc = rebase(allc)
    return allc, schema_rows(allc, docs, COLUMNAR_VERSION)


def write_chunks(chunks: DataFrame, out_dir: str, mode: str = "overwrite") -> None:
    chunks.write.mode(mode).partitionBy("replay_id", "stream").parquet(out_dir)


# --------------------------------------------------------------------------- readers
def read_row_major(chunks: DataFrame, stream: str, dtype: np.dtype,
                   schema: T.StructType) -> DataFrame:
    """Decode row-major chunks back into rows (each chunk independently; the
    chunk keys are kept so the original order can be restored)."""
    names = list(dtype.names)
    # Spark's Arrow reader has no unsigned types: widen to int64 / float64.
    wide = {n: np.dtype("int64") if dtype[n].kind in "iu" else np.dtype("float64") for n in names}
    arrow_schema = pa.schema([("replay_id", pa.string()), ("part", pa.int32()),
                              ("seq", pa.int32()), ("row", pa.int64())]
                             + [(n, pa.from_numpy_dtype(wide[n])) for n in names])

    def unpack(batches):
        import zstandard
        d = zstandard.ZstdDecompressor()
        for b in batches:
            first, waiting, rows = 0, [], 0
            for i, blob in enumerate(b.column(3)):
                waiting.append(np.frombuffer(d.decompressobj().decompress(blob.as_py()),
                                             dtype=dtype))
                rows += len(waiting[-1])
                if rows >= UNPACK_ROWS or i + 1 == b.num_rows:
                    sizes = [len(w) for w in waiting]
                    chunk = pa.array(np.repeat(np.arange(first, i + 1), sizes))
                    rec = np.concatenate(waiting)
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(c).take(chunk) for c in range(3)),
                         pa.array(np.concatenate([np.arange(n, dtype=np.int64) for n in sizes])),
                         *(pa.array(rec[n].astype(wide[n])) for n in names)],
                        schema=arrow_schema)
                    first, waiting, rows = i + 1, [], 0

    out_schema = T.StructType([
        T.StructField("replay_id", T.StringType()), T.StructField("part", T.IntegerType()),
        T.StructField("seq", T.IntegerType()), T.StructField("row", T.LongType())]
        + [T.StructField(f.name, f.dataType) for f in schema.fields if f.name in names])
    return chunks.filter(F.col("data_key") == f"{stream}.rows").select(
        "replay_id", "part", "seq", "blob").mapInArrow(unpack, out_schema)


def decode_column(t: T.DataType, key: str, logical: str | None, blobs: dict[str, bytes],
                  bases: dict[str, int], rows: int) -> pa.Array:
    """One column of a chunk, from the buffers of its keys (recursive)."""
    def local(name: str) -> np.ndarray:
        """Offsets of ``rows`` + 1 entries from 0."""
        offs = np.frombuffer(blobs[name], "<u4").astype(np.int64) - bases[name]
        return (offs if len(offs) == rows + 1 else np.concatenate([[0], offs])).astype(np.int32)

    if isinstance(t, T.ArrayType):
        if isinstance(t.elementType, T.StructType):
            offs = local(f"{key}_list_offs")
            fields = [decode_column(f.dataType, f"{key}.{f.name}", None, blobs, bases,
                                    int(offs[-1])) for f in t.elementType]
            child = pa.StructArray.from_arrays(fields, t.elementType.names)
        else:
            offs = local(f"{key}_offs")
            child = decode_column(t.elementType, f"{key}_vals", None, blobs, bases, int(offs[-1]))
        return pa.ListArray.from_arrays(pa.array(offs), child)
    if isinstance(t, T.StringType):
        return pa.StringArray.from_buffers(rows, pa.py_buffer(local(f"{key}_offs").tobytes()),
                                           pa.py_buffer(blobs[f"{key}_data"]))
    if isinstance(t, T.BooleanType):
        return pa.array(np.frombuffer(blobs[key], "u1").astype(bool))
    code = _NUMPY[logical or logical_type(t)]
    values = np.frombuffer(blobs[key], dtype=code)
    return pa.array(values).cast(to_arrow_type(t), safe=False)


def column_keys(t: T.DataType, key: str) -> list[str]:
    """The keys that a column of type ``t`` is kept under."""
    if isinstance(t, T.ArrayType):
        if isinstance(t.elementType, T.StructType):
            return [f"{key}_list_offs", *(k for f in t.elementType
                                          for k in column_keys(f.dataType, f"{key}.{f.name}"))]
        return [f"{key}_offs", *column_keys(t.elementType, f"{key}_vals")]
    return [f"{key}_offs", f"{key}_data"] if isinstance(t, T.StringType) else [key]


def _nullable(t: T.DataType) -> T.DataType:
    """The type with values that may be null at every level, as decoded columns have."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_nullable(t.elementType))
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in t])
    return t


def read_columnar(chunks: DataFrame, stream: str, columns: Sequence[tuple]) -> DataFrame:
    """Decode columns of columnar chunks back into rows.

    ``columns`` are (name, logical type) or (name, logical type or ``None``, Spark
    type) for strings and lists.  A chunk's buffers (one row per key) form one
    small group, so no group grows with the data; other columns are not opened.
    """
    columns = [(c[0], c[1], _nullable(c[2] if len(c) > 2 else TYPES[c[1]][0])) for c in columns]
    fixed = [("replay_id", T.StringType()), ("part", T.IntegerType()), ("seq", T.IntegerType()),
             ("row", T.LongType())]
    out_schema = T.StructType([T.StructField(n, t) for n, t in fixed]
                              + [T.StructField(n, t) for n, _, t in columns])

    def unpack(table: pa.Table) -> pa.Table:
        import zstandard
        d = zstandard.ZstdDecompressor()
        keys = table.column("data_key").to_pylist()
        blobs = {k: d.decompressobj().decompress(b)
                 for k, b in zip(keys, table.column("blob").to_pylist())}
        bases = dict(zip(keys, table.column("base").to_pylist()))
        n = table.column("num_rows")[0].as_py()
        out = {c: pa.array([table.column(c)[0].as_py()] * n, to_arrow_type(t))
               for c, t in fixed[:3]}
        out["row"] = pa.array(np.arange(n, dtype=np.int64))
        for name, logical, t in columns:
            out[name] = decode_column(t, f"{stream}.{name}", logical, blobs, bases, n)
        return pa.table(out)

    keys = [k for name, _, t in columns for k in column_keys(t, f"{stream}.{name}")]
    return (chunks.filter(F.col("data_key").isin(keys))
            .groupBy("replay_id", "part", "seq").applyInArrow(unpack, out_schema))
