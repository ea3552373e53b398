"""Aspect scan: positional telemetry files -> typed clean tables.

Layout: ``<root>/<replay_id>/<aspect>.mpk`` (MessagePack stream of positional
lists), or JSON-lines / Parquet files holding one positional array per row.

1. *discover* (SRC-1/SRC-7): tasks list the folders of each root (``binaryFile``
   where only Spark reads the store); when the same (replay, aspect) exists under
   several roots the later root wins.  The
   override is an anti-join on file metadata only, so file contents are never
   shuffled.
2. *decode* (SRC-2): ``mapInArrow`` in the executors turns byte ranges of the
   files into rows ``(replay_id, aspect, row_ord, vals)``; every value is tagged
   with its MessagePack kind (``i:``, ``f:``, ``b:``, ``s:``, ``x:``).  Record
   boundaries inside a file are searched and checked (``mpk_split``), so a long
   file is read by several tasks; output is emitted in bounded batches.  Stores
   that only Spark reads fall back to whole files (``binaryFile``).
3. *bind* (ING-1..7): all JVM-side -- positional ``get``, kind checks and
   ``try_cast`` validation, dequantization, enum code -> name, typed select.
   Bad rows go to a quarantine table ``(replay_id, aspect, row_ord, reason,
   raw)``; ``on_error="fail"`` raises instead.
"""

from __future__ import annotations

import fnmatch
import json
import logging
import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..enums import ENUMS
from ..schemas import ASPECTS, Field
from ..scratch import stored
from . import mpk_split
from .msgpack_lite import iter_records

log = logging.getLogger(__name__)

RAW_SCHEMA = T.StructType([
    T.StructField("replay_id", T.StringType(), False),
    T.StructField("aspect", T.StringType(), False),
    T.StructField("row_ord", T.LongType(), False),
    T.StructField("vals", T.ArrayType(T.StringType(), True), True),
    T.StructField("decode_error", T.StringType(), True),
])

_PATH_ASPECT = r"([^/]+)\.[A-Za-z0-9]+$"
_PATH_REPLAY = r"([^/]+)/[^/]+$"
BATCH_ROWS = 8192


# --------------------------------------------------------------------------- discover
#: Stores whose folders and files executors open at any place.
RANGED = ("", "file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")
_LISTED = pa.schema([("path", pa.string()), ("folder", pa.bool_()), ("length", pa.int64()),
                     ("millis", pa.int64())])


def _children(path: str, glob: str, deep: bool) -> Iterator[tuple]:
    """(path, folder, length, millis) of what a folder holds, without hidden names."""
    from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
    if path.startswith("file:"):
        fs, name = LocalFileSystem(), re.sub("^file:(//)?", "", path)
    else:
        fs, name = FileSystem.from_uri(path)
    for info in fs.get_file_info(FileSelector(name)):
        base = info.base_name
        if base.startswith(".") or base.startswith("_") and "=" not in base:
            continue
        child = f"{path.rstrip('/')}/{base}"
        if info.type == FileType.Directory:
            if deep:
                yield from _children(child, glob, True)
            else:
                yield child, True, None, None
        elif info.type == FileType.File and fnmatch.fnmatchcase(base, glob):
            yield child, False, info.size, info.mtime_ns // 1_000_000


def _expanded(found: DataFrame, glob: str, deep: bool) -> DataFrame:
    """The rows with folders replaced by what they hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for new in _children(row[0], glob, deep) if row[1] else [row]:
                    rows.append(new)
                    if len(rows) >= BATCH_ROWS:
                        yield _listed(rows)
                        rows = []
            yield _listed(rows)

    return found.mapInArrow(run, "path string, folder boolean, length long, millis long")


def _listed(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_LISTED)
    return pa.record_batch([pa.array(list(c), f.type) for c, f in
                            zip(columns, _LISTED, strict=True)], schema=_LISTED)


def _list_in_tasks(spark: SparkSession, root: str, glob: str) -> DataFrame | None:
    """The files below a folder, listed by tasks: no list of all files is on the driver.

    ``None`` where only Spark's own listing will do.
    """
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if (re.search(r"[*?{}\[\]\\]", root) or fs.getUri().getScheme() not in RANGED
            or not fs.exists(where) or not fs.getFileStatus(where).isDirectory()):
        return None
    found = spark.createDataFrame([(fs.makeQualified(where).toString(), True, None, None)],
                                  "path string, folder boolean, length long, millis long")
    tasks = spark.sparkContext.defaultParallelism
    for deep in (False, False, True):       # folders of two levels are dealt to tasks
        found = _expanded(found, glob, deep).repartition(tasks, "path")
    return stored(found.select("path", "length", F.timestamp_millis("millis").alias("modified")),
                  "listed")


def _list(spark: SparkSession, root: str, glob: str, with_content: bool) -> DataFrame | None:
    listed = None if with_content else _list_in_tasks(spark, root, glob)
    if listed is not None:
        return listed.select("*", F.regexp_extract("path", _PATH_REPLAY, 1).alias("replay_id"),
                             F.regexp_extract("path", _PATH_ASPECT, 1).alias("aspect"))
    try:
        df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true").load(root))
    except Exception as e:  # missing directory: warn and continue
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            log.warning("input directory %s not found; skipped", root)
            return None
        raise
    cols = [F.col("path"), F.col("length"), F.col("modificationTime").alias("modified")]
    if with_content:
        cols.append(F.col("content"))
    return df.select(
        *cols,
        F.regexp_extract("path", _PATH_REPLAY, 1).alias("replay_id"),
        F.regexp_extract("path", _PATH_ASPECT, 1).alias("aspect"),
    )


def discover(spark: SparkSession, roots: Sequence[str], glob: str = "*.mpk",
             aspects: Iterable[str] | None = None, with_content: bool = True) -> DataFrame:
    """Files of the given aspects under ``roots``; a later root overrides an
    earlier one for the same (replay, aspect)."""
    wanted = list(aspects) if aspects is not None else None
    per_root = []
    for i, root in enumerate(roots):
        df = _list(spark, root, glob, with_content)
        if df is None:
            continue
        if wanted is not None:
            df = df.filter(F.col("aspect").isin(wanted))
        per_root.append((i, df))
    if not per_root:
        return spark.createDataFrame([], "path string, length long, modified timestamp, replay_id "
                                     "string, aspect string"
                                     + (", content binary" if with_content else ""))
    out = None
    for n, (i, df) in enumerate(per_root):
        later = [d.select("replay_id", "aspect") for _, d in per_root[n + 1:]]
        if later:
            shadow = later[0]
            for d in later[1:]:
                shadow = shadow.unionByName(d)
            df = df.join(shadow.distinct().hint("merge"), ["replay_id", "aspect"], "left_anti")
        out = df if out is None else out.unionByName(df)
    return out


def manifest(spark: SparkSession, roots: Sequence[str], glob: str = "*.mpk") -> DataFrame:
    """Dry-run ingest manifest (SRC-7): aspect and size in KB per file; reads
    no file contents."""
    files = discover(spark, roots, glob, with_content=False)
    return files.select("replay_id", "aspect", "path",
                        (F.col("length") / F.lit(1024.0)).alias("size_kb"))


# --------------------------------------------------------------------------- decode
def _tag(v) -> str | None:
    if v is None:
        return None
    if v is True or v is False:
        return "b:" + ("true" if v else "false")
    if isinstance(v, int):
        return f"i:{v}"
    if isinstance(v, float):
        return f"f:{v!r}"
    if isinstance(v, str):
        return "s:" + v
    if isinstance(v, (bytes, bytearray)):
        return "x:" + bytes(v).hex()
    return "x:" + json.dumps(v, default=str)


_RAW_ARROW = pa.schema([("replay_id", pa.string()), ("aspect", pa.string()),
                        ("row_ord", pa.int64()), ("vals", pa.list_(pa.string())),
                        ("decode_error", pa.string())])


def _record_batches(replay: str, aspect: str, first_row: int, content: bytes,
                    error: str | None = None) -> Iterable[pa.RecordBatch]:
    """Raw rows of a run of records, in bounded batches.

    ``error`` is why the records end where they do; it takes the place of the
    broken record that the decoder would find there.
    """
    rows: list[tuple] = []

    def flush() -> pa.RecordBatch:
        n, columns = len(rows), list(zip(*rows, strict=True))
        rows.clear()
        return pa.record_batch([pa.array([replay] * n), pa.array([aspect] * n),
                                *(pa.array(list(c), f.type) for c, f in
                                  zip(columns, list(_RAW_ARROW)[2:], strict=True))],
                               schema=_RAW_ARROW)

    for i, (rec, err) in enumerate(iter_records(content), first_row):
        if err is not None and error is not None:
            err = error
        elif err is None and not isinstance(rec, list):
            rec, err = None, "record is not a positional list"
        rows.append((i, None if rec is None else [_tag(v) for v in rec], err))
        if len(rows) >= BATCH_ROWS:
            yield flush()
    if rows:
        yield flush()


def _decode_batches(batches):
    for batch in batches:
        d = batch.to_pydict()
        for replay, aspect, content in zip(d["replay_id"], d["aspect"], d["content"]):
            yield from _record_batches(replay, aspect, 0, content)


def decode_files(files: DataFrame) -> DataFrame:
    """files(replay_id, aspect, content) -> raw positional rows, one task a file."""
    return files.select("replay_id", "aspect", "content").mapInArrow(_decode_batches, RAW_SCHEMA)


def decode_split(files: DataFrame, split: int | None = None, store: str | None = None) -> DataFrame:
    """files(path, length, modified, replay_id, aspect) -> raw rows, read by byte ranges.

    ``split`` is the size of a range, by default one that gives all cores work.
    ``store`` keeps the index of record boundaries for later reads.
    """
    if split is None:
        total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        split = mpk_split.split_size(total, files.sparkSession.sparkContext.defaultParallelism)
    ranges = mpk_split.indexed(files, split, store) if store else mpk_split.index(files, split)
    return mpk_split.decode(ranges, _record_batches, RAW_SCHEMA)


def read_raw(spark: SparkSession, roots: Sequence[str], aspects: Iterable[str],
             split: int | None = None, store: str | None = None) -> DataFrame:
    """Raw rows of the MessagePack files under ``roots``."""
    names = list(aspects)
    files = discover(spark, roots, aspects=names, with_content=False)
    schemes = {r[0] for r in files.select(
        F.regexp_extract("path", "^([a-z0-9]+):", 1)).distinct().collect()}
    if schemes <= set(RANGED):
        return decode_split(files, split, store)
    return decode_files(discover(spark, roots, aspects=names))


def positional_json(spark: SparkSession, path: str, replay_id: str | None = None,
                    aspect: str | None = None) -> DataFrame:
    """JSON lines, one positional array per line -> raw rows (replay and
    aspect from the path unless given)."""
    # a split's rows are fewer than its bytes, so the sum keeps the order of the file
    in_split = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    txt = spark.read.text(path).select(
        F.input_file_name().alias("path"), "value",
        (F.col("_metadata.file_block_start") + in_split).alias("__id"))
    arr = F.from_json("value", T.ArrayType(T.StringType()))
    return _from_array(txt, arr, replay_id, aspect, order="__id")


def positional_parquet(spark: SparkSession, path: str, column: str = "vals",
                       replay_id: str | None = None, aspect: str | None = None,
                       replay_column: str | None = None) -> DataFrame:
    """Parquet with an ``array<string>`` positional column -> raw rows.

    The replay is named by ``replay_column``, or ``replay_id``, or else the path.
    """
    df = spark.read.parquet(path).select(
        F.input_file_name().alias("path"), F.col(column).alias("value"),
        F.col("_metadata.row_index").alias("__id"),
        *([F.col(replay_column).cast("string").alias("__replay")] if replay_column else []))
    return _from_array(df, F.col("value"), F.col("__replay") if replay_column else replay_id,
                       aspect, order="__id")


def _from_array(df: DataFrame, arr: Column, replay_id, aspect, order: str) -> DataFrame:
    rid = (F.regexp_extract("path", _PATH_REPLAY, 1) if replay_id is None else
           replay_id if isinstance(replay_id, Column) else F.lit(replay_id))
    asp = F.lit(aspect) if aspect else F.regexp_extract("path", _PATH_ASPECT, 1)
    tagged = F.transform(arr, lambda v: _tag_expr(v))
    return df.select(
        rid.alias("replay_id"), asp.alias("aspect"), F.col(order).alias("row_ord"),
        tagged.alias("vals"),
        F.when(arr.isNull(), F.lit("line is not a JSON array")).alias("decode_error"))


def _tag_expr(v: Column) -> Column:
    """Text without a kind of its own; the declared type of its field decides."""
    return F.when(v.isNotNull(), F.concat(F.lit("u:"), v))


# --------------------------------------------------------------------------- bind
def _field_value(f: Field, raw: Column, on_bad_enum: str) -> tuple[Column, Column]:
    """(typed value, error message or null) for one positional field."""
    kind = F.substring(raw, 1, 1)
    payload = F.substr(raw, F.lit(3))
    as_long = F.when((kind == "i") | (kind == "u") & payload.rlike("^[+-]?[0-9]+$"),
                     payload.try_cast("long")).when(
        kind.isin("f", "u") & (payload.try_cast("double") == F.floor(payload.try_cast("double"))),
        payload.try_cast("double").try_cast("long")).when(kind == "s", payload.try_cast("long"))
    if f.enum is not None or f.divisor is not None or f.kind == "long":
        val = as_long
        want = "integer"
    elif f.kind == "double":
        val = F.when(kind.isin("i", "f", "s", "u"), payload.try_cast("double"))
        want = "number"
    elif f.kind == "bool":
        val = F.when(kind == "b", payload == "true").when(
            (kind == "u") & payload.isin("true", "false"), payload == "true").when(
            kind.isin("i", "u") & payload.isin("0", "1"), payload == "1")
        want = "boolean"
    else:
        val = F.when(kind.isin("s", "u"), payload)
        want = "string"
    err = F.when(raw.isNotNull() & val.isNull(),
                 F.lit(f"{f.name}: expected {want}"))
    if not f.nullable:
        err = F.coalesce(err, F.when(raw.isNull(), F.lit(f"{f.name}: required value missing")))
    if f.divisor is not None:
        val = val / F.lit(f.divisor)
    if f.enum is not None:
        codes = ENUMS[f.enum]
        lookup = F.create_map(*[x for k, v in codes.items() for x in (F.lit(k), F.lit(v))])
        name = F.try_element_at(lookup, val.try_cast("int"))
        if on_bad_enum == "reject":
            err = F.coalesce(err, F.when(val.isNotNull() & name.isNull(),
                                         F.concat(F.lit(f"{f.name}: unknown {f.enum} code "),
                                                  val.cast("string"))))
        val = name
    return val.cast(f.clean_type), err


#: Why a row is rejected, the first that applies; accepted rows are ``OK``.
OK = "ok"
REJECTS = ("decode", "length", "required", "type", "enum")
REJECT = "reject"


def _checked(raw: DataFrame, aspect: str, on_bad_enum: str) -> DataFrame:
    """Every row of an aspect typed, with all its faults in ``__err`` and their kind."""
    if on_bad_enum not in ("reject", "null"):
        raise ValueError("on_bad_enum must be reject|null")
    fields = ASPECTS[aspect]
    vals = F.col("vals")
    typed, errs = [], [F.col("decode_error"),
                       F.when(F.size(vals) > len(fields),
                              F.concat(F.lit(f"{aspect}: {len(fields)} fields, got "),
                                       F.size(vals).cast("string")))]
    for i, f in enumerate(fields):
        v, e = _field_value(f, F.get(vals, i), on_bad_enum)
        typed.append(v.alias(f.name))
        errs.append(e)
    checked = raw.filter(F.col("aspect") == aspect).select(
        "replay_id", "row_ord", vals.alias("__vals"), *typed, "decode_error",
        F.concat_ws("; ", *errs).alias("__err"))
    err = F.col("__err")
    kind = (F.when(err == "", OK).when(F.col("decode_error").isNotNull(), "decode")
            .when(F.size("__vals") > len(fields), "length")
            .when(err.contains(": required value missing"), "required")
            .when(err.contains(": expected "), "type").otherwise("enum"))
    return checked.select("replay_id", "row_ord", "__vals", *[f.name for f in fields],
                          kind.alias(REJECT), F.when(err != "", err).alias("__err"))


def _clean(checked: DataFrame, aspect: str) -> DataFrame:
    return checked.select("replay_id", *[f.name for f in ASPECTS[aspect]], "row_ord")


def _quarantine(checked: DataFrame, aspect: str) -> DataFrame:
    return checked.select(
        "replay_id", F.lit(aspect).alias("aspect"), "row_ord", F.col("__err").alias("reason"),
        F.array_join(F.col("__vals"), "|", "null").alias("raw"))


def bind(raw: DataFrame, aspect: str, on_bad_enum: str = "reject",
         on_error: str = "skip") -> tuple[DataFrame, DataFrame]:
    """Positional raw rows of one aspect -> (clean table, quarantine).

    Short rows are null-padded, long rows rejected (ING-1); per-field type and
    nullability checks (ING-2); ``on_error``: ``"skip"`` quarantines bad rows,
    ``"fail"`` raises on the first one (ING-3); dequantize (ING-4); enum code
    -> name with ``on_bad_enum`` ``"reject"`` or ``"null"`` (ING-5/DEC-1);
    typed select (ING-7).  Both results read ``raw`` on their own; ``split_once``
    reads it once."""
    if on_error not in ("skip", "fail"):
        raise ValueError("on_error must be skip|fail")
    checked = _checked(raw, aspect, on_bad_enum)
    bad = F.col("__err").isNotNull()
    if on_error == "fail":
        guard = F.when(bad, F.raise_error(F.concat(
            F.lit(f"bad {aspect} record in replay "), F.col("replay_id"), F.lit(" row "),
            F.col("row_ord").cast("string"), F.lit(": "), F.col("__err")))).otherwise(F.lit(True))
        clean = checked.filter(guard.cast("boolean"))
    else:
        clean = checked.filter(~bad)
    return _clean(clean, aspect), _quarantine(checked.filter(bad), aspect)


def split_once(raw: DataFrame, aspect: str, path: str, on_bad_enum: str = "reject",
               mode: str = "errorifexists") -> tuple[DataFrame, DataFrame]:
    """``bind`` with one decode: rows are checked once and written to ``path`` by reject kind.

    The clean table and the quarantine are read from there; each reads its own
    partitions only.  Raw values are kept for rejected rows alone.
    """
    checked = _checked(raw, aspect, on_bad_enum)
    (checked.withColumn("__vals", F.when(F.col("__err").isNotNull(), F.col("__vals")))
     .write.mode(mode).option("compression", "zstd").partitionBy(REJECT).parquet(path))
    return read_split(raw.sparkSession, [path], aspect)


def read_split(spark: SparkSession, paths: Sequence[str], aspect: str
               ) -> tuple[DataFrame, DataFrame]:
    """(clean table, quarantine) of tables that ``split_once`` has written."""
    checked = split_rows(spark, paths, aspect)
    return (_clean(checked.where(F.col(REJECT) == OK), aspect),
            _quarantine(checked.where(F.col(REJECT).isin(*REJECTS)), aspect))


def split_rows(spark: SparkSession, paths: Sequence[str], aspect: str) -> DataFrame:
    fields = [T.StructField(f.name, f.clean_type) for f in ASPECTS[aspect]]
    schema = T.StructType([
        T.StructField("replay_id", T.StringType()), T.StructField("row_ord", T.LongType()),
        T.StructField("__vals", T.ArrayType(T.StringType())), *fields,
        T.StructField("__err", T.StringType()), T.StructField(REJECT, T.StringType())])
    out = None
    for path in paths:
        part = spark.read.schema(schema).parquet(path)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def scan(spark: SparkSession, roots: Sequence[str], aspects: Iterable[str] | None = None,
         on_bad_enum: str = "reject", on_error: str = "skip", split: int | None = None,
         store: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Scan MessagePack aspect files under ``roots`` -> ({aspect: clean}, quarantine).

    ``split`` and ``store`` as in ``decode_split``.
    """
    names = list(aspects) if aspects is not None else list(ASPECTS)
    unknown = [a for a in names if a not in ASPECTS]
    if unknown:
        log.warning("no schema for aspects %s; skipped", unknown)
    names = [a for a in names if a in ASPECTS]
    tables, quarantines = {}, []
    for a in names:
        raw = read_raw(spark, roots, [a], split, store and f"{store.rstrip('/')}/{a}")
        clean, q = bind(raw, a, on_bad_enum, on_error)
        tables[a] = clean
        quarantines.append(q)
    quarantine = quarantines[0]
    for q in quarantines[1:]:
        quarantine = quarantine.unionByName(q)
    return tables, quarantine
