"""WARC archives as a Spark data source: ``format("warc")``, both ways.

Writing.  Every task writes one archive of gzip members, one member a record.
The gzip header's extra field ``SL`` holds the member's compressed and plain
lengths.  Files become visible under their names only when the job commits.

Reading.  Files are listed on the driver and cut into byte ranges; a range owns
the members that start in it, and finds the first by the member header.  Of
each member only the start is inflated, up to the end of the WARC header;
predicates on the record type and other header columns are pushed down and
decided there.  With the length in ``SL`` the reader then seeks to the next
member, so payloads that no one asked for (``payload`` = ``false``, or filtered
out) are neither read nor inflated.  Archives of other writers, gzip members
without ``SL`` or plain records, are read too, one file a task.

``mark_revisits`` finds records with equal payloads.  Of those with at least
``min_bytes`` bytes the one with the smallest id is the response, the others
are revisits of it and carry no payload.

Cases: a null payload counts as empty; rows that repeat the smallest id of a
payload are all responses; a null id is a revisit if an equal payload has an
id, else a response; line breaks in a URL are percent-encoded; an empty table
makes archives without records, which read back as no rows; other columns are
not written.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo,
                                    Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
                                    IsNotNull, IsNull, LessThan, LessThanOrEqual,
                                    WriterCommitMessage)

SCHEMA = ("page_id long, target_uri string, record_type string, record_id string, "
          "refers_to long, payload_bytes long, payload_digest string, payload binary")
MIN_REVISIT_BYTES = 100
SPLIT_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
_MEMBER = re.compile(rb"\x1f\x8b\x08\x04.{6}\x14\x00SL\x10\x00", re.S)
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    length = 10 + 2 + 20 + len(body) + 8
    return (b"\x1f\x8b\x08\x04" + struct.pack("<IBB", 0, 0, 255) + struct.pack("<H", 20)
            + b"SL" + struct.pack("<HQQ", 16, length, len(data)) + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def _record(row: dict, date: str) -> bytes:
    payload = b"" if row["record_type"] == "revisit" else row["payload"] or b""
    uri = (row["target_uri"] or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", _record_id(row["page_id"])),
            ("WARC-Date", date), ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
            ("X-Payload-Length", str(row["payload_bytes"]))]
    if row["page_id"] is not None:
        head.append(("X-Page-Id", str(row["page_id"])))
    if row["record_type"] == "revisit":
        head += [("WARC-Profile", _REVISIT_PROFILE),
                 ("WARC-Refers-To", _record_id(row["refers_to"])),
                 ("X-Refers-To-Page", str(row["refers_to"]))]
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(payload)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
            ).encode() + payload + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    temporary: str
    name: str


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.level = int(options.get("level", "6"))
        self.date = options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext
        fs, root = _filesystem(self.path)
        attempt = uuid.uuid4().hex
        temporary = f"{root}/_temporary/{attempt}"
        fs.create_dir(f"{root}/_temporary", recursive=True)
        with fs.open_output_stream(temporary, compression=None) as out:
            for batch in iterator:
                for row in batch.to_pylist():
                    out.write(_member(_record(row, self.date), self.level))
        return _Written(temporary, f"{root}/part-{TaskContext.get().partitionId():06d}-"
                                   f"{attempt}.warc.gz")

    def commit(self, messages: list) -> None:
        fs, root = _filesystem(self.path)
        fs.create_dir(root, recursive=True)
        for m in messages:
            if m is not None:
                fs.move(m.temporary, m.name)
        self.abort([])

    def abort(self, messages: list) -> None:
        fs, root = _filesystem(self.path)
        if fs.get_file_info(f"{root}/_temporary").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/_temporary")


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int
    indexed: bool

    def __post_init__(self) -> None:
        super().__init__(None)


def _headers(text: bytes) -> dict[str, str]:
    out = {}
    for line in text.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        out[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def _long(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


def _row(head: dict[str, str], payload: bytes | None) -> dict:
    digest = head.get("warc-payload-digest")
    return {"page_id": _long(head.get("x-page-id")), "target_uri": head.get("warc-target-uri"),
            "record_type": head.get("warc-type"), "record_id": head.get("warc-record-id"),
            "refers_to": _long(head.get("x-refers-to-page")),
            "payload_bytes": _long(head.get("x-payload-length", head.get("content-length"))),
            "payload_digest": digest.rpartition(":")[2] if digest else None, "payload": payload}


_TESTS = {EqualTo: lambda x, v: x == v, In: lambda x, v: x in v, LessThan: lambda x, v: x < v,
          LessThanOrEqual: lambda x, v: x <= v, GreaterThan: lambda x, v: x > v,
          GreaterThanOrEqual: lambda x, v: x >= v}


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.payload = options.get("payload", "true").lower() == "true"
        self.split_bytes = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))
        self.wanted: list[tuple[type, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else "payload"
            if column == "payload" or type(f) not in (*_TESTS, IsNull, IsNotNull):
                yield f
            else:
                self.wanted.append((type(f), column, getattr(f, "value", None)))

    def partitions(self) -> list[Split]:
        fs, root = _filesystem(self.path)
        info = fs.get_file_info(root)
        files = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(root))
        out = []
        for f in sorted((f for f in files if f.is_file and not f.base_name.startswith(("_", "."))),
                        key=lambda f: f.path):
            with fs.open_input_file(f.path) as data:
                indexed = bool(_MEMBER.match(data.read(32)))
            step = self.split_bytes if indexed else max(f.size, 1)
            out += [Split(f.path, a, min(a + step, f.size), indexed)
                    for a in range(0, f.size, step)]
        # Spark asks for one split at least
        return out or [Split("", 0, 0, True)]

    def _keeps(self, row: dict) -> bool:
        for kind, column, value in self.wanted:
            x = row[column]
            if kind is IsNull:
                if x is not None:
                    return False
            elif x is None or kind is not IsNotNull and not _TESTS[kind](x, value):
                return False
        return True

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "target_uri", "record_type", "record_id", "refers_to",
                 "payload_bytes", "payload_digest", "payload"]
        kinds = [pa.int64(), *[pa.string()] * 3, pa.int64(), pa.int64(), pa.string(), pa.binary()]

        def batch(rows: list[dict]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[n] for r in rows], k)
                                    for n, k in zip(names, kinds, strict=True)], names)

        if split.end == 0:
            return
        fs, _ = _filesystem(self.path)
        rows, size = [], 0
        with fs.open_input_file(split.path) as data:
            found = self._indexed(data, split) if split.indexed else self._stream(data)
            for row in found:
                rows.append(row)
                size += 300 + len(row["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)

    def _indexed(self, data: pa.NativeFile, split: Split) -> Iterator[dict]:
        at = self._first(data, split)
        while at is not None and at < split.end:
            data.seek(at)
            start = data.read(4096)
            length, plain = struct.unpack_from("<QQ", start, 16)
            inflate = zlib.decompressobj(-15)
            text = inflate.decompress(start[32:], 4096)
            while b"\r\n\r\n" not in text and not inflate.eof:
                more = inflate.unconsumed_tail or data.read(4096)
                text += inflate.decompress(more, 4096)
            head, _, begun = text.partition(b"\r\n\r\n")
            headers = _headers(head)
            row = _row(headers, None)
            if self._keeps(row):
                if self.payload:
                    data.seek(at)
                    whole = zlib.decompress(data.read(length)[32:-8], -15, plain or 1)
                    n = int(headers.get("content-length", "0"))
                    row["payload"] = whole[len(head) + 4:len(head) + 4 + n]
                yield row
            at += length

    def _first(self, data: pa.NativeFile, split: Split) -> int | None:
        """Where the first member of the range starts."""
        if split.start == 0:
            return 0
        at, window = split.start, 1 << 20
        while at < split.end:
            data.seek(at)
            block = data.read(window + 64)
            for m in _MEMBER.finditer(block):
                try:
                    if zlib.decompressobj(-15).decompress(block[m.start() + 32:], 5) == b"WARC/":
                        return at + m.start()
                except zlib.error:
                    continue
            if len(block) < window + 64:
                return None
            at += window
        return None

    def _stream(self, data: pa.NativeFile) -> Iterator[dict]:
        """Records of plain archives and of gzip members without lengths."""
        zipped = data.read(2) == b"\x1f\x8b"
        data.seek(0)
        source = _Inflated(data) if zipped else data
        buffer = b""
        while True:
            while b"\r\n\r\n" not in buffer.lstrip(b"\r\n"):
                more = source.read(1 << 16)
                if not more:
                    return
                buffer += more
            head, _, buffer = buffer.lstrip(b"\r\n").partition(b"\r\n\r\n")
            headers = _headers(head)
            n = int(headers.get("content-length", "0"))
            row = _row(headers, None)
            wanted = self._keeps(row)
            if not zipped and not (wanted and self.payload) and n > len(buffer):
                data.seek(data.tell() + n - len(buffer))
                buffer = b""
            else:
                parts = [buffer]
                have = len(buffer)
                while have < n:
                    more = source.read(1 << 16)
                    if not more:
                        break
                    parts.append(more)
                    have += len(more)
                buffer = b"".join(parts)
                if wanted and self.payload:
                    row["payload"] = buffer[:n]
                buffer = buffer[n:]
            if wanted:
                yield row


class _Inflated:
    """Plain bytes of concatenated gzip members."""

    def __init__(self, data: pa.NativeFile):
        self.data, self.inflate, self.rest = data, zlib.decompressobj(31), b""

    def read(self, n: int) -> bytes:
        while True:
            if self.inflate.eof:
                self.rest = self.inflate.unused_data
                self.inflate = zlib.decompressobj(31)
            block = self.rest or self.data.read(n)
            if not block:
                return b""
            out = self.inflate.decompress(block, 1 << 20)
            self.rest = self.inflate.unconsumed_tail
            if out:
                return out


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def mark_revisits(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url",
                  payload_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Rows of ``SCHEMA`` for every page; revisits have no payload."""
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(uri_col).alias("target_uri"), body.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       F.sha2("payload", 256).alias("payload_digest"))
    first = (rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("payload_digest", "first_id"))
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(first, "payload_digest", "left").select(
        "page_id", "target_uri", F.when(again, "revisit").otherwise("response")
        .alias("record_type"), F.lit(None).cast("string").alias("record_id"),
        F.when(again, F.col("first_id")).alias("refers_to"), "payload_bytes", "payload_digest",
        F.when(~again, F.col("payload")).alias("payload"))


def write(records: DataFrame, path: str, **options: str) -> None:
    register(records.sparkSession)
    records.write.format("warc").options(**options).mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(payload=str(payload).lower(), **options).load(path)


def verified(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the archives' records.

    Length and digest of a response come from its payload as read; revisits, which
    have none, are read by their headers alone.
    """
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    full = read(spark, path).where("record_type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", "refers_to")
    again = read(spark, path, payload=False).where("record_type = 'revisit'").select(*columns)
    return full.unionByName(again)
