"""MessagePack streams read by byte ranges, several tasks to a file.

A stream of records has no marks to split at, so the boundaries are found:

1. Every file is cut into byte ranges.  Each range but a file's first guesses
   its first record: the first place from which several arrays of one arity
   follow each other.  From there a structural skip (no value is decoded) runs
   to the first boundary at or after the range's end.
2. The guesses are checked as a chain: a range must start where the one before
   it stopped.  Where it does not, the range is skipped again from that very
   place.  A file's first range starts at 0, so once no range disagrees with its
   predecessor, every boundary is right.
3. The ranges with their first row numbers are the index.  It can be kept in a
   table and reused for files of the same length and modification time.

Decoding then takes ranges in any order on any executor; a lost task rereads its
bytes.  Files no longer than one range need no search.  A record that cannot be
read ends its file: the rows before it are returned, and one error row.
"""

from __future__ import annotations

import itertools
import os
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import stored
from .msgpack_lite import pack

MAX_SPLIT = 64 << 20
MIN_SPLIT = 64 << 10
CONFIRM = 8             # records that a guess must be followed by
MAX_VALUES = 1 << 16    # a record with more values at one level is no telemetry row
BUFFER = 1 << 20
TASK_FILES = 2000       # short files that a task reads, and their bytes
TASK_BYTES = 16 << 20
INDEX = ("path string, replay_id string, aspect string, length long, modified timestamp, k long, "
         "first long, stop long, rows long, error string")

# Structure of MessagePack by first byte (fixed values of the format): bytes of a value of
# fixed size, with its values for short arrays and maps
_SIZE = [1] * 256
_CHILDREN = [0] * 256
for _b in range(0x80, 0x90):
    _CHILDREN[_b] = 2 * (_b & 15)
for _b in range(0x90, 0xA0):
    _CHILDREN[_b] = _b & 15
for _b in range(0xA0, 0xC0):
    _SIZE[_b] = 1 + (_b & 31)
_SIZE[0xCA:0xD4] = [5, 9, 2, 3, 5, 9, 2, 3, 5, 9]
#: bytes of the length that follows: strings, binaries; arrays and maps by their count
_LENGTH = {0xD9: 1, 0xDA: 2, 0xDB: 4, 0xC4: 1, 0xC5: 2, 0xC6: 4}
_COUNT = {0xDC: (2, 1), 0xDD: (4, 1), 0xDE: (2, 2), 0xDF: (4, 2)}
_UNKNOWN = {0xC1, 0xC7, 0xC8, 0xC9, *range(0xD4, 0xD9)}


class Broken(ValueError):
    """Bytes that are no MessagePack value."""


class _More(Exception):
    """The value goes on after the buffer."""


def skip(data: bytes, at: int) -> int:
    """The place after the value at ``at``; no value is decoded."""
    left, end = 1, len(data)
    while left:
        if at >= end:
            raise _More
        b = data[at]
        left += _CHILDREN[b] - 1
        if b in _LENGTH:
            n = _LENGTH[b]
            if at + 1 + n > end:
                raise _More
            at += 1 + n + int.from_bytes(data[at + 1:at + 1 + n], "big")
        elif b in _COUNT:
            n, times = _COUNT[b]
            if at + 1 + n > end:
                raise _More
            left += times * int.from_bytes(data[at + 1:at + 1 + n], "big")
            at += 1 + n
            if left > MAX_VALUES:
                raise Broken(f"{left} values in one record")
        elif b in _UNKNOWN:
            raise Broken(f"unsupported type byte 0x{b:02x}")
        else:
            at += _SIZE[b]
    if at > end:
        raise _More
    return at


def arity(data: bytes, at: int) -> int | None:
    """The number of values of the array at ``at``; ``None`` if it is no array."""
    b = data[at] if at < len(data) else 0
    if 0x90 <= b <= 0x9F:
        return b & 15
    if b in (0xDC, 0xDD):
        n = 2 if b == 0xDC else 4
        return int.from_bytes(data[at + 1:at + 1 + n], "big")
    return None


def open_file(path: str):
    """A file for reading at any place: local, or of a store that Arrow knows."""
    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return open(unquote(parsed.path) if not os.path.exists(parsed.path) else parsed.path, "rb")
    from pyarrow.fs import FileSystem
    fs, name = FileSystem.from_uri(path)
    return fs.open_input_file(name)


class _Window:
    """A growing window of a file from a given place on."""

    def __init__(self, file, start: int, length: int):
        self.file, self.base, self.length = file, start, length
        self.data = b""

    @property
    def done(self) -> bool:
        return self.base + len(self.data) >= self.length

    def grow(self) -> None:
        self.file.seek(self.base + len(self.data))
        more = max(BUFFER, len(self.data))
        self.data += self.file.read(min(more, self.length - self.base - len(self.data)))

    def drop(self, at: int) -> int:
        """Forget the bytes before ``at`` once they are many; the new place of ``at``."""
        if at < BUFFER:
            return at
        self.data, self.base = self.data[at:], self.base + at
        return 0

    def skip(self, at: int) -> int:
        """The place after the value at ``at``, reading on as needed."""
        while True:
            try:
                return skip(self.data, at)
            except _More:
                if self.done:
                    raise Broken("truncated stream") from None
                self.grow()


def _guess(window: _Window, end: int) -> int | None:
    """The first place before ``end`` from which records seem to follow each other."""
    at = 0
    while window.base + at < end:
        if at >= len(window.data):
            if window.done:
                return None
            window.grow()
            continue
        width = arity(window.data, at)
        if width is not None:
            here, good = at, 0
            try:
                while good < CONFIRM and arity(window.data, here) == width:
                    here = window.skip(here)
                    good += 1
                    if here >= len(window.data):
                        if window.done:
                            return at       # records up to the file's end
                        window.grow()
                if good == CONFIRM:
                    return at
            except Broken:
                pass
        at += 1
    return None


def _walk(window: _Window, at: int, end: int) -> tuple[int, int, str | None]:
    """(first boundary at or after ``end``, records before it, error) from a boundary on."""
    rows = 0
    while window.base + at < end:
        if at >= len(window.data):
            if window.done:
                break
            window.grow()
            continue
        try:
            at = window.skip(at)
        except Broken as e:
            return window.length, rows, f"decode error at byte {window.base + at}: {e}"
        rows += 1
        at = window.drop(at)
    return window.base + at, rows, None


def probe(file, length: int, start: int, end: int, first: int | None
          ) -> tuple[int | None, int | None, int, str | None]:
    """(first record, stop, rows, error) of the range start..end; a ``first`` of ``None`` is guessed."""
    if first is None:
        window = _Window(file, start, length)
        at = _guess(window, end)
        if at is None:
            return None, None, 0, None
        found = window.base + at
        stop, rows, error = _walk(window, at, end)
        # an error after a guess says more about the guess than about the file
        return (None, None, 0, None) if error else (found, stop, rows, None)
    stop, rows, error = _walk(_Window(file, first, length), 0, end)
    return first, stop, rows, error


_PROBED = pa.schema([("path", pa.string()), ("k", pa.int64()), ("first", pa.int64()),
                     ("stop", pa.int64()), ("rows", pa.int64()), ("error", pa.string())])


def _probe(ranges: DataFrame) -> DataFrame:
    """(path, k, first, stop, rows, error) of ranges (path, length, k, start, end, known)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, length, k, start, end, known in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                with open_file(path) as file:
                    out.append((path, k, *probe(file, length, start, end, known)))
            columns = zip(*out, strict=True) if out else [()] * len(_PROBED)
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in
                                   zip(columns, _PROBED, strict=True)], schema=_PROBED)
    return ranges.select("path", "length", "k", "start", "end", "known").mapInArrow(
        run, "path string, k long, first long, stop long, rows long, error string")


def split_size(total: int, parallelism: int, most: int = MAX_SPLIT, least: int = MIN_SPLIT) -> int:
    """Bytes of a range: enough ranges for all cores, none above ``most``."""
    return min(most, max(least, total // max(1, parallelism)))


def _spread(df: DataFrame, tasks: int) -> DataFrame:
    return df.repartition(max(1, min(tasks, 10_000)), "path", "k")


def index(files: DataFrame, split: int) -> DataFrame:
    """The index of ``files`` (path, replay_id, aspect, length, modified), checked."""
    named = files.select("path", "replay_id", "aspect", "length", "modified")
    single = named.where(F.col("length") <= split).select(
        "*", F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("first"),
        F.col("length").alias("stop"), F.lit(None).cast("long").alias("rows"),
        F.lit(None).cast("string").alias("error"))
    long_files = stored(named.where(F.col("length") > split), "long-files")
    cut = long_files.select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), ((F.col("length") - 1) / split).cast("long"))).alias("k")).select(
        "path", "length", "k", (F.col("k") * split).alias("start"),
        F.least(F.col("length"), (F.col("k") + 1) * split).alias("end"))
    tasks = cut.count()
    if not tasks:
        return single
    at_start = F.when(F.col("k") == 0, F.lit(0).cast("long"))
    probed = stored(_probe(_spread(cut.withColumn("known", at_start), tasks)), "probed")
    by_file = Window.partitionBy("path").orderBy("k")
    while True:
        # a range starts where its predecessor stopped
        chain = probed.withColumn("known", F.coalesce(F.lag("stop").over(by_file), at_start))
        wrong = stored(chain.where("known IS NOT NULL AND NOT known <=> first")
                       .select("path", "k", "known").join(cut, ["path", "k"]), "wrong-ranges")
        n = wrong.count()
        if not n:
            break
        again = _probe(_spread(wrong, n))
        probed = stored(probed.join(wrong.select("path", "k"), ["path", "k"], "left_anti")
                        .unionByName(again), "probed")
    # a range after an error, or inside a long record, has no records of its own
    kept = probed.where("rows > 0 OR error IS NOT NULL")
    return single.unionByName(long_files.join(kept, "path").select(*single.columns))


def indexed(files: DataFrame, split: int, store: str) -> DataFrame:
    """``index`` with known files taken from the table at ``store`` and new ones added to it.

    A file is known while its length and modification time stay the same.
    """
    spark = files.sparkSession
    try:
        known = spark.read.schema(INDEX).parquet(store)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = spark.createDataFrame([], INDEX)
    same = ["path", "length", "modified"]
    new = files.join(known.select(*same).distinct().hint("merge"), same, "left_anti")
    index(new, split).write.mode("append").parquet(store)
    return spark.read.schema(INDEX).parquet(store).join(
        files.select(*same).hint("merge"), same, "left_semi")


def numbered(ranges: DataFrame) -> DataFrame:
    """Ranges with the number of their first row in the file."""
    before = Window.partitionBy("path").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("first_row", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def decode(ranges: DataFrame, batches_of, schema) -> DataFrame:
    """Rows of all ranges; ``batches_of(replay_id, aspect, first_row, bytes, error)`` decodes one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, replay, aspect, first, stop, row, error in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                with open_file(path) as file:
                    file.seek(first)
                    data = file.read(stop - first)
                yield from batches_of(replay, aspect, row, data, error)

    long_ranges = ranges.where("rows IS NOT NULL")
    tasks = long_ranges.count()
    columns = ["path", "replay_id", "aspect", "first", "stop", "first_row", "error"]
    whole = ranges.where("rows IS NULL")
    files, total = whole.agg(F.count("path"), F.coalesce(F.sum("stop"), F.lit(0))).first()
    cores = ranges.sparkSession.sparkContext.defaultParallelism
    parts = [_spread(whole, max(min(files, cores), files // TASK_FILES, total // TASK_BYTES))
             .withColumn("first_row", F.lit(0).cast("long"))]
    if tasks:
        parts.append(_spread(numbered(long_ranges), tasks))
    out = None
    for part in parts:
        rows = part.select(*columns).mapInArrow(run, schema)
        out = rows if out is None else out.unionByName(rows)
    return out


# --------------------------------------------------------------------------- writing
def write(rows: DataFrame, fields: list[str], aspect: str, root: str,
          length: str | None = None) -> None:
    """Rows as MessagePack files ``<root>/part-<n>/<replay_id>/<aspect>.mpk``.

    Rows are shuffled by replay, so there are as many files as replays, however
    many tasks read the rows, and a task has one file open; a task that runs again
    overwrites its own files.  The column ``length`` says how many of the fields a
    record has, all by default.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        attempt, file = uuid.uuid4().hex, None
        for batch in batches:
            done: list[_Part] = []
            records = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for replay, group in itertools.groupby(records, key=lambda r: r[0]):
                if file is None or file.replay != replay:
                    if file is not None:
                        done.append(file)
                        file.commit()
                    file = _Part(root, part, replay, aspect, attempt)
                file.append([pack(values[:n]) for _, n, *values in group])
            yield _written(done)
        if file is not None:
            file.commit()
            yield _written([file])

    size = F.col(length).cast("int") if length else F.lit(len(fields))
    rows.select(F.col("replay_id").cast("string").alias("__replay"), size.alias("__size"),
                *fields).repartition("__replay").sortWithinPartitions("__replay").mapInArrow(
        run, "path string, rows long").write.format("noop").mode("overwrite").save()


def _written(files: list[_Part]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([f.path for f in files], pa.string()),
                            pa.array([f.rows for f in files], pa.int64())], ["path", "rows"])


class _Part:
    """A file that appears under its name when it is whole."""

    def __init__(self, root: str, part: int, replay: str, aspect: str, attempt: str):
        from pyarrow.fs import FileSystem, LocalFileSystem
        parsed = urlparse(root)
        self.fs, base = ((LocalFileSystem(), parsed.path) if parsed.scheme in ("", "file")
                         else FileSystem.from_uri(root))
        self.folder = f"{base}/part-{part:05d}/{replay}"
        self.path, self.rows, self.replay = f"{self.folder}/{aspect}.mpk", 0, replay
        self.temporary = f"{self.folder}/.{aspect}-{attempt}"
        self.fs.create_dir(self.folder)
        self.stream = self.fs.open_output_stream(self.temporary)

    def append(self, parts: list[bytes]) -> None:
        self.stream.write(b"".join(parts))
        self.rows += len(parts)

    def commit(self) -> None:
        self.stream.close()
        self.fs.move(self.temporary, self.path)
