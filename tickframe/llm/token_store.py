"""Token ids as Parquet list columns that can be read selectively.

``write`` range-partitions documents by id, encodes each partition in order,
appends the end id, and lets Spark's Parquet writer (with its commit protocol)
lay the rows out:

- token ids are dictionary-encoded (a page holds bit-packed indexes), ids and
  offsets delta-encoded, everything under zstd;
- row groups and pages have set sizes, and every file has a column index and
  an offset index, so a reader that wants a few documents, or the metadata
  columns only, touches those pages alone.

``part`` and ``part_start`` place a document inside its partition.  The first
position of a partition is the sum of those before it, which ``read`` takes
from the metadata columns of the files; nothing is gathered on the driver.

Tokens come from the tokenizers library.  Its pre-tokenizer keeps a space with
the word after it, so a text whose spaces all stand alone between two other
characters can be cut there, and around lines' ends that stand alone; the pieces
are looked up in bounded tables of pieces met before, and missing ones are
encoded alone.  Letters with marks after them are two pre-tokens, so
the letters are encoded once whatever follows them.  Texts with any other white
space next to a space, or with a special token, go to the library as they are.

Cases: a null or empty text has the end id only; null ids come first; rows
that share an id stand together, ordered by the hash of their texts; an empty
table writes no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import re
import string
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END_ID = 0
KEPT_BYTES = 64 << 20       # pieces and ids that a task keeps, with PIECE_BYTES for each
RECENT_BYTES = 48 << 20     # those of pieces that came up once
PIECE_BYTES = 200
BATCH_BYTES = 4 << 20       # text that is encoded at a time
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 1000

_OTHER_SPACE = re.compile(r"[^\S \n]")
_MARKS = string.punctuation


def _cuts_at_spaces(text: str) -> bool:
    """Whether every space stands alone between two characters that are not white space."""
    return not (text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text
                or "\n " in text or "\0" in text or _OTHER_SPACE.search(text))


def _pieces(text: str) -> list[str]:
    """The parts of a text that cuts at spaces; line ends that stand alone are parts too."""
    text = text.replace(" ", "\0 ")
    if "\n" in text and "\n\n" not in text:
        text = text.replace("\n", "\0\n\0")
    return text.split("\0")


class PieceEncoder(dict):
    """Ids of texts under a byte-level BPE vocabulary, as 32-bit integers' bytes.

    As a dict it holds the pieces that came up again; ``recent`` holds others.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.model = Tokenizer.from_file(vocabulary)
        self.model.no_truncation()
        self.model.no_padding()
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.byte_level = (isinstance(self.model.pre_tokenizer, pre_tokenizers.ByteLevel)
                           and self.model.normalizer is None
                           and self.model.pre_tokenizer.use_regex
                           and not self.model.pre_tokenizer.add_prefix_space)
        show = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: show.pre_tokenize_str(chr(c))[0][0]
                      for c in [32, *range(65, 91), *range(97, 123), *range(128, 0x250)]}
        self.model.model._resize_cache(0)
        self.tokenize = self.model.model.tokenize
        self.kept_bytes = 0
        self.recent: dict[str, bytes] = {}
        self.recent_bytes = 0

    def _ids(self, text: str) -> bytes:
        return array("i", self.model.encode(text, add_special_tokens=False).ids).tobytes()

    def _found(self, piece: str) -> bytes:
        """Ids of a piece that is not known; a leading space is part of it."""
        body = piece.rstrip(_MARKS)
        letters = body[1:] if body[:1] == " " else body
        # a space and letters are one pre-token, so the model sees them directly, and marks
        # up to the piece's end are a pre-token of their own; after anything else they may not be
        if not letters.isalpha() or not (letters.isascii() or max(letters) < "\u0250"):
            return self._ids(piece)
        if body != piece:
            return self[body] + self[piece[len(body):]]
        return array("i", [t.id for t in self.tokenize(body.translate(self.shown))]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        """Ids of a piece that did not come up twice; from the second time on it is kept."""
        ids = self.recent.get(piece)
        if ids is None:
            ids = self._found(piece)
            if self.recent_bytes > RECENT_BYTES:
                self.recent.clear()
                self.recent_bytes = 0
            self.recent[piece] = ids
            self.recent_bytes += len(piece) + len(ids) + PIECE_BYTES
        else:
            size = len(piece) + len(ids) + PIECE_BYTES
            if self.kept_bytes + size <= KEPT_BYTES:
                self[piece] = ids
                self.kept_bytes += size
        return ids

    def _encoded(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.byte_level or not _cuts_at_spaces(text) or any(
                s in text for s in self.special):
            return self._ids(text)
        return b"".join(map(self.__getitem__, _pieces(text)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """32-bit ids of each text, as bytes in the machine's order."""
        return [self._encoded(text) for text in texts]


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> PieceEncoder:
    return PieceEncoder(vocabulary)


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) >> 2 for x in ids)]).astype(np.int32)
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]),
                                   [None, pa.py_buffer(b"".join(ids))])
    return pa.ListArray.from_arrays(pa.array(ends), values)


def _slices(batch: pa.RecordBatch, most_bytes: int) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about ``most_bytes`` of text, read from the batch one at a time."""
    texts = batch.column(1)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        end = min(len(texts), int(np.searchsorted(ends, before + most_bytes, "right")) + 1)
        yield (batch.column(0).slice(at, end - at).to_pylist(),
               [t or "" for t in texts.slice(at, end - at).to_pylist()])
        at = end


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int,
             most_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    part, at, end = TaskContext.get().partitionId(), 0, np.int32(end_id).tobytes()
    model = _encoder(vocabulary)

    def rows(ids: list, texts: list[str]) -> pa.RecordBatch:
        nonlocal at
        found = [x + end for x in model.encode(texts)]
        n = np.array([len(x) >> 2 for x in found], dtype=np.int64)
        start = at + np.cumsum(n) - n
        at += int(n.sum())
        return pa.record_batch(
            [pa.array(ids, pa.int64()), pa.array([part] * len(ids), pa.int32()),
             pa.array(start), pa.array(n), _lists(found)],
            ["doc_id", "part", "part_start", "n_tokens", "tokens"])

    for batch in batches:
        for ids, texts in _slices(batch, most_bytes):
            yield rows(ids, texts)


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID,
          id_col: str = "doc_id", text_col: str = "text",
          row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES,
          page_rows: int = PAGE_ROWS) -> None:
    """Write one row per document in ascending id order: doc_id, part, part_start,
    n_tokens, tokens."""
    order = ["doc_id", "text_hash"]
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(F.col(text_col)).alias("text_hash"))
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .select("doc_id", "text")
            .mapInArrow(lambda it: _encoded(it, vocabulary, end_id),
                        "doc_id long, part int, part_start long, n_tokens long, "
                        "tokens array<int>"))
    (rows.write.option("compression", "zstd")
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#tokens.list.element", "true")
     .option("parquet.dictionary.page.size", str(1 << 20))
     .option("parquet.block.size", str(row_group_bytes))
     .option("parquet.page.size", str(page_bytes))
     .option("parquet.page.row.count.limit", str(page_rows))
     .parquet(path))


def read(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The files' rows with ``start``, the number of ids of all documents before each.

    Only the named columns (default: all) and those that place a document are read.
    """
    rows = spark.read.parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0))
                           .alias("part_base"))
    columns = columns or ("doc_id", "n_tokens", "tokens")
    return (rows.select("part", "part_start", *columns).join(F.broadcast(starts), "part")
            .select((F.col("part_base") + F.col("part_start")).alias("start"), *columns))


def checksums(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = pa.concat_arrays([batch.column("tokens")])
            ends = (np.asarray(lists.offsets).astype(np.int64) * 4).tolist()
            raw = memoryview(np.asarray(lists.values, dtype="<i4").tobytes())
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            n = [(b - a) >> 2 for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.record_batch([batch.column("doc_id"), batch.column("start"),
                                   pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                                  ["doc_id", "start", "n_tokens", "ids_crc32"])
    return rows.select("doc_id", "start", "tokens").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
