"""BPE encoding and decoding through a table of distinct words.

``encode`` splits texts into words, encodes every distinct word of the corpus
once, and joins the ids back by position:

1. documents are packed into chunks of a bounded size, which are shuffled once;
2. each chunk sends its distinct words, packed, to the bucket of their hash;
3. a bucket holds all occurrences of its words, so each distinct word meets
   the tokenizer once; the ids go back to the chunks in the order of the words;
4. each chunk, cogrouped with its ids, replaces words by ids position by position.

The exchange is as large as the distinct words of the chunks, not as all
words, and a word that stands in every document is one entry per chunk.

Words are cut at ASCII white space only.  The tokenizer drops white space and
none of its patterns reaches across it, so a word's ids do not depend on its
neighbours; everything else about a word is left to the library itself.

``decode`` joins ids with the vocabulary's id-to-piece table, which is as
large as the vocabulary, in Arrow.

Cases: null and empty texts, and texts of white space, give no ids; ids of no
piece are dropped in decoding, as the library does; repeated rows and null
document ids are kept as rows; an empty table gives an empty result; columns
other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20


@lru_cache(maxsize=4)
def tokenizer(vocabulary: str):
    from tokenizers import Tokenizer
    out = Tokenizer.from_file(vocabulary)
    out.no_truncation()
    out.no_padding()
    return out


def _words(text: bytes) -> list[bytes]:
    # the normaliser lower-cases anyway, but only after it has composed characters, so texts
    # beyond ASCII stay as they are; so does the spelling of special tokens
    return (text.lower() if text.isascii() and b"<|" not in text else text).split()


def _by_bucket(texts: list[bytes], buckets: int) -> dict[int, list[bytes]]:
    seen: set[bytes] = set()
    for text in texts:
        seen.update(_words(text))
    out: dict[int, list[bytes]] = {}
    for word in sorted(seen):
        out.setdefault(zlib.crc32(word) % buckets, []).append(word)
    return out


def _pack(arrays: list[np.ndarray | bytes]) -> bytes:
    parts = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    head = np.array([len(p) for p in parts], dtype=np.int64).tobytes()
    return zstandard.compress(len(parts).to_bytes(4, "little") + head + b"".join(parts), 3)


def _unpack(blob: bytes) -> list[bytes]:
    raw = zstandard.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    ends = np.cumsum(np.frombuffer(raw, dtype=np.int64, count=n, offset=4)) + 4 + 8 * n
    starts = np.concatenate([[4 + 8 * n], ends[:-1]])
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _texts(blob: bytes) -> tuple[bytes, list[bytes]]:
    ids, lens, text = _unpack(blob)
    ends = np.cumsum(np.frombuffer(lens, dtype=np.int64))
    return ids, [text[e - n:e] for e, n in zip(ends.tolist(), np.frombuffer(lens, dtype=np.int64)
                                               .tolist(), strict=True)]


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (chunk, blob): ids as an Arrow stream, text lengths, texts."""
    context = TaskContext.get()
    base = (context.partitionId() if context else 0) << 32
    made, ids, texts, size = 0, [], [], 0

    def flush() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        column = pa.array(ids, pa.int64())
        with pa.ipc.new_stream(sink, pa.schema([("doc_id", pa.int64())])) as out:
            out.write_batch(pa.record_batch([column], ["doc_id"]))
        blob = _pack([sink.getvalue().to_pybytes(),
                      np.array([len(t) for t in texts], dtype=np.int64), b"".join(texts)])
        return pa.record_batch([pa.array([base + made], pa.int64()),
                                pa.array([blob], pa.large_binary())], ["chunk", "blob"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(
                pa.binary()).to_pylist(), strict=True):
            ids.append(doc_id)
            texts.append(text or b"")
            size += len(texts[-1]) + 16
            if size >= chunk_bytes:
                yield flush()
                made, ids, texts, size = made + 1, [], [], 0
    if ids:
        yield flush()


def _chunk_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found = _by_bucket(_texts(blob.as_py())[1], buckets)
            rows = [(b, chunk, _pack([b"\n".join(words)])) for b, words in found.items()]
            if rows:
                bucket, of, blobs = zip(*rows, strict=True)
                yield pa.record_batch([pa.array(bucket, pa.int32()), pa.array(of, pa.int64()),
                                       pa.array(blobs, pa.large_binary())],
                                      ["bucket", "chunk", "blob"])


def _encode_words(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    """Word lists to id lists; ``table`` is this bucket's part of the distinct-word table."""
    model, table = tokenizer(vocabulary), {}
    for batch in batches:
        out = []
        for blob in batch.column(2):
            words = _unpack(blob.as_py())[0].split(b"\n")
            new = [w for w in words if w not in table]
            for i in range(0, len(new), 4096):
                part = new[i:i + 4096]
                found = model.encode_batch_fast([w.decode() for w in part],
                                                add_special_tokens=False)
                table.update(zip(part, (np.array(e.ids, dtype=np.uint32).tobytes()
                                        for e in found), strict=True))
            ids = [table[w] for w in words]
            out.append(_pack([np.array([len(x) >> 2 for x in ids], dtype=np.uint32),
                              b"".join(ids)]))
        yield pa.record_batch([batch.column(0), batch.column(1),
                               pa.array(out, pa.large_binary())], ["bucket", "chunk", "blob"])


def _assemble(chunk: pa.Table, encoded: pa.Table, buckets: int) -> pa.Table:
    """A chunk's documents with the ids of their words put in place."""
    lens, flat, place, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)], {}, 0
    if chunk.num_rows != 1:
        return pa.table({"doc_id": pa.array([], pa.int64()),
                         "ids": pa.array([], pa.list_(pa.int32()))})
    ids, texts = _texts(chunk.column("blob")[0].as_py())
    words = _by_bucket(texts, buckets)
    for bucket, blob in zip(encoded.column("bucket").to_pylist(), encoded.column("blob"),
                            strict=True):
        n, values = _unpack(blob.as_py())
        lens.append(np.frombuffer(n, dtype=np.uint32).astype(np.int64))
        flat.append(np.frombuffer(values, dtype=np.uint32))
        place.update(zip(words[bucket], range(at, at + len(words[bucket])), strict=True))
        at += len(words[bucket])
    words.clear()
    n, values = np.concatenate(lens), np.concatenate(flat).astype(np.int32)
    start = np.concatenate([[0], np.cumsum(n)])[:-1] if len(n) else np.zeros(0, np.int64)
    parts, sizes = [], []
    for text in texts:
        split = _words(text)
        at = np.fromiter(map(place.__getitem__, split), dtype=np.int64, count=len(split))
        count = n[at]
        total = int(count.sum())
        sizes.append(total)
        first = np.repeat(start[at] - np.cumsum(count) + count, count)
        parts.append(values[first + np.arange(total)])
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    joined = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    with pa.ipc.open_stream(ids) as stream:
        column = stream.read_all().column("doc_id").combine_chunks()
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(joined, pa.int32()))
    return pa.table({"doc_id": column, "ids": lists})


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (doc_id long, ids array<int>), one for each row of ``docs``."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                          F.col(text_col).alias("text"))
              .mapInArrow(lambda it: _chunks(it, chunk_bytes), "chunk long, blob binary")
              .repartition(n, "chunk"))
    encoded = (chunks.mapInArrow(lambda it: _chunk_words(it, n),
                                 "bucket int, chunk long, blob binary")
               .repartition(n, "bucket")
               .mapInArrow(lambda it: _encode_words(it, vocabulary),
                           "bucket int, chunk long, blob binary"))
    return chunks.groupBy("chunk").cogroup(encoded.groupBy("chunk")).applyInArrow(
        lambda a, b: _assemble(a, b, n), "doc_id long, ids array<int>")


@lru_cache(maxsize=4)
def _pieces(vocabulary: str) -> pa.Array:
    pieces = tokenizer(vocabulary).get_vocab(with_added_tokens=True)
    out: list[str | None] = [None] * (max(pieces.values()) + 1)
    for piece, i in pieces.items():
        out[i] = piece
    return pa.array(out, pa.string())


def decode_lists(ids: pa.Array, vocabulary: str) -> pa.Array:
    """Texts of an Arrow list column of ids, by a join with the id-to-piece table."""
    model = tokenizer(vocabulary)
    if model.decoder is not None:
        return pa.array(model.decode_batch(ids.to_pylist(), skip_special_tokens=False),
                        pa.string())
    table = _pieces(vocabulary)
    flat, offsets = ids.flatten(), np.asarray(ids.offsets) - ids.offsets[0].as_py()
    known = pc.and_(pc.less(flat, len(table)), pc.greater_equal(flat, 0))
    pieces = table.take(pc.if_else(known, flat, None))
    if pieces.null_count:
        keep = np.asarray(pieces.is_valid())
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        pieces = pieces.drop_null()
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pieces)
    return pc.binary_join(lists, " ")


def _slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` list items each."""
    lens = np.asarray(pc.fill_null(pc.list_value_length(batch.column(column)), 0))
    part = np.cumsum(lens) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Rows (doc_id, text) of rows (doc_id, ids); a null list decodes as an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "ids"):
                yield pa.record_batch([part.column("doc_id"), _decoded(part, vocabulary)],
                                      ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _decoded(part: pa.RecordBatch, vocabulary: str) -> pa.Array:
    lists = part.column("ids")
    if lists.null_count:
        lists = pa.array([x or [] for x in lists.to_pylist()], lists.type)
    return decode_lists(pa.concat_arrays([lists]), vocabulary)


def digests(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of rows (doc_id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        def sha(column: pa.Array) -> pa.Array:
            return pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in column],
                            pa.string())

        for batch in batches:
            for part in _slices(batch, "ids"):
                lists = pa.concat_arrays([part.column("ids")])
                shown = pa.ListArray.from_arrays(
                    pc.subtract(lists.offsets, lists.offsets[0]),
                    lists.flatten().cast(pa.string()))
                yield pa.record_batch(
                    [part.column("doc_id"), pc.list_value_length(lists).cast(pa.int64()),
                     sha(pc.binary_join(shown, " ")), sha(_decoded(part, vocabulary))],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
