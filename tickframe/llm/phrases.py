"""Phrase collocation mining by dynamic itemset counting.

The corpus is cut into ``shards`` by hash, and the shards are scanned in turn,
round and round.  Single words are counted from the first scan on.  A longer
phrase becomes active as soon as both its subphrases (without the last, and
without the first word) have reached the threshold in what was counted so far;
it is counted from the next scan on, for exactly one full cycle, so its count
covers every shard once.  Lengths overlap: pairs are counted while words still
are, and most phrases are done well before a scan per length would start.

Scans learn from a table of fixed size (``SLOT_BITS``) in which scan a phrase
reached the threshold.  A slot may be shared: a phrase whose subphrases fall in
slots that others filled is active early or in vain, but is counted for a full
cycle all the same, so all counts are exact, and no phrase is missed.  Counts are keyed by the
phrases themselves, summed per task first.

A phrase that reaches the threshold has at least threshold / shards of its
occurrences in one shard.  Only slots of phrases with so many in some scan are
summed over scans, the last cycle's, without the phrases themselves; counts of
the others are written once and left alone.

Collocations: a candidate's score is the least over its cuts in two of
2 * a / (l + r), in millionths; candidates that mostly occur inside a longer
one are dropped; each language's best are ranked.

Cases: texts are lower-cased (A-Z) and cut at ``[.,;:!?\\x0A-\\x0D]``; null and
empty texts have no words; a null language is ``und``; rows may repeat (each
counts); very long texts are cut between pieces, which changes no count; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.llm.common import scratch_path, stored

LENGTH = 4
THRESHOLD = 30
SHARDS = 3
TOP = 2000
INSIDE = 80             # percent of a candidate's occurrences inside a longer one
SCALE = 2_000_000
SLOT_BITS = 24
ROW_BYTES = 16 << 10    # longer texts are cut between pieces
SCAN_BYTES = 5 << 20    # text that a task counts at once
SALTS = 64
UNSET = 255

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TO_STOP = bytes.maketrans(_SEPARATORS + b"\t", b"." * len(_SEPARATORS) + b" ")
_ODD = np.uint64(0x9E3779B97F4A7C15)
COUNTED = "len int, lang string, phrase string, slot int, cnt long"
SHARDED = "lang string, words binary, shard int"


def _cut(words: bytes) -> Iterator[bytes]:
    """Parts of at most about ``ROW_BYTES``, cut between pieces."""
    start = 0
    while len(words) - start > ROW_BYTES:
        end = words.rfind(b" . ", start, start + ROW_BYTES)
        if end < 0:
            end = words.find(b" . ", start)
        if end < 0:
            break
        yield words[start:end]
        start = end + 3
    yield words[start:]


def sharded(docs: DataFrame, lang_col: str, text_col: str, shards: int) -> DataFrame:
    """The corpus as rows (lang, words, shard), written by shard.

    ``words`` are parted by spaces, pieces by `` . ``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, rows = [], []
            for lang, text in zip(batch.column(0).to_pylist(),
                                  batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = (text or b"").lower().translate(_TO_STOP).replace(b".", b" . ")
                for part in _cut(words):
                    langs.append(lang)
                    rows.append(part)
            shard = np.fromiter((zlib.crc32(r) % shards for r in rows), np.int32, len(rows))
            yield pa.record_batch([pa.array(langs, pa.string()), pa.array(rows, pa.binary()),
                                   pa.array(shard)], ["lang", "words", "shard"])

    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "shards")
    (docs.select(F.coalesce(F.col(lang_col), F.lit("und")), F.col(text_col))
     .mapInArrow(run, SHARDED).write.option("compression", "zstd").partitionBy("shard")
     .parquet(path))
    return spark.read.schema(SHARDED).parquet(path)


def _slots(codes: np.ndarray, length: int, many: int) -> np.ndarray:
    """The slots (of ``many``, a power of two) of phrases, from their words' running codes."""
    x = (codes + np.uint64(length)) * _ODD
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(65 - many.bit_length())).astype(np.int64)


def _phrases(names: pa.Array, ids: list[np.ndarray]) -> pa.Array:
    parts = [names.take(pa.array(i)) for i in ids]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ")).cast(pa.string())


def _distinct(ids: np.ndarray, at: np.ndarray, length: int,
              size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Exact distinct phrases at places ``at``, as their words' ids, and their counts."""
    if length == 1:
        counts = np.bincount(ids[at], minlength=size)
        found = np.flatnonzero(counts)
        return [found], counts[found]
    first = ids[at] * size + ids[at + 1]
    if length == 2:
        found, counts = np.unique(first, return_counts=True)
        return list(divmod(found, size)), counts
    # names for the first two words, and for the rest
    names, first = np.unique(first, return_inverse=True)
    if length == 3:
        found, counts = np.unique(first * size + ids[at + 2], return_counts=True)
        first, rest = divmod(found, size)
        return [*divmod(names[first], size), rest], counts
    others, rest = np.unique(ids[at + 2] * size + ids[at + 3], return_inverse=True)
    found, counts = np.unique(first * len(others) + rest, return_counts=True)
    first, rest = divmod(found, len(others))
    return [*divmod(names[first], size), *divmod(others[rest], size)], counts


def count_active(lang: str, blob: bytes, reached: np.ndarray, step: int, shards: int,
                 length: int) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of one language that are active in scan ``step``.

    ``reached`` holds for every slot the scan in which a phrase of it reached
    the threshold.
    """
    words = pc.split_pattern(pa.array([blob], pa.binary()), b" ").values
    coded = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
    ids, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    if not len(ids):
        return
    known_codes = np.fromiter(map(zlib.crc32, names.to_pylist()), np.uint64, len(names))
    known_codes += np.uint64(zlib.crc32(lang.encode()) << 32)
    code, many = known_codes[ids], len(reached)
    stop = pc.index(names, pa.scalar(b".", pa.binary())).as_py()
    inside = ids != stop
    running, start = code, np.where(inside, 0, UNSET + 1).astype(np.int16)
    for n in range(1, length + 1):
        if n > 1:
            # active once the phrases without the last and without the first word were reached
            start = np.maximum(known[:-1], known[1:]) + np.int16(1)
            running = running[:-1] * _ODD + code[n - 1:]
        at = np.flatnonzero((start <= step) & (start > step - shards))
        if len(at):
            parts, counts = _distinct(ids, at, n, len(names))
            mixed = known_codes[parts[0]]
            for i in parts[1:]:
                mixed = mixed * _ODD + known_codes[i]
            yield pa.record_batch(
                [pa.array(np.full(len(counts), n, dtype=np.int32)),
                 pa.array([lang]).take(pa.array(np.zeros(len(counts), dtype=np.int8))),
                 _phrases(names, parts), pa.array(_slots(mixed, n, many).astype(np.int32)),
                 pa.array(counts)], ["len", "lang", "phrase", "slot", "cnt"])
        if n == length or len(start) < 2:
            return
        if n == 1:
            # all words are counted, so they are looked up once a distinct word
            known = reached[_slots(known_codes, 1, many)].astype(np.int16)[ids]
            known[~inside] = UNSET
            continue
        known = np.full(len(start), UNSET, dtype=np.int16)
        some = np.flatnonzero(start <= step)
        # a slot that others filled earlier says nothing of the subphrases, which ``start`` does
        known[some] = np.maximum(reached[_slots(running[some], n, many)],
                                 start[some] - np.int16(1))


def _shared(spark: SparkSession, table: np.ndarray) -> Broadcast:
    """A slot table for all tasks; it is mostly empty and travels compressed."""
    return spark.sparkContext.broadcast(zlib.compress(table, 1))


def _table(shared: Broadcast) -> np.ndarray:
    return np.frombuffer(zlib.decompress(shared.value), dtype=np.uint8)


def _scan(shard: DataFrame, shared: Broadcast, step: int, shards: int, length: int) -> DataFrame:
    """Counts (len, lang, phrase, slot, cnt) of one scan, summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = _table(shared)
        for batch in batches:
            waiting: dict[str, list[bytes]] = {}
            size: dict[str, int] = {}
            for lang, words in zip(batch.column(0), batch.column(1), strict=True):
                lang, words = lang.as_py(), words.as_py()
                waiting.setdefault(lang, []).append(words)
                size[lang] = size.get(lang, 0) + len(words)
                if size[lang] > SCAN_BYTES:
                    yield from count_active(lang, b" . ".join(waiting.pop(lang)), reached,
                                            step, shards, length)
                    size[lang] = 0
            for lang, parts in waiting.items():
                yield from count_active(lang, b" . ".join(parts), reached, step, shards, length)

    return (shard.select("lang", "words").mapInArrow(run, COUNTED)
            .groupBy("len", "lang", "phrase", "slot").agg(F.sum("cnt").alias("cnt")))


def _bits(rows: DataFrame, many: int) -> np.ndarray:
    """The slots (of ``many``) that rows have, as bits of 64-bit words.

    At most ``many / 64`` rows come to the driver.
    """
    words = (rows.groupBy(F.shiftright("slot", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, slot & 63))").alias("bits")).toArrow())
    packed = np.zeros(max(1, many >> 6), dtype=np.uint64)
    packed[np.asarray(words["word"])] = np.asarray(words["bits"]).view(np.uint64)
    return packed


def _slots_of(packed: np.ndarray) -> np.ndarray:
    """The slots whose bits are set; words without any are not unpacked."""
    at = np.flatnonzero(packed)
    bits = np.unpackbits(packed[at].view(np.uint8), bitorder="little")
    found = np.flatnonzero(bits)
    return (at[found >> 6] << 6) + (found & 63)


def _together(spark: SparkSession, scans: list[str]) -> DataFrame:
    """The counts of several scans, read as one table: a plan has one scan for all of them."""
    return spark.read.schema(COUNTED).parquet(*scans)


def _in_slots(rows: DataFrame, asked: np.ndarray) -> DataFrame:
    """The rows whose slot is asked for.

    The slots travel as 64-bit words; their number bounds what is broadcast, whatever
    the corpus.
    """
    at = np.flatnonzero(asked)
    words = rows.sparkSession.createDataFrame(pa.table({
        "word": pa.array(at.astype(np.int32)), "bits": pa.array(asked[at].view(np.int64))}))
    return rows.join(F.broadcast(words), F.shiftright("slot", 6) == F.col("word")).where(
        "(shiftrightunsigned(bits, slot & 63) & 1L) = 1L").drop("word", "bits")


def _full_slots(scans: DataFrame, asked: np.ndarray, threshold: int,
                lengths: Column) -> DataFrame:
    """The asked slots whose phrases together reach the threshold."""
    rows = _in_slots(scans.where(lengths).select("slot", "cnt"), asked)
    return rows.groupBy("slot").agg(F.sum("cnt").alias("n")).where(F.col("n") >= threshold)


def _frequent(scans: DataFrame, asked: np.ndarray, threshold: int) -> DataFrame:
    """Phrases that reach the threshold, with their counts, among those in the asked slots."""
    return (_in_slots(scans, asked).groupBy("len", "lang", "phrase")
            .agg(F.sum("cnt").alias("f")).where(F.col("f") >= threshold))


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                     length: int = LENGTH, threshold: int = THRESHOLD,
                     shards: int = SHARDS,
                     slot_bits: int = SLOT_BITS) -> tuple[DataFrame, DataFrame]:
    """(len, lang, phrase, f) of phrases with ``threshold`` occurrences, and (lang, n).

    Any ``slot_bits`` give the same counts; more of them spare counting in vain.
    """
    spark = docs.sparkSession
    corpus = sharded(docs, lang_col, text_col, shards)
    many = 1 << slot_bits
    reached = np.full(many, UNSET, dtype=np.uint8)
    # sets of slots are words of 64 bits on the driver
    heavy = np.zeros(max(1, many >> 6), dtype=np.uint64)
    done = np.zeros_like(heavy)
    scans: list[str] = []
    step = last = 0
    # a phrase that is active from scan ``last + 1`` on is done with scan ``last + shards``
    while step < shards or step <= last + shards:
        shared = _shared(spark, reached)
        scan = stored(_scan(corpus.where(F.col("shard") == step % shards), shared, step, shards,
                            length), f"scan-{step}")
        shared.destroy()
        scans.append(scan.scratch_path)
        heavy |= _bits(scan.where(F.col("cnt") >= -(-threshold // shards)), many)
        # a phrase has its counts in one cycle; words are done after one, longer ones later
        growing = (F.col("len") < length) & (F.col("len") > step // shards)
        new = _bits(_full_slots(_together(spark, scans[-shards:]), heavy & ~done, threshold,
                                growing), many)
        if new.any():
            reached[_slots_of(new)] = step
            done |= new
            last = step
        step += 1
    found = stored(_frequent(_together(spark, scans), heavy, threshold), "frequent")
    total = _together(spark, scans[:shards])
    return found, total.where("len = 1").groupBy("lang").agg(F.sum("cnt").alias("n"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                 length: int = LENGTH, threshold: int = THRESHOLD, shards: int = SHARDS,
                 inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best collocations."""
    found, totals = frequent_phrases(docs, lang_col, text_col, length, threshold, shards)
    known = found.select("lang", F.col("phrase").alias("part"), "f")
    words = F.split("phrase", " ")

    def piece(start: Column, size: Column) -> Column:
        return F.array_join(F.slice(words, start, size), " ")

    candidates = found.where("len > 1").select("lang", "len", "phrase", F.col("f").alias("a"))
    cuts = candidates.select("lang", "len", "phrase", "a", F.explode(
        F.sequence(F.lit(1), F.col("len") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", piece(F.lit(1), F.col("cut")).alias("first"),
        piece(F.col("cut") + 1, F.col("len") - F.col("cut")).alias("rest"))
    scored = (cuts.join(known.toDF("lang", "first", "l"), ["lang", "first"])
              .join(known.toDF("lang", "rest", "r"), ["lang", "rest"])
              .withColumn("score", F.expr(
                  f"CAST(CAST({SCALE} AS DECIMAL(8, 0)) * CAST(a AS DECIMAL(19, 0)) div "
                  "(CAST(l AS DECIMAL(19, 0)) + CAST(r AS DECIMAL(19, 0))) AS BIGINT)"))
              .groupBy("lang", "phrase", "a")
              .agg(F.min(F.struct("score", "cut", "l", "r")).alias("least")))
    # the most frequent longer candidate around each phrase
    around = candidates.where("len > 2").select(
        "lang", "len", "phrase", "a", F.explode(
            F.sequence(F.lit(2), F.col("len") - 1)).alias("size")).select(
        "lang", "phrase", "a", "size", F.explode(
            F.sequence(F.lit(1), F.col("len") - F.col("size") + 1)).alias("start")).select(
        "lang", piece(F.col("start"), F.col("size")).alias("phrase"), "a").groupBy(
        "lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.expr(
        f"longer IS NULL OR CAST(100 AS DECIMAL(3, 0)) * CAST(longer AS DECIMAL(19, 0)) < "
        f"CAST({inside} AS DECIMAL(3, 0)) * CAST(a AS DECIMAL(19, 0))")).select(
        "lang", "phrase", "a", "least.l", "least.r", "least.score")
    # ranked in salted parts first, so that no task orders all of a language
    best = [F.desc("score"), F.desc("a"), "phrase"]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    whole = Window.partitionBy("lang").orderBy(*best)
    first = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    return (first.withColumn("rank", F.row_number().over(whole).cast("long"))
            .where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
