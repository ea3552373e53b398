"""Hard-negative mining by Kronecker-packed products.

Vectors become integers, floor(scale * x).  A block of candidates is packed:
each component, biased so that none is negative, goes into a field of its own
of one wide integer, several candidates to an integer, and one multiplication
by an anchor's component advances all of them.  The sum over components is
biased once more, so that no field is negative, and unpacked by shifts and
masks: every field then holds one candidate's exact inner product.

The field width follows from the data: no partial sum of a field passes
``reach * sum(|anchor|)``.  While a packed sum stays within 53 bits, its wide
integers are held in doubles: every intermediate sum is an integer below
2 ** 53, hence exact in any order, and BLAS does the multiplications.  Wider
fields go into Python's integers, eight candidates each.

1. Anchors are taken in chunks of bounded size; each is broadcast and all rows
   pass it in blocks.  A task keeps the best ``positives`` rows of the anchor's
   label, and the tasks' lists are merged.
2. With the positives' scores known, all rows pass a second time.  For each
   anchor and positive a task keeps the best ``negatives`` rows of other labels
   within the score range, and the lists are merged.

A task returns (anchors * positives * negatives) rows at most, whatever it
reads; nothing is paired but a bounded chunk of anchors with all rows.

Cases: rows with a null label or vector, or with a component that is null or
not finite (scaled ones included), take no part.  Shorter vectors count as padded with zeros.  Rows
may repeat; each is a row of its own, a repeated anchor answers once a row.
Rows with a null id can be found but come after equal scores with ids.  Ties
go to the smaller id.  Scores beyond 64 bits count as the nearest long.  An
empty table, or one without anchors, gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import scratch_path, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90          # percent of the positive's score
CHUNK_ROWS = 4096           # anchors of a pass, expected; by hash of the row
CHUNK_BYTES = 32 << 20
BLOCK_SCORES = 1 << 21      # scores that a task holds at once
WORD_BITS = 53
WIDE_FIELDS = 8
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Packing:
    """How candidates share wide integers: their range and the fields' width."""

    dim: int
    low: int            # smallest component, zero at most
    reach: int          # largest component minus ``low``
    width: int          # bits of a field
    fields: int         # candidates of one wide integer
    exact_doubles: bool

    @classmethod
    def of(cls, dim: int, low: float, high: float, weight: int) -> Packing:
        """For components within low..high and anchors whose sum(|component|) is ``weight``."""
        low, high = min(0, int(low)), max(0, int(high))
        reach = max(1, high - low)
        width = max(1, (reach * weight).bit_length())
        fields = WORD_BITS // width
        return cls(dim, low, reach, width, fields or WIDE_FIELDS, fields > 0)

    @property
    def kind(self):
        return np.float64 if self.exact_doubles else object

    def integers(self, rows: np.ndarray) -> np.ndarray:
        """Integer-valued components in the carrier's type."""
        if self.exact_doubles:
            return rows
        return np.array([[int(x) for x in row] for row in rows], dtype=object).reshape(rows.shape)

    def pack(self, rows: np.ndarray) -> np.ndarray:
        """Wide integers (groups of ``fields`` rows) x components."""
        groups = -(-len(rows) // self.fields)
        biased = np.zeros((groups * self.fields, self.dim), dtype=self.kind)
        biased[:len(rows)] = self.integers(rows) - self.low
        out = np.zeros((groups, self.dim), dtype=self.kind)
        for j in range(self.fields):
            out += biased[j::self.fields] * (2 ** (self.width * j))
        return out

    def scores(self, anchors: np.ndarray, packed: np.ndarray, n: int) -> np.ndarray:
        """Exact inner products anchors x n candidates, as longs."""
        a = self.integers(anchors)
        spread = sum(1 << (self.width * j) for j in range(self.fields))
        # the bias that keeps every field of the sum from falling below zero
        bias = self.reach * np.maximum(-a, 0).sum(axis=1)
        total = a @ packed.T + (bias * spread)[:, None]
        back = bias - self.low * a.sum(axis=1)
        if not self.exact_doubles:
            return self._wide(total, back, n)
        total, back = total.astype(np.int64), back.astype(np.int64)
        out = np.empty((len(a), packed.shape[0] * self.fields), dtype=np.int64)
        mask = np.int64((1 << self.width) - 1)
        for j in range(self.fields):
            out[:, j::self.fields] = ((total >> np.int64(self.width * j)) & mask) - back[:, None]
        return out[:, :n]

    def _wide(self, total: np.ndarray, back: np.ndarray, n: int) -> np.ndarray:
        mask = (1 << self.width) - 1
        return np.array([[max(-LONG, min(LONG, ((wide >> (self.width * j)) & mask) - less))
                          for wide in row for j in range(self.fields)][:n]
                         for row, less in zip(total, back, strict=True)],
                        dtype=np.int64).reshape(len(back), n)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list<double> column, padded with zeros to ``dim``."""
    lists = pa.concat_arrays([column])
    sizes = np.diff(np.asarray(lists.offsets))
    flat = np.asarray(lists.flatten())
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = flat
    return out


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str, anchors: Column,
                    scale: int) -> DataFrame:
    """(row, id, label, anchor, c) of the rows that take part; c holds floor(scale * x)."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            lists = pa.concat_arrays([batch.column("c")])
            whole = pa.ListArray.from_arrays(
                lists.offsets, pa.array(np.floor(np.asarray(lists.values) * float(scale))))
            yield pa.record_batch(
                [pa.array(np.arange(at, at + batch.num_rows, dtype=np.int64)),
                 *(batch.column(c) for c in ("id", "label", "anchor")), whole],
                ["row", "id", "label", "anchor", "c"])
            at += batch.num_rows

    part = rows.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(
        vector_col, lambda x: x.isNotNull() & ~F.isnan(x)
        & (F.abs(x.cast("double")) <= F.lit(1.7e308 / scale))))
    return part.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col(vector_col).cast("array<double>").alias("c")).mapInArrow(
        number, "row long, id long, label long, anchor boolean, c array<double>")


class _Best:
    """The best ``k`` candidates of every anchor: score, then id (null last), then row."""

    def __init__(self, anchors: int, k: int):
        self.k = k
        self.rows = [None] * anchors
        self.least = np.full(anchors, -LONG - 1, dtype=np.int64)

    def offer(self, scores: np.ndarray, eligible: np.ndarray, ids: np.ndarray,
              missing: np.ndarray, row: np.ndarray) -> None:
        eligible &= scores >= self.least[:, None]
        for i in np.flatnonzero(eligible.any(axis=1)):
            at = np.flatnonzero(eligible[i])
            if len(at) > 8 * self.k:
                # all ties of the k-th best stay
                cut = np.partition(scores[i, at], len(at) - self.k)[len(at) - self.k]
                at = at[scores[i, at] >= cut]
            new = np.array([scores[i, at], missing[at], ids[at], row[at]])
            if self.rows[i] is not None:
                new = np.concatenate([self.rows[i], new], axis=1)
            order = np.lexsort((new[3], new[2], new[1], -new[0]))[:self.k]
            self.rows[i] = new[:, order]
            if len(order) == self.k:
                self.least[i] = new[0, order[-1]]

    def columns(self) -> tuple[np.ndarray, np.ndarray]:
        """The anchors' places, and (score, missing, id, row) of what they kept."""
        kept = [(i, r) for i, r in enumerate(self.rows) if r is not None]
        if not kept:
            return np.zeros(0, dtype=np.int64), np.zeros((4, 0), dtype=np.int64)
        return (np.repeat([i for i, _ in kept], [r.shape[1] for _, r in kept]),
                np.concatenate([r for _, r in kept], axis=1))


FOUND = "anchor long, slot int, score long, missing boolean, id long, row long"


def _found(bests: list[_Best], anchors: np.ndarray) -> Iterator[pa.RecordBatch]:
    for slot, best in enumerate(bests):
        at, (score, missing, ids, row) = best.columns()
        yield pa.record_batch(
            [pa.array(anchors[at]), pa.array(np.full(len(at), slot, dtype=np.int32)),
             pa.array(score), pa.array(missing.astype(bool)),
             pa.array(ids, mask=missing.astype(bool)), pa.array(row)],
            ["anchor", "slot", "score", "missing", "id", "row"])


def _blocks(batches: Iterator[pa.RecordBatch], packing: Packing, anchors: np.ndarray):
    """(scores, labels, ids, missing, row) of blocks of candidates."""
    step = max(64, BLOCK_SCORES // max(1, len(anchors)))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            packed = packing.pack(_matrix(part.column("c"), packing.dim))
            ids = part.column("id")
            yield (packing.scores(anchors, packed, part.num_rows),
                   np.asarray(part.column("label")), np.asarray(ids.fill_null(LONG)),
                   np.asarray(ids.is_null()), np.asarray(part.column("row")))


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of the tasks' lists, ranked."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "missing", "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, id_col: str = "vec_id",
         vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on the columns of ``rows``.
    """
    spark = rows.sparkSession
    vectors = stored(integer_vectors(rows, id_col, vector_col, label_col, anchors, scale), "vectors")
    weight = F.aggregate("c", F.lit(0.0), lambda s, x: s + F.abs(x))
    m = vectors.agg(F.max(F.size("c")).alias("dim"), F.min(F.array_min("c")).alias("low"),
                    F.max(F.array_max("c")).alias("high"),
                    F.max(F.when(F.col("anchor"), weight)).alias("weight"),
                    F.count_if(F.col("anchor")).alias("anchors")).first()
    out = scratch_path(spark, "negatives")
    result = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    if not m["anchors"]:
        return spark.createDataFrame([], result)
    # sums of doubles above 2**53 are rounded; one bit more covers that
    weight = int(m["weight"]) * (2 if m["weight"] >= 2 ** 53 else 1)
    packing = Packing.of(m["dim"], m["low"] or 0, m["high"] or 0, weight)
    size = max(1, min(chunk_rows, CHUNK_BYTES // (8 * max(1, packing.dim))))
    chunks = -(-m["anchors"] // size)
    for chunk in range(chunks):
        _mine_chunk(vectors.where(F.col("anchor") & (
            F.pmod(F.xxhash64("row"), F.lit(chunks)) == chunk)), vectors, packing, positives,
            negatives, low, high).write.mode("append").option("compression", "zstd").parquet(out)
    return spark.read.schema(result).parquet(out)


def _mine_chunk(anchors: DataFrame, vectors: DataFrame, packing: Packing, positives: int,
                negatives: int, low: int, high: int) -> DataFrame:
    """The result's rows for one bounded chunk of anchors."""
    sc = vectors.sparkSession.sparkContext
    taken = anchors.select("row", "id", "label", "c").toArrow().combine_chunks()
    here = np.asarray(taken["row"])
    shared = sc.broadcast((here, np.asarray(taken["label"]),
                           _matrix(taken["c"].combine_chunks(), packing.dim)))
    candidates = vectors.select("row", "id", "label", "c")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, label, matrix = shared.value
        best = _Best(len(row), positives)
        for scores, labels, ids, missing, rows in _blocks(batches, packing, matrix):
            best.offer(scores, (label[:, None] == labels) & (row[:, None] != rows), ids, missing,
                       rows)
        yield from _found([best], row)

    # at most ``positives`` rows an anchor of this chunk come to the driver
    nearest = _merged(candidates.mapInArrow(near, FOUND), positives).select(
        "anchor", "rank", "score", "id").toArrow()
    place = {int(r): i for i, r in enumerate(here)}
    # an empty range where an anchor has fewer positives
    floor = np.full((positives, len(here)), 1, dtype=np.int64)
    roof = np.zeros((positives, len(here)), dtype=np.int64)
    for a, rank, score in zip(*(nearest[c].to_pylist() for c in ("anchor", "rank", "score")),
                              strict=True):
        floor[rank - 1, place[a]] = -(-low * score // 100)
        roof[rank - 1, place[a]] = high * score // 100
    ranges = sc.broadcast((floor, roof))

    def hard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, label, matrix = shared.value
        bests = [_Best(len(row), negatives) for _ in range(positives)]
        for scores, labels, ids, missing, rows in _blocks(batches, packing, matrix):
            other = label[:, None] != labels
            for best, least, most in zip(bests, *ranges.value, strict=True):
                best.offer(scores, other & (scores >= least[:, None]) & (scores <= most[:, None]),
                           ids, missing, rows)
        yield from _found(bests, row)

    spark = vectors.sparkSession
    pairs = spark.createDataFrame(pa.table({
        "anchor": nearest["anchor"], "slot": pa.array(np.asarray(nearest["rank"]) - 1, pa.int32()),
        "positive_id": nearest["id"], "positive_score": nearest["score"]}))
    names = spark.createDataFrame(pa.table({"anchor": taken["row"], "anchor_id": taken["id"]}))
    return (_merged(candidates.mapInArrow(hard, FOUND), negatives)
            .join(pairs, ["anchor", "slot"]).join(names, "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
