"""Calibration shared by the classifiers: binned isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096
SLOPE = 1e-3


def isotonic(bins: list[tuple[float, float, float, float]]) -> tuple[list[float], list[float]]:
    """Pool adjacent violators over (lowest score, highest score, weight, positives) bins.

    Returns the knots of an increasing, piecewise linear map from score to
    probability: flat over each pooled block but for a slope of ``SLOPE`` in
    all, which keeps the order of scores, and linear between blocks.
    """
    blocks: list[list[float]] = []
    for low, high, weight, positive in sorted(bins):
        blocks.append([weight, positive, low, high])
        while len(blocks) > 1 and (blocks[-2][1] * blocks[-1][0]
                                   >= blocks[-1][1] * blocks[-2][0]):
            w, p, _, h = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + p, blocks[-1][2], h]
    x, y = [], []
    for w, p, low, high in blocks:
        x += [low, high] if high > low else [low]
        y += [p / w, p / w] if high > low else [p / w]
    return x, [(1 - SLOPE) * v + SLOPE * (i + 1) / (len(y) + 1) for i, v in enumerate(y)]


def fit_isotonic(scored: DataFrame, score: str, label: str, low: float = -1.0,
                 high: float = 2.0) -> tuple[list[float], list[float]]:
    """Isotonic knots from a frame of scores and 0/1 labels, summed into ``BINS`` bins."""
    clipped = F.least(F.greatest(F.col(score), F.lit(low)), F.lit(high))
    width = (high - low) / BINS
    rows = (scored.groupBy(F.floor((clipped - low) / width).alias("bin"))
            .agg(F.min(clipped).alias("low"), F.max(clipped).alias("high"),
                 F.count(F.lit(1)).alias("n"),
                 F.sum(F.col(label).cast("double")).alias("p")).collect())
    return isotonic([(r["low"], r["high"], float(r["n"]), r["p"]) for r in rows])


def apply_knots(scores: np.ndarray, knots: tuple[list[float], list[float]]) -> np.ndarray:
    x, y = knots
    if not x:
        return np.full(len(scores), 0.5)
    return np.clip(np.interp(scores, x, y), 0.0, 1.0)


def one_label(labels: DataFrame, column: str, id_col: str = "doc_id") -> DataFrame:
    """One 0/1 label a document: nulls go, the largest of several counts."""
    return (labels.where(F.col(id_col).isNotNull() & F.col(column).isNotNull())
            .groupBy(F.col(id_col).alias("label_id"))
            .agg(F.max((F.col(column) > 0).cast("int")).alias("label")))


def bounded(rows: DataFrame, key: Column, most: int, n: int | None = None) -> DataFrame:
    """All rows, or about ``most`` of the ``n`` that count (all) picked by the hash of a key."""
    n = rows.count() if n is None else n
    if n <= most:
        return rows
    return rows.where(F.shiftrightunsigned(F.xxhash64(key), 1) < (most << 63) // n)


def tree_sum(parts: DataFrame, ways: int = 32) -> np.ndarray | None:
    """The sum of rows of float64 arrays (one binary column), by way of a few tasks.

    No task reads more than its share of the rows, and the driver gets one.
    """
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = None
        for batch in batches:
            for value in batch.column(0):
                add = np.frombuffer(value.as_buffer())
                flat = add.copy() if flat is None else flat + add
        if flat is not None:
            yield pa.record_batch([pa.array([flat.tobytes()], pa.binary())], ["sums"])

    got = (parts.repartition(ways).mapInArrow(total, "sums binary")
           .repartition(1).mapInArrow(total, "sums binary").collect())
    return np.frombuffer(got[0][0]) if got else None
