"""Quality classifier: random Fourier features over document statistics.

Each text becomes a short vector of statistics (sizes, character classes,
repetition, line structure), taken over the whole text.  Random Fourier
features of the standardised vector approximate a Gaussian kernel; ridge scores
come from normal equations summed in each partition and then over partitions.
Part of the training rows is kept out of the fit and calibrates the scores by
isotonic regression.

The model is fitted on at most ``max_train`` labelled rows (picked by hash of
the id, all of them if there are no more); every row is scored.

Cases: null and empty texts have all statistics at zero and are scored like
any other vector; rows may repeat; labels with a null id or value are left
out, of several labels of a document the largest counts; without labels of
both kinds every score is the share of label 1 (0.5 without any label); an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import stored
from tickframe.llm.kernels import apply_knots, bounded, fit_isotonic, one_label, tree_sum

MAX_TRAIN = 200_000
FEATURES = 384
RIDGE = 1e-3
GAMMA = 0.06
THRESHOLD = 0.7
STATISTICS = 20


def statistics(text: bytes) -> np.ndarray:
    """Statistics of one whole text."""
    out = np.zeros(STATISTICS)
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return out
    hist = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    upper, lower, high = hist[65:91].sum(), hist[97:123].sum(), hist[128:].sum()
    letters = max(1, upper + lower + high)
    lens = np.fromiter(map(len, words), dtype=np.int32, count=n)
    lines = text.split(b"\n")
    marks = {m: hist[ord(m)] for m in "!|*#$%&.,"}
    repeats = sum(map(operator.eq, words, islice(words, 1, None)))
    words_upper = sum(map(bytes.isupper, words))
    distinct = len(set(words))
    out[:] = (
        np.log1p(n), lens.mean(), lens.std(), np.log(distinct) / np.log(n + 1),
        distinct / n, np.sqrt(repeats / n), upper / letters, np.sqrt(words_upper / n),
        hist[48:58].sum() / size, np.sqrt(marks["!"] / n), np.sqrt(marks["|"] / n),
        np.sqrt((marks["*"] + marks["#"] + marks["$"] + marks["%"] + marks["&"]) / n),
        marks["."] / n, marks[","] / n, (lens <= 3).mean(), (lens >= 12).mean(),
        np.log1p(len(lines)), np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines),
        1 - (letters + hist[32] + hist[10]) / size)
    return out


def document_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t or b"") for t in batch.column(1).cast(pa.binary()).to_pylist()]
            flat = pa.array(np.concatenate(rows) if rows else np.zeros(0))
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * STATISTICS)
            yield pa.record_batch([batch.column(0), batch.column(2),
                                   pa.ListArray.from_arrays(ends, flat)],
                                  ["doc_id", "text_hash", "x"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, x array<double>")


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray | None
    knots: tuple[list[float], list[float]]

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        phi = np.cos(z @ self.omega + self.phase) * np.sqrt(2.0 / self.omega.shape[1])
        return np.hstack([phi, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.zeros(len(x)) if self.weights is None else self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return apply_knots(self.raw(x), self.knots)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(pa.concat_arrays([column]).flatten()).reshape(-1, STATISTICS)


def _summed(rows: DataFrame, part) -> list[np.ndarray]:
    """Sums over all rows of the arrays that ``part(x, y)`` returns for a batch."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_matrix(batch.column("x")),
                             np.asarray(batch.column("label"), dtype=float))
                total = found if total is None else [a + b for a, b in
                                                     zip(total, found, strict=True)]
        if total is not None:
            flat = np.concatenate([np.atleast_1d(a).ravel() for a in total])
            yield pa.record_batch([pa.array([flat.tobytes()], pa.binary())], ["sums"])

    flat = tree_sum(rows.select("x", "label").mapInArrow(partial, "sums binary"))
    shapes = [np.atleast_1d(a) for a in part(np.zeros((1, STATISTICS)), np.zeros(1))]
    if flat is None:
        flat = np.zeros(sum(a.size for a in shapes))
    cuts = np.cumsum([a.size for a in shapes])[:-1]
    return [a.reshape(s.shape) for a, s in zip(np.split(flat, cuts), shapes, strict=True)]


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE, gamma: float = GAMMA,
        seed: int = 7) -> QualityModel:
    """Fit on rows (doc_id, x, label)."""
    n, first, second, ones = _summed(rows, lambda x, y: [
        np.array([float(len(x))]), x.sum(0), (x * x).sum(0), np.array([y.sum()])])
    count = max(float(n[0]), 1.0)
    mean = first / count
    scale = np.sqrt(np.maximum(second / count - mean ** 2, 1e-12))
    scale[scale < 1e-5] = 1.0
    draw = np.random.default_rng(seed)
    omega = draw.normal(size=(STATISTICS, features)) * np.sqrt(2 * gamma)
    phase = draw.uniform(0, 2 * np.pi, features)
    model = QualityModel(mean, scale, omega, phase, None, ([], []))
    if not 0 < ones[0] < n[0]:
        if n[0]:
            model.knots = ([0.0], [float(ones[0] / n[0])])
        return model
    held = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(4)) == 0
    base = QualityModel(mean, scale, omega, phase, None, ([], []))

    def normal(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        phi = base.features(x)
        return [phi.T @ phi, phi.T @ y, np.array([float(len(x))])]

    a, b, m = _summed(rows.where(~held), normal)
    penalty = ridge * max(float(m[0]), 1.0) * np.eye(len(a)) / features
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(a + penalty + 1e-9 * np.eye(len(a)), b)
    raw = _scored(rows.where(held), model.raw, ["doc_id", "label"])
    model.knots = fit_isotonic(raw, "score", "label")
    if not model.knots[0]:
        model.knots = fit_isotonic(_scored(rows, model.raw, ["doc_id", "label"]), "score", "label")
    return model


def _scored(rows: DataFrame, of, keep: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = of(_matrix(batch.column("x")))
            yield pa.record_batch([*(batch.column(c) for c in keep), pa.array(score)],
                                  [*keep, "score"])
    kinds = dict(rows.dtypes)
    return rows.select(*keep, "x").mapInArrow(
        run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", score double")


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column,
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, text_hash for every row of ``docs``.

    ``text_hash`` tells rows of one id apart.  ``held_out`` is a condition on ``doc_id``; labels are learnt from the other rows.
    """
    x = stored(document_statistics(docs, id_col, text_col), "statistics")
    train = (x.where(~held_out).join(one_label(labels, label_col, id_col),
                                     F.col("doc_id") == F.col("label_id")))
    model = fit(stored(bounded(train, F.col("doc_id"), max_train)
                       .select("doc_id", "x", "label"), "quality-train"))
    scored = _scored(x, model.score, ["doc_id", "text_hash"])
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"),
                         "text_hash")
