import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.llm import hard_negatives
from tickframe.llm.hard_negatives import Packing

SCHEMA = ("vec_id long, embedding array<double>, label int, row long, id long, anchor long, "
          "score long, c string")
LONG = (1 << 63) - 1


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "clash") for r in rows], SCHEMA)


def brute(rows, positives=5, negatives=10, low=30, high=90):
    kept = []
    for n, (i, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x)
                                                  for x in vector):
            continue
        kept.append((n, i, label, [math.floor(256 * x) for x in vector]))

    def score(a, b):
        return max(-LONG, min(LONG, sum(x * y for x, y in zip(a, b, strict=False))))

    out = []
    for n, i, label, vector in kept:
        if i is None or i % 100:
            continue
        others = sorted((-score(vector, v), j is None, j or 0, m, y) for m, j, y, v in kept
                        if m != n)
        for s, null, j, _, _ in [o for o in others if o[4] == label][:positives]:
            found = [o for o in others if o[4] != label and low * -s <= -100 * o[0] <= high * -s]
            out += [(i, None if null else j, k + 1, None if o[1] else o[2], -s, -o[0])
                    for k, o in enumerate(found[:negatives])]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    got = hard_negatives.mine(frame(spark, rows), F.expr("vec_id % 100 = 0"), **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(map(tuple, got.collect()), key=repr)


def vectors(seed, n, dim=6):
    draw = random.Random(seed)
    return [(i * 10, [round(draw.gauss(0.2, 1), 1) for _ in range(dim)], draw.randrange(3))
            for i in range(n)]


def odd_vectors():
    return [*vectors(1, 60), (100, [1.0, 1.0, 0.5, 0.0, 0.0, 0.0], 1),
            (100, [1.0, 1.0, 0.5, 0.0, 0.0, 0.0], 1),      # repeated rows
            (7, [1.0, 1.0, 0.5, 0.0, 0.0, 0.0], 2), (8, [1.0, 1.0, 0.5, 0.0, 0.0, 0.0], 2),
            (None, [0.6, 0.6, 0.5, 0.0, 0.0, 0.0], 2), (None, [0.9, 0.9], 1),
            (300, [], 1), (301, None, 1), (400, [0.1, None], 2), (500, [math.nan, 1.0], 2),
            (600, [math.inf], 0), (700, [1.0, 0.2], None), (800, [2.0], 1)]


def test_equals_brute_force(spark):
    assert mined(spark, odd_vectors()) == brute(odd_vectors())


def test_chunks_of_anchors(spark):
    rows = vectors(2, 150)
    assert mined(spark, rows, chunk_rows=3) == brute(rows)


@pytest.mark.parametrize("scale", [1e9, 1e15])
def test_wide_fields(spark, scale):
    """Fields beyond 53 bits, and scores beyond 64."""
    rows = [(i, [x * scale for x in v], y) for i, v, y in vectors(3, 40, 4)]
    assert mined(spark, rows) == brute(rows)


def test_hot_label(spark):
    rows = [(i, [1.0, float(i % 3)], 0) for i in range(2000)] + [(5000, [0.5, 0.5], 1)]
    assert mined(spark, rows) == brute(rows)


def test_no_anchor_and_empty(spark):
    assert mined(spark, [(1, [1.0], 0)]) == []
    assert mined(spark, []) == []


@pytest.mark.parametrize("top", [3, 80, 3000, 10 ** 7, 10 ** 12])
def test_packing_is_exact(top):
    draw = np.random.default_rng(top)
    rows = draw.integers(-top, top + 1, (37, 9)).astype(float)
    anchors = draw.integers(-top, top + 1, (5, 9)).astype(float)
    rows[0], anchors[0] = -top, top
    packing = Packing.of(9, rows.min(), rows.max(), int(np.abs(anchors).sum(axis=1).max()))
    got = packing.scores(anchors, packing.pack(rows), len(rows))
    want = [[max(-LONG, min(LONG, sum(int(x) * int(y) for x, y in zip(a, r, strict=True))))
             for r in rows] for a in anchors]
    assert got.tolist() == want
    assert packing.fields > 1 or packing.width > 26
