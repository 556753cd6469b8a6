"""Hard negatives against all scores by brute force, and their defined cases."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from riskflow.llm import hard_negatives as hard

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, window string, score string"


def mined_by_hand(rows, is_anchor, positives=5, negatives=10):
    usable = []
    for i, vector, label in rows:
        if i is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((i, tuple(math.floor(256 * float(np.float32(x))) for x in vector), label))

    def score(a, b):
        return sum(x * y for x, y in zip(a[1], b[1], strict=False))

    for a in {row for row in usable if is_anchor(row[0])}:
        ranked = sorted(((-score(a, r), r[0], r[2]) for r in usable))
        same = [(i, -s) for s, i, label in ranked if label == a[2] and i != a[0]][:positives]
        for p, ps in same:
            fits = [(i, -s) for s, i, label in ranked if label != a[2] and 30 * ps <= -100 * s <= 90 * ps]
            for rank, (i, ns) in enumerate(fits[:negatives], start=1):
                yield a[0], p, rank, i, ps, ns


def mined(spark, rows, where="vec_id % 10 = 0"):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    return [tuple(r) for r in hard.hard_negatives(frame, F.expr(where)).collect()]


def check(spark, rows):
    result = mined(spark, rows)
    assert sorted(result) == sorted(mined_by_hand(rows, lambda i: i % 10 == 0))
    return result


@pytest.mark.parametrize("dims, spread, block", [(64, 1.0, 8192), (24, 0.3, 50), (5, 2.0, 16)])
def test_equals_all_scores(spark, monkeypatch, dims, spread, block):
    monkeypatch.setattr(hard, "BLOCK", block)
    monkeypatch.setattr(hard, "BATCH", 7)
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(4, dims))
    rows = []
    for i in range(300):
        x = centres[i % 4] * spread + rng.normal(size=dims) * (1 / (1 + np.arange(dims)))
        rows.append((i, [float(np.float32(v)) for v in x / np.linalg.norm(x)], int(rng.integers(4))))
    assert check(spark, rows)


def test_slices_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(hard, "ANCHORS", 3)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], i % 3) for i in range(100)]
    assert check(spark, rows)


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 0.5, 1.0]) for _ in range(4)], i % 2) for i in range(60)]
    rows += [
        (None, [1.0] * 4, 0),
        (100, None, 0),
        (110, [1.0, None, 1.0, 1.0], 0),
        (120, [float("nan")] * 4, 0),
        (130, [float("inf")] * 4, 1),
        (140, [1.0] * 4, None),
        (150, [], 0),
        (160, [1.0, 1.0], 0),
        (170, [1.0] * 9, 1),
        (180, [-1.0] * 4, 7),
        (10, rows[10][1], 0),
        (10, rows[10][1], 0),
        (11, rows[11][1], 1),
        (11, rows[11][1], 1),
    ]
    result = check(spark, rows)
    assert {r[0] for r in result} >= {0, 10, 170} and not {r[0] for r in result} & {100, 110, 120, 130, 140, 180}


def test_no_rows(spark):
    assert mined(spark, [(10, None, 1)]) == []
    assert mined(spark, [(11, [1.0], 1), (12, [1.0], 2)]) == []


def test_scores_beyond_the_exact_range_of_floats(spark):
    rng = random.Random(5)
    rows = [(i, [float(np.float32(rng.uniform(0, 1 << 20))) for _ in range(8)], i % 2) for i in range(40)]
    assert check(spark, rows)


def test_lists_leave_out_dimensions_that_cannot_matter():
    rng = np.random.default_rng(6)
    matrix = np.floor(256 * rng.normal(size=(500, 64)) / (1 + np.arange(64)))
    import pyarrow as pa

    block = hard.Block(pa.array(range(500)), pa.array([0] * 500), matrix, np.arange(64))
    asked, norm = matrix[:10], np.linalg.norm(matrix[:10], axis=1).max()
    least = np.full(10, int(0.7 * norm * np.linalg.norm(matrix, axis=1).max()), np.int64)
    sizes = [len(rows) for rows in block.lists(norm, least[0])]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == 0 and sizes[0] < 500
    query, row, score = block.pairs(asked, least, np.ones((10, 500), bool))
    scores = asked @ matrix.T
    assert {*zip(query.tolist(), row.tolist(), score.tolist(), strict=True)} == {
        (int(q), int(r), int(scores[q, r])) for q, r in np.argwhere(scores >= least[:, None])
    }
