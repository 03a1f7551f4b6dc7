"""Hard negatives against all scores, and the bounds against scores."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostpulse.llm.negatives import (
    angle_interval,
    angles_to,
    fit_references,
    hard_negatives,
    score_bounds,
)

VECTORS = "vec_id bigint, label int, embedding array<double>"
ANCHORS = "vec_id % 10 = 0"


def brute(rows, low=30, high=90, positives=5, negatives=10):
    usable = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        if sum(x * x for x in whole) < 2**56:
            usable[vec_id, label, tuple(vector)] = (vec_id, label, whole)
    rows, found = list(usable.values()), []
    for anchor in (row for row in rows if row[0] % 10 == 0):
        scored = [
            (-sum(a * b for a, b in zip(anchor[2], row[2])), row[0], row[1])
            for row in rows
            if row[0] != anchor[0] and len(row[2]) == len(anchor[2])
        ]
        scored.sort()
        for best, positive, _ in [row for row in scored if row[2] == anchor[1]][:positives]:
            window = [
                row for row in scored
                if row[2] != anchor[1] and low * -best <= 100 * -row[0] <= high * -best
            ]
            for rank, (score, negative, _) in enumerate(window[:negatives], 1):
                found.append((anchor[0], positive, rank, negative, -best, -score))
    return sorted(found)


def found(spark, rows, **settings):
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    frame = frame.withColumns({name: F.lit("x") for name in ("cell", "norm", "mark", "score", "vector")})
    result = hard_negatives(frame, F.expr(ANCHORS), **settings)
    assert result.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    return sorted(tuple(row) for row in result.collect())


def test_bounds_hold():
    rng = np.random.default_rng(3)
    whole = np.floor(256 * rng.normal(size=(300, 12)) * rng.lognormal(size=(300, 1)))
    whole[0] = 0
    whole[1] = whole[2] * 3
    refs = fit_references(whole, 16)
    assert np.allclose(np.linalg.norm(refs, axis=1), 1) and len(refs) == 16
    angles = angles_to(whole, refs).astype("<f4").astype(float)
    norms = np.linalg.norm(whole, axis=1)
    least, most = angle_interval(angles[:, None], angles[None], angles[None])
    low, high = score_bounds(least, most, norms[:, None] * norms, norms[:, None] * norms)
    scores = whole @ whole.T
    assert (low <= scores).all() and (scores <= high).all()
    assert (high - low).mean() < 2 * (norms[:, None] * norms).mean()
    # And for a whole cell: least and largest angles and norms of its rows.
    for cell in range(16):
        rows = angles.argmin(axis=1) == cell
        if rows.any():
            least, most = angle_interval(angles, angles[rows].min(axis=0), angles[rows].max(axis=0))
            low, high = score_bounds(least, most, norms * norms[rows].min(), norms * norms[rows].max())
            inside = scores[:, rows]
            assert (low[:, None] <= inside).all() and (inside <= high[:, None]).all()


@pytest.mark.parametrize("references", [1, 8, 64])
def test_against_all_scores(spark, references):
    rng = np.random.default_rng(references)
    middles = rng.normal(size=(6, 8))
    rows = []
    for vec_id in range(700):
        label = int(rng.integers(6))
        vector = middles[label] + rng.normal(size=8) * rng.choice([0.1, 1.0, 2.0])
        rows.append((vec_id, label, np.round(vector, 2).tolist()))
    rows += [(vec_id, int(rng.integers(6)), rows[10][2]) for vec_id in range(700, 760)]  # ties
    expected = brute(rows)
    assert len(expected) > 500 and found(spark, rows, references=references) == expected


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(vec_id, vec_id % 3, (rng.normal(size=3) + 1).tolist()) for vec_id in range(60)]
    rows += [
        (None, 1, [1.0, 1.0, 1.0]),
        (100, None, [1.0, 1.0, 1.0]),
        (110, 1, None),
        (120, 1, [1.0, None, 1.0]),
        (130, 1, [1.0, float("nan"), 1.0]),
        (140, 1, [1.0, float("inf"), 1.0]),
        (150, 1, [0.0, 0.0, 0.0]),
        (160, 1, []),
        (161, 1, []),
        (162, 2, []),
        (170, 1, [1.0, 2.0]),
        (171, 1, [1.0, 2.5]),
        (172, 2, [0.5, 0.7]),
        (180, 1, [3e5, 2e5, 1e5]),
        (181, 1, [2e5, 2e5, 2e5]),
        (182, 2, [1e5, 1.5e5, 1e5]),
        (183, 2, [1e5, 1.5e5, -1e5]),
        (190, 2, [1e300, 1.0, 1.0]),
        (200, 0, [1.0, 2.0, 3.0]),
        (200, 1, [3.0, 2.0, 1.0]),
        (-10, 2, [-1.0, -1.0, -1.0]),
    ]
    rows += rows[:5] + [rows[-1]]
    assert found(spark, rows) == brute(rows)


def test_empty_and_alone(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, 1, [1.0, 0.0])]) == []
    assert found(spark, [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0])]) == []


def test_a_hot_vector_in_several_blocks(spark):
    rng = np.random.default_rng(9)
    rows = [(vec_id, vec_id % 2, [1.0, 0.5]) for vec_id in range(2500)]
    rows += [(5000 + vec_id, vec_id % 4, rng.normal(size=2).tolist()) for vec_id in range(300)]
    frame = spark.createDataFrame(rows, VECTORS)
    some = F.expr("vec_id % 500 = 0")
    ours = hard_negatives(frame, some)
    ours = sorted(tuple(row) for row in ours.collect())
    expected = [row for row in brute([r for r in rows]) if row[0] % 500 == 0]
    assert ours == expected
