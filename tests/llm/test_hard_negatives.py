"""Hard negatives against a plain loop."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vidguard.llm import hard_negatives as H

COLUMNS = "vec_id long, embedding array<float>, label int, score string, planes string, rank string"


def brute(rows, anchors, positives=5, negatives=5):
    """The contract, row by row."""
    kept = []
    for key, vector, label in rows:
        if None in (key, label) or vector is None or any(
                x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((key, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    for key, vector, label in kept:
        if not anchors(key):
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), k, lab)
                        for k, v, lab in kept if k != key)
        for neg, positive, lab in [s for s in scored if s[2] == label][:positives]:
            mine = [s for s in scored if s[2] != label
                    and 80 * -neg <= 100 * -s[0] <= 100 * -neg][:negatives]
            out += [(key, positive, i + 1, k, -neg, -s) for i, (s, k, _) in enumerate(mine)]
    return sorted(out)


def mined(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], COLUMNS).repartition(3)
    got = H.hard_negatives(df, F.col("vec_id") % 10 == 0, **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(map(tuple, got.collect()))


def random_rows(n, dim, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dim)
    return [(i, [float(x) for x in np.float32(centre + spread * rng.normal(size=dim))], int(i % 4))
            for i in range(n)]


@pytest.mark.parametrize("dim, block", [(13, 8192), (64, 6)])
def test_equal_to_a_plain_loop(spark, dim, block):
    """Copies of one vector under many keys tie; several blocks of anchors."""
    rows = random_rows(150, dim)
    rows += [(1000 + i, rows[7][1], i % 3) for i in range(40)]
    want = brute(rows, lambda k: k % 10 == 0)
    assert want and mined(spark, rows, block_anchors=block) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(40, 8) + [
        (100, None, 1), (110, [1.0, None], 1), (120, [nan, 1.0], 1), (130, [inf], 1), (None, [1.0], 1),
        (140, [1.0, 2.0], None), (150, [], 2), (160, [0.0] * 8, 2), (170, [3.0, 1.0], 2),
        (180, [-0.001, 500.0, -500.0] + [0.25] * 9, 3), (190, [2.0e3] * 8, 0), (190, [2.0e3] * 8, 0)]
    assert mined(spark, rows) == brute(rows, lambda k: k % 10 == 0)


def test_wide_components_and_empty_table(spark):
    rows = [(i, [float((i * 37 % 11 - 5) * 10 ** 6), float(i)], i % 2) for i in range(30)]
    assert mined(spark, rows) == brute(rows, lambda k: k % 10 == 0)
    assert mined(spark, []) == [] and mined(spark, [(10, [1.0], 1)]) == []


def test_subset_sums_score_every_pair_exactly():
    rng = np.random.default_rng(3)
    a, c = rng.integers(-300, 300, (5, 21)), rng.integers(-512, 512, (9, 21))
    cube = H.pack(c, 11).reshape(9, 11, 3).transpose(1, 2, 0)
    assert (H.looked_up(H.subset_sums(a), cube) == c @ a.T).all()
