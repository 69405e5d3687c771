"""Merged quantile sketches against the exact medians."""

import numpy as np

from vidguard.operators import gold, sketches

NAN, INF = float("nan"), float("inf")
SCHEMA = "video_id string, snapshot_date string, a double, b double, c double"


def rank_off(values, median):
    values = np.array(values)
    return max((values < median).mean() - 0.5, 0.5 - (values <= median).mean())


def test_few_values_are_exact(spark):
    rows = [(f"v{i}", f"2025-0{1 + i % 2}-01", float(i % 7), None if i % 3 else NAN, float(i * i % 11))
            for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    exact = {(r.snapshot_date, c): r[f"{c}_median"] for r in gold.snapshot_medians(
        [(df, ["a", "b", "c"])]).collect() for c in "abc"}
    parts = [sketches.median_sketches([(df.where(f"substr(video_id, -1) in ({d})"), ["a", "b", "c"])])
             for d in ("'0','1','2'", "'3','4'", "'5','6','7','8','9'")]
    got = {(r.snapshot_date, r.feature): r.median
           for r in sketches.sketched_medians(sketches.merged(*parts)).collect()}
    assert got == exact and got["2025-01-01", "b"] is None


def test_late_parts_keep_the_rank_error(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.lognormal(0, 3, 30_000), np.full(9_000, 1.5), -rng.random(21_000)])
    rng.shuffle(values)
    rows = [("v", "2025-01-01", float(v), INF if i % 5 else NAN, float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    early = sketches.median_sketches([(df.where("a > 0.5"), ["a", "b"])])
    late = sketches.median_sketches([(df.where("a <= 0.5"), ["a", "b"])])
    got = {r.feature: r for r in sketches.sketched_medians(sketches.merged(early, late)).collect()}
    assert got["a"].n == len(values) and rank_off(values, got["a"].median) <= sketches.RANK_ERROR
    assert got["b"].n == 0 and got["b"].median is None
