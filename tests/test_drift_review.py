from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from vidguard.operators import drift, review

T0 = datetime(2025, 1, 1)
SCHEMA = ("id string, video_id string, layer1_label string, decision string, priority string, "
          "is_cross_medium boolean, feature_score double, match_confidence double, "
          "created_at timestamp, reviewer_verdict string")


def predictions(spark, n, confidence=lambda i: 0.5, harmful=lambda i: True):
    rows = [(f"p{i:04d}", f"v{i % 3}", "harmful" if harmful(i) else "clean",
             "HUMAN REVIEW" if harmful(i) else "ALLOW", "urgent" if i % 4 == 0 else None,
             i % 2 == 0, None if i % 3 else 0.5, confidence(i), T0 + timedelta(minutes=i),
             "REMOVE" if i % 5 == 0 else None) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("n,current", [(0, 0), (1, 0), (2, 1), (7, 3), (30, 10)])
def test_windows(spark, n, current):
    limit = 20 if n == 30 else 1000
    got = drift.windows(predictions(spark, n), limit).collect()
    newest = sorted((r["id"] for r in got), reverse=True)
    assert len(got) == min(n, limit)
    assert {r["id"] for r in got if r["window"] == "current"} == set(newest[:current])


def test_psi_equals_numpy(spark):
    rng = np.random.default_rng(2)
    edge = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0, -0.1, 1.2]
    cur = edge + list(np.round(rng.beta(2, 5, 200), 2))
    ref = edge + list(np.round(rng.beta(5, 2, 150), 2))
    rows = [("current", float(x)) for x in cur] + [("reference", float(x)) for x in ref]
    rows += [("current", None)]
    df = spark.createDataFrame(rows, "window string, match_confidence double")
    edges = np.linspace(0, 1, 11)
    c = (np.histogram(cur, edges)[0] + 1e-6) / (len(cur) + 1e-5)
    r = (np.histogram(ref, edges)[0] + 1e-6) / (len(ref) + 1e-5)
    want = round(float(np.sum((c - r) * np.log(c / r))), 4)
    assert drift.psi(df).first()["psi"] == want
    bins = df.select("match_confidence", drift.score_bin(F.col("match_confidence")).alias("b"))
    got = {r["match_confidence"]: r["b"] for r in bins.collect()}
    assert (got[0.3], got[0.6], got[0.7], got[1.0], got[1.2], got[None]) == (2, 5, 6, 9, None, None)
    assert drift.psi(df.where("window = 'current'")).first()["psi"] is None


def test_metrics_and_alerts(spark):
    df = predictions(spark, 41, confidence=lambda i: 0.1 if i < 20 else 0.9,
                     harmful=lambda i: i > 20)
    metrics, index, fired = drift.drift_report(df)
    by = {r["window"]: r for r in metrics.collect()}
    assert by["current"]["n"] == 20 and by["reference"]["n"] == 21
    assert by["current"]["harmful_rate"] == 1.0 and by["reference"]["harmful_rate"] == 0.0
    rows = [r for r in df.collect() if int(r["id"][1:]) > 20]
    assert by["current"]["feature_missing_rate"] == round(
        sum(r["feature_score"] is None for r in rows) / 20, 4)
    assert by["current"]["override_rate"] == 0.2
    types = {r["type"]: r for r in fired.collect()}
    # an override rate of exactly the limit does not fire
    assert set(types) == {"harmful_rate_drift", "feature_score_missing_high",
                          "score_distribution_drift"}
    assert types["harmful_rate_drift"]["message"] == "Harmful rate changed by 100.00%"
    report = drift.report_rows(metrics, index, fired)
    assert report.where("item = 'alert_count'").first()["value"] == 3.0


def test_report_without_predictions(spark):
    metrics, index, fired = drift.drift_report(predictions(spark, 0))
    assert metrics.count() == 0 and fired.count() == 0 and index.first()["psi"] is None


def test_verdict_applies_to_what_was_logged_before(spark):
    log = spark.createDataFrame(
        [("p1", "v1", T0), ("p2", "v1", T0 + timedelta(hours=2)),
         ("p3", "v1", T0 + timedelta(hours=4)), ("p4", "v2", T0)],
        "id string, video_id string, created_at timestamp")
    verdicts = spark.createDataFrame(
        [("a", "v1", "ALLOW", "x", T0 + timedelta(hours=1)),
         ("b", "v1", "REMOVE", "y", T0 + timedelta(hours=2))],
        "id string, video_id string, verdict string, reviewed_by string, reviewed_at timestamp")
    got = {r["id"]: r["reviewer_verdict"] for r in review.with_verdicts(log, verdicts).collect()}
    assert got == {"p1": "REMOVE", "p2": "REMOVE", "p3": None, "p4": None}
    # brute force: replay the updates in order
    want = {}
    preds = [tuple(r) for r in log.collect()]
    for _, vid, verdict, _, at in sorted(verdicts.collect(), key=lambda r: r["reviewed_at"]):
        want.update({i: verdict for i, v, c in preds if v == vid and c <= at})
    assert {k: v for k, v in got.items() if v} == want


def test_pair_text(spark):
    df = spark.createDataFrame(
        [("q.title<->c.ocr",), ("q.asr<->c.asr",), ("nonsense",), ("q.a<->b<->c.d",), (None,)],
        "pair string")
    q, c = review.pair_mediums(F.col("pair"))
    got = [tuple(r) for r in df.select(q.alias("q"), c.alias("c")).collect()]
    assert got == [("title", "ocr"), ("asr", "asr")] + [("title", "title")] * 3


def test_queue_and_distribution(spark):
    df = predictions(spark, 10, harmful=lambda i: i < 7)
    assert review.queue_size(df).first()["videos_in_queue"] == 7
    assert review.review_queue(df, []).count() == 10
    rows = spark.createDataFrame([("ALLOW", None, None), (None, "cross_medium", "fast")],
                                 "decision string, duplicate_type string, lane string")
    got = {(r["field"], r["value"]): r["n"] for r in review.distribution(rows).collect()}
    assert got == {("decision", "ALLOW"): 1, ("duplicate_type", None): 1, ("lane", None): 1,
                   ("duplicate_type", "cross_medium"): 1, ("lane", "fast"): 1}


def test_divergence(spark):
    df = spark.createDataFrame([("kitten", "sitting"), (None, ""), ("a", None)], "a string, b string")
    got = [(r["edit_distance"], r["divergence"]) for r in review.divergence(df, "a", "b").collect()]
    assert got == [(3, round(3 / 7, 4)), (0, 0.0), (1, 1.0)]
