import math

import pytest
from pyspark.sql import functions as F

from vidguard import constants as K
from vidguard.operators import gold, quality, silver, split


def rows(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def lower_median(values):
    finite = sorted(v for v in values if v is not None and math.isfinite(v))
    return finite[(len(finite) - 1) // 2] if finite else None


def test_medians_by_snapshot(spark):
    cases = {
        "2025-01-01": [None, float("nan"), float("inf")],
        "2025-02-01": [7.0],
        "2025-03-01": [4.0, 1.0],
        "2025-04-01": [3.0, -2.5, 9.0, 1.0, float("nan")],
        "2025-05-01": [0.5] * 50 + [0.25] * 49,
        "2025-06-01": [float(i * 37 % 101) / 100 for i in range(1000)],
    }
    data = [(d, v) for d, vs in cases.items() for v in vs]
    df = spark.createDataFrame(data, "snapshot_date string, x double").repartition(5)
    got = {r["snapshot_date"]: r["x_median"]
           for r in gold.snapshot_medians([(df, ["x"])]).collect()}
    for date, values in cases.items():
        assert got.get(date) == lower_median(values)


def test_impute_without_any_finite_value(spark):
    df = spark.createDataFrame([("v1", "d", None), ("v2", "d", float("nan"))],
                               "video_id string, snapshot_date string, x double")
    medians = gold.snapshot_medians([(df, ["x"])])
    out = rows(gold.impute_median(df, ["x"], medians), "video_id")
    assert [(r["x"], r["x_was_missing"]) for r in out] == [(0.0, 1), (0.0, 1)]


def feeds(spark):
    label = spark.createDataFrame([
        ("v1", "2025-01-01", "s", "exact", "Hello, World", None, "!!!", " HARMFUL "),
        ("v2", "2025-01-01", "s", "exact", "a b", "c", None, None),
        ("v3", "2025-01-01", "s", "exact", None, "x", "y", "other"),
    ], "video_id string, snapshot_date string, seed_id string, variant_type string, "
       "title_text string, ocr_text string, asr_text string, label string")
    ocr = spark.createDataFrame([
        ("v1", "2025-01-01", "22.0", " Top", "0.88", "0.5", "True", None),
        ("v2", "2025-01-01", "bad", "corner", "NaN", "0.25", None, "0.75"),
    ], "video_id string, snapshot_date string, font_size string, text_location string, "
       "contrast_level string, text_density string, is_animated string, ocr_confidence string")
    asr = spark.createDataFrame([
        ("v1", "2025-01-01", "140", "0.5", "0.9", "True", "False", "maybe"),
    ], "video_id string, snapshot_date string, speech_pace string, speech_volume string, "
       "avg_confidence string, has_silence string, has_overlap string, is_distorted string")
    meta = spark.createDataFrame([
        ("v1", "2025-01-01", "u", "d", "a", " sg", "2025-01-05 13:45:00"),
        ("v2", "2025-01-01", "u", "d", "a", None, "never"),
    ], "video_id string, snapshot_date string, user_id string, device_id string, "
       "audio_id string, region string, uploaded_at string")
    raw = {"label": label, "ocr": ocr, "asr": asr, "metadata": meta}
    return {n: silver.clean_feed(n, df) for n, df in raw.items()}


def test_feature_store_rules(spark):
    tables = feeds(spark)
    out = {r["video_id"]: r for r in gold.feature_store(**tables).collect()}
    v1, v2, v3 = out["v1"], out["v2"], out["v3"]
    assert v1["font_size"] == 22.0 and v1["contrast_level"] == 0.8799999952316284
    assert v1["ocr_confidence"] == 0.75 and v1["ocr_confidence_was_missing"] == 1.0
    assert v2["font_size"] == 22.0 and v2["font_size_was_missing"] == 1.0
    assert v2["contrast_level"] == v1["contrast_level"]
    # a video that a feed lacks gets zeros, not medians, and no flag
    assert v3["font_size"] == 0.0 and v3["font_size_was_missing"] == 0.0
    assert v2["speech_pace"] == 0.0 and v2["speech_pace_was_missing"] == 0.0
    assert v1["loc_top"] == 1.0 and v2["loc_top"] == 0.0 and v1["reg_sg"] == 1.0
    assert v1["upload_hour"] == 13.0 and v1["upload_dayofweek"] == 1.0  # a Sunday
    assert v2["region"] == "unknown" and v3["region"] is None
    # punctuation is present text but cleans to nothing; NULL is missing
    assert v1["has_asr_text"] == 1.0 and v1["asr_text"] == "" and v1["has_ocr_text"] == 0.0
    assert v1["title_len"] == 2.0 and v3["title_len"] == 1.0 and v2["combined_len"] == 3.0
    assert v1["is_distorted"] == 0.0
    assert len(gold.feature_store(**tables).columns) == 46


def test_label_store(spark):
    out = {r["video_id"]: r["label"] for r in gold.label_store(feeds(spark)["label"]).collect()}
    assert out == {"v1": 1, "v2": 0, "v3": 0}


def test_dedupe_latest_and_order_free(spark):
    data = [("v1", "d", i, f"t{i}") for i in range(50)] + [("v2", "d", 1, "only")]
    df = spark.createDataFrame(
        data, "video_id string, snapshot_date string, ingest_seq int, title string")
    for parts in (1, 7):
        out = rows(gold.one_row_per_video(df.repartition(parts)), "video_id")
        assert [r["title"] for r in out] == ["t49", "only"]
    free = df.drop("ingest_seq")
    picks = {gold.one_row_per_video(free.repartition(n)).where("video_id = 'v1'").first()["title"]
             for n in (1, 3, 9)}
    assert len(picks) == 1


def test_readiness_checks_report_everything(spark):
    df = spark.createDataFrame(
        [("v1", 0, 1.0, "a"), ("v1", 2, float("nan"), None), ("v2", None, None, "b")],
        "video_id string, label int, x double, t string")
    checks = quality.readiness_checks(df, numeric=["x", "gone"], text=["t"])
    got = {(r["check"], r["column"]): r["violations"] for r in checks.collect()}
    assert got == {("not_empty", "*"): 0, ("label_domain", "label"): 2, ("finite", "x"): 2,
                   ("column_exists", "gone"): 1, ("text_present", "t"): 1,
                   ("unique_key", "video_id"): 1}
    with pytest.raises(quality.NotReady, match="unique_key"):
        quality.require_ready(checks)
    empty = quality.readiness_checks(df.limit(0), numeric=["x"], text=["t"])
    assert {r["check"] for r in empty.where("violations > 0").collect()} == {"not_empty"}


def brute_quota(counts):
    """Largest-remainder shares worked out in fractions."""
    from fractions import Fraction

    def share(pool, take):
        total = sum(pool.values())
        exact = {k: Fraction(n * take, total) for k, n in pool.items()}
        out = {k: v.numerator // v.denominator for k, v in exact.items()}
        left = take - sum(out.values())
        for k in sorted(pool, key=lambda k: (-(exact[k] - out[k]), k))[:left]:
            out[k] += 1
        return out

    n = sum(counts.values())
    held = math.ceil(0.2 * n)
    train = share(counts, n - held)
    rest = {k: counts[k] - train[k] for k in counts}
    val = share(rest, held - math.ceil(0.5 * held))
    return {k: (train[k], val[k]) for k in counts}


def test_split_quotas():
    for a in range(2, 60):
        for b in (2, 3, 10, 41):
            assert split.split_quotas({0: a, 1: b}) == brute_quota({0: a, 1: b})
    assert split.split_quotas({0: 200, 1: 200}) == {0: (160, 20), 1: (160, 20)}


def test_split_sizes_and_partition_independence(spark):
    df = spark.range(1003).select(
        F.concat(F.lit("v"), "id").alias("video_id"), (F.col("id") % 7 == 0).cast("int")
        .alias("label"))
    first = {r["video_id"]: r["split"] for r in split.stratified_split(df).collect()}
    again = {r["video_id"]: r["split"] for r in
             split.stratified_split(df.repartition(11).orderBy(F.rand())).collect()}
    assert first == again
    counts = {}
    for r in df.collect():
        key = (r["label"], first[r["video_id"]])
        counts[key] = counts.get(key, 0) + 1
    n1 = sum(1 for i in range(1003) if i % 7 == 0)
    for label, (train, val) in split.split_quotas({0: 1003 - n1, 1: n1}).items():
        assert counts[label, "train"] == train and counts[label, "val"] == val


def test_corpus_sample_too_short(spark):
    df = spark.createDataFrame([(1, " a  b ", "1"), (2, "   ", "0"), (3, "c", "non-suicide")],
                               "k int, text string, label string")
    got = {(r["k"], r["text"], r["class"]) for r in
           split.corpus_sample(df, "text", "label", "k", 1, 1).collect()}
    assert got == {(1, "a b", "harmful"), (3, "c", "clean")}
    with pytest.raises(split.TooFewSamples):
        split.corpus_sample(df, "text", "label", "k", 2, 1, strict=True)


def test_numeric_features_all_present(spark):
    store = gold.feature_store(**feeds(spark))
    assert set(K.numeric_features()) <= set(store.columns)
    assert all(t == "double" for c, t in store.dtypes if c in K.numeric_features())
