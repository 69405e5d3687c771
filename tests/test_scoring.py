import json
import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vidguard import constants as K
from vidguard.functions import routing as R
from vidguard.functions import scoring as S
from vidguard.operators import pairs as P


def matched(spark, text, metadata, cross, feature):
    df = spark.createDataFrame(
        [(text, metadata, cross, feature)],
        "text_score double, metadata_score double, is_cross_medium boolean, feature_score double")
    return P.with_match_score(df).first()


def test_metadata_does_not_rescue(spark):
    r = matched(spark, 0.50, 1.0, False, 0.9)
    assert (r["duplicate_type"], r["metadata_score"], r["feature_score"], r["lane"]) == (None,) * 4
    assert r["match_confidence"] == 0.50
    assert r["match_reason"] == "text 0.5 below gate 0.55; no duplicate"


@pytest.mark.parametrize("text,cross,feature,kind,confidence,lane", [
    (0.75, False, 0.90, "same_asset", 0.90, "fast"),
    (0.75, False, 0.40, "re_authored", 0.90, "investigation"),
    (0.75, False, 0.80, "same_asset", 0.90, "fast"),
    (0.75, False, None, "re_authored", 0.90, "investigation"),
    (0.75, True, None, "cross_medium", 0.90, "investigation"),
    (0.60, True, None, "cross_medium", 0.75, "investigation"),
    (0.55, False, None, "re_authored", 0.70, "investigation"),
    (1.00, False, None, "re_authored", 1.00, "investigation"),
])
def test_types_lanes_and_capped_lift(spark, text, cross, feature, kind, confidence, lane):
    r = matched(spark, text, 1.0, cross, feature)
    assert (r["duplicate_type"], r["match_confidence"], r["lane"]) == (kind, confidence, lane)
    assert r["match_reason"] == f"text {text} + metadata lift 0.15 -> {kind}"


def test_confidence_without_metadata_or_text(spark):
    assert matched(spark, 0.75, None, True, None)["match_confidence"] == 0.75
    assert matched(spark, 0.5499, 1.0, True, None)["match_confidence"] == 0.5499
    r = matched(spark, None, 1.0, True, None)
    assert r["match_confidence"] == 0.0 and r["match_reason"].startswith("text None below gate")


OCR = ("struct<font_size:double,contrast_level:double,ocr_confidence:double,text_density:double,"
       "is_animated:boolean,text_location:string>")
ASR = ("struct<speech_pace:double,speech_volume:double,avg_confidence:double,has_silence:boolean,"
       "has_overlap:boolean,is_distorted:boolean>")


def ocr(spark, q, s, **kw):
    df = spark.createDataFrame([(q, s)], f"q_ocr {OCR}, s_ocr {OCR}")
    return P.with_ocr_similarity(df, **kw).first()["ocr_score"]


def test_ocr_similarity(spark):
    full = (20.0, 0.5, 0.9, 0.4, True, "top")
    assert ocr(spark, full, full) == 1.0
    assert ocr(spark, None, None) is None and ocr(spark, full, None) == 0.0
    # relative to the seed side, which is the second one
    assert ocr(spark, (10.0, *[None] * 5), (20.0, *[None] * 5)) == 0.5
    assert ocr(spark, (20.0, *[None] * 5), (10.0, *[None] * 5)) == 0.0
    assert ocr(spark, (0.25, *[None] * 5), (0.5, *[None] * 5)) == 0.75  # divisor at least 1
    assert ocr(spark, (None,) * 6, full) == 0.0
    nan = float("nan")
    assert ocr(spark, (nan, 0.5, None, None, None, None), full) == 1.0
    mixed = (20.0, 0.25, 0.9, 0.4, False, "left")
    assert ocr(spark, mixed, full) == round((1 + 0.75 + 1 + 1 + 0 + 0) / 6, 4)
    assert ocr(spark, mixed, full, with_location=False) == round((1 + 0.75 + 1 + 1 + 0) / 5, 4)


def test_asr_similarity(spark):
    df = spark.createDataFrame(
        [((100.0, 0.5, None, True, False, None), (200.0, 0.25, 0.9, True, True, False))],
        f"q_asr {ASR}, s_asr {ASR}")
    got = P.with_asr_similarity(df).first()["asr_score"]
    assert got == round((0.5 + 0.75 + 1 + 0) / 4, 4)


META = ("struct<user_id:string,device_id:string,audio_id:string,region:string,"
        "uploaded_at:timestamp>")


def meta(spark, q, s):
    df = spark.createDataFrame([(q, s)], f"q_meta {META}, s_meta {META}")
    return P.with_metadata_similarity(df).first()["metadata_score"]


def test_metadata_similarity(spark):
    t = datetime(2025, 1, 1, 12)
    same = ("u", "d", "a", "SG", t)
    assert meta(spark, same, same) == 1.0
    assert meta(spark, same, None) == 0.0
    assert meta(spark, same, ("u", "x", "a", None, None)) == round(0.7 * 2 / 3, 4)
    later = ("u", "d", "a", "SG", t + timedelta(hours=24))
    assert meta(spark, same, later) == round(0.7 + 0.3 * round(math.exp(-1), 4), 4)
    assert meta(spark, (None,) * 5, same) == 0.0


def test_upload_time(spark):
    df = spark.createDataFrame([("2025-01-01 10:00:00",), ("2025-01-01",), (None,)], "t string")
    got = [r["v"] for r in df.select(S.upload_time(F.col("t")).alias("v")).collect()]
    assert got[0] is not None and got[1:] == [None, None]


def composite(spark, *scores):
    df = spark.createDataFrame(
        [scores], "text_score double, ocr_score double, asr_score double, metadata_score double")
    return P.with_composite(df).first()


def test_composite(spark):
    r = composite(spark, 0.95, 0.5, 0.5, 0.8)
    assert r["final_score"] == round(0.45 * 0.95 + 0.2 * 0.5 + 0.2 * 0.5 + 0.15 * 0.8, 4)
    assert r["reason"] == "high text similarity; metadata match"
    r = composite(spark, 0.5, None, None, 0.1)
    assert r["final_score"] == round((0.45 * 0.5 + 0.15 * 0.1) / 0.6, 4)
    assert r["reason"] == "missing: ocr, asr"
    assert r["weights_used"]["text"] == pytest.approx(0.75) and r["weights_used"]["ocr"] is None
    r = composite(spark, None, None, None, None)
    assert r["final_score"] == 0.0 and r["reason"] == "no signals available"
    assert composite(spark, 0.5, 0.5, 0.5, 0.5)["reason"] == "composite"


def routed(spark, confidence, verifier):
    df = spark.createDataFrame([(confidence, verifier)], "c double, v double")
    return df.select(
        R.decision(F.col("c"), F.col("v")).alias("decision"),
        R.verifier_priority(F.col("c"), F.col("v")).alias("priority"),
        R.verifier_score(F.col("c"), F.col("v")).alias("score")).first()


@pytest.mark.parametrize("confidence,verifier,want", [
    (0.20, None, (K.ALLOW, None, None)), (0.2999, 0.9, (K.ALLOW, None, None)),
    (0.30, None, (K.REVIEW, "normal", None)), (0.5999, 0.9, (K.REVIEW, "normal", None)),
    (0.60, None, (K.REVIEW, "normal", None)), (0.90, 0.95, (K.REVIEW, "urgent", 0.95)),
    (0.90, 0.70, (K.REVIEW, "urgent", 0.70)), (0.90, 0.6999, (K.REVIEW, "normal", 0.6999)),
    (0.90, 0.50, (K.REVIEW, "normal", 0.50)), (0.90, 0.4999, (K.ALLOW, None, 0.4999)),
])
def test_decisions_never_remove(spark, confidence, verifier, want):
    assert tuple(routed(spark, confidence, verifier)) == want


@pytest.mark.parametrize("kind,want", [
    ("cross_medium", "urgent"), ("re_authored", "urgent"), ("same_asset", "normal"), (None, "normal")])
def test_priority_by_type_when_verifier_gives_none(spark, kind, want):
    df = spark.createDataFrame([(kind, None)], "k string, p string")
    assert df.select(R.final_priority(F.col("p"), F.col("k")).alias("v")).first()["v"] == want


@pytest.mark.parametrize("text,want", [
    ('{"harmful_probability": 0.8, "reasoning": "x"}', (0.8, "x")),
    ('{"harmful_probability": 1.7}', (1.0, "")), ('{"harmful_probability": -2}', (0.0, "")),
    ('{"harmful_probability": "0.3"}', (0.3, "")), ("{}", (0.5, "")),
    ('{"harmful_probability": "high"}', (None, None)), ('{"harmful_probability": null}', (None, None)),
    ("not json", (None, None)), ("[1]", (None, None)), (None, (None, None)),
])
def test_verifier_reply(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(R.verifier_reply(F.col("t")).alias("r")).first()["r"]
    assert (r["score"], r["reasoning"]) == want


def test_prompt(spark):
    df = spark.createDataFrame([("query {0}", None, 0.875)], "q string, s string, c double")
    text = df.select(R.verifier_prompt(F.col("q"), F.col("s"), F.col("c")).alias("p")).first()["p"]
    assert "similarity score of 0.88." in text and '"query {0}"' in text
    assert 'seed text:\n""' in text and '{"harmful_probability": <float 0.0-1.0>' in text
    json.dumps(text)
