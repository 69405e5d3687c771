"""Lookups of wide rows: only rows of hot keys are copied."""

from pyspark.sql import functions as F

from vidguard.operators import review
from vidguard.operators.skew import wide_lookup_join


def test_wide_lookup_join_copies_only_hot_keys(spark):
    left = spark.range(600).select(
        F.col("id").cast("string").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id"))
        .alias("key"))
    right = spark.range(600).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("x"))
    right = right.unionByName(spark.createDataFrame([("hot", -1)], "key string, x long"))
    out = wide_lookup_join(left, right, "key", "row", hot_rows=100)
    assert sorted(map(tuple, out.collect()), key=str) == sorted((
        (str(i), "hot" if i % 3 == 0 else f"k{i}" if i % 3 == 1 else None,
         -1 if i % 3 == 0 else i if i % 3 == 1 else None) for i in range(600)), key=str)


def test_matched_texts_copy_no_text_of_a_rare_video(spark):
    texts = spark.createDataFrame([(f"v{i}", f"t{i}", "", None) for i in range(50)],
                                  "video_id string, title_text string, ocr_text string, asr_text string")
    rows = spark.range(50).select(
        F.concat(F.lit("v"), "id").alias("video_id"), F.lit(1).alias("rank"),
        F.concat(F.lit("v"), F.col("id") + 1).alias("seed_id"), F.lit("title").alias("q_medium"),
        F.lit("title").alias("c_medium"))
    shown = review.matched_texts(rows, texts)
    got = {r["video_id"]: (r["query_shown"], r["seed_shown"]) for r in shown.collect()}
    assert got["v3"] == ("t3", "t4") and got["v49"] == ("t49", review.NO_TEXT) and len(got) == 50
    plan = shown._jdf.queryExecution().optimizedPlan().toString()
    # copies are made for hot keys only: every list of copies depends on the key
    copies = [line for line in plan.splitlines() if "Generate explode(" in line]
    assert copies and all("_hot" in line for line in copies)
