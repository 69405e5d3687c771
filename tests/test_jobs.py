import csv
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vidguard import schemas
from vidguard.operators import infer, review
from vidguard.plans import inference, medallion, monitoring, training
from vidguard.sources import feeds, journal, shared, store
from vidguard.streaming import ingest


def write_csv(path, schema, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(schema.names)
        w.writerows(rows)


def make_feeds(folder, n=120):
    harmful = ["threat of harm\nwith, commas", 'hate "quoted" abuse', "dangerous weapon instructions"]
    clean = ["cooking recipe video", "travel plans, weekend", "study tips"]
    label, ocr, asr, meta = [], [], [], []
    for i in range(n):
        bad = i % 2 == 0
        text = (harmful if bad else clean)[i % 3]
        key = [f"v{i:03d}", f"2025-0{i % 3 + 1}-01"]
        label.append([*key, f"s{i % 3}", "exact", f"{text} part {i % 5}", "" if i % 8 == 0 else text,
                      "" if i % 7 == 0 else text.upper(), "harmful" if bad else "clean"])
        ocr.append([*key, "" if i % 9 == 0 else f"{20 + i % 6}.0", "top", 0.75, 0.5, True,
                    "" if i % 11 == 0 else 0.9])
        asr.append([*key, 140 + i % 10, 0.6, 0.8, True, False, False])
        meta.append([*key, f"user_{i % 4}", "device_1", f"audio_{i % 3}", "SG",
                     f"2025-01-0{i % 9 + 1} 10:00:00"])
    paths = {}
    for name, rows in (("label", label), ("ocr", ocr), ("asr", asr), ("metadata", meta)):
        paths[name] = f"{folder}/{name}.csv"
        write_csv(paths[name], schemas.RAW_FEEDS[name], rows)
    return paths


def test_whole_chain(spark, tmp_path):
    root = str(tmp_path / "mart")
    paths = make_feeds(tmp_path)
    raw = feeds.read_feed(spark, "label", paths["label"])
    assert raw.count() == 120 and raw.where("ocr_text = ''").count() == 0
    assert raw.where("title_text like '%\n%'").count() == 20
    assert [r[0] for r in feeds.snapshot_dates(raw).collect()] == [
        "2025-01-01", "2025-02-01", "2025-03-01"]
    medallion.backfill(spark, paths, root)
    silver = store.read_snapshots(spark, f"{root}/silver/label")
    assert silver.where("title_text like '%with commas%'").count() == 20
    medallion.land(spark, paths, root)  # a rerun replaces, it does not add
    assert store.read_bronze(spark, "label", f"{root}/bronze/label").count() == 120
    one = store.read_snapshots(spark, f"{root}/gold/feature_store").where(
        "snapshot_date = '2025-02-01'")
    assert one.count() == 40 and len(one.inputFiles()) > 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    splits = store.read_split(spark, f"{root}/gold/splits")
    sizes = {r["split"]: r["count"] for r in splits.groupBy("split").count().collect()}
    assert sizes == {"train": 96, "val": 12, "test": 12}
    manifest = spark.read.json(f"{root}/reports/feature_manifest").first()
    assert manifest["n_numeric_features"] == 35
    assert spark.read.json(f"{root}/reports/data_quality").where("metric = 'total_videos'") \
        .first()["value"] == 120

    _, table = training.train_and_evaluate(spark, root)
    val = table.where("split = 'val'").first()
    assert val["recall"] == 1.0 and training.promoted(table)

    asked = []

    def verifier(prompt):
        asked.append(prompt)
        return F.when(prompt.isNotNull(), F.lit('{"harmful_probability": 0.9}'))

    run_at = datetime(2025, 7, 1)
    records = inference.infer_split(
        spark, root, "test", run_id="r1", run_at=run_at, verifier=verifier)
    rows = records.collect()
    assert len(rows) == 12 and len(asked) == 1
    for r in rows:
        if r["layer1_label"] == "harmful":
            assert (r["decision"], r["priority"], r["llm_score"]) == ("HUMAN REVIEW", "urgent", 0.9)
            assert len(json.loads(r["candidate_matches"])) == r["n_candidates"] > 0
        else:
            assert r["decision"] == "ALLOW"
    log = journal.read_predictions(spark, f"{root}/log/predictions")
    assert log.count() == 12 and log.columns == schemas.PREDICTIONS.names
    journal.append_verdicts(spark.createDataFrame(
        [(rows[0]["video_id"], "REMOVE", "me", datetime(2100, 1, 1)),
         (rows[1]["video_id"], "SHRUG", "me", datetime(2100, 1, 1))],
        "video_id string, verdict string, reviewed_by string, reviewed_at timestamp"),
        f"{root}/log/verdicts")
    verdicts = journal.read_verdicts(spark, f"{root}/log/verdicts")
    assert verdicts.count() == 2  # an unknown one is kept and reported
    assert [tuple(r) for r in journal.unknown_verdicts(verdicts).collect()] == [("SHRUG", 1)]

    def reviewed():
        view = review.with_verdicts(
            journal.read_predictions(spark, f"{root}/log/predictions"), verdicts)
        return sorted((r["video_id"], r["reviewer_verdict"], r["id"], r["created_at"])
                      for r in view.collect())

    before = reviewed()
    assert [v for _, v, _, _ in before if v] and len(before) == 12
    journal.append_predictions(records, f"{root}/log/predictions", "r1", run_at)  # same run again
    assert reviewed() == before
    report = {(r["section"], r["item"]): r["value"]
              for r in monitoring.monitoring_report(spark, root).collect()}
    assert report["current", "n"] == 6 and report["reference", "n"] == 6
    assert report["current", "override_rate"] + report["reference", "override_rate"] == \
        pytest.approx(2 / 6, abs=1e-4)  # the unknown verdict disagrees too
    seeds = infer.seed_corpus(splits)
    assert seeds.where("split <> 'train' or label <> 1").count() == 0 and seeds.count() == 48


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    schema = schemas.RAW_FEEDS["asr"]

    def drop(name, ids):
        write_csv(source / name, schema,
                  [[i, "2025-01-01", "140", "0.5", "", "True", "False", "bad"] for i in ids])

    def run():
        ingest.ingest_new_files(
            spark, "asr", str(source), target, str(tmp_path / "ck")).awaitTermination()
        return sorted(r["video_id"] for r in spark.read.parquet(target).collect())

    drop("a.csv", ["v1", "v2"])
    assert run() == ["v1", "v2"]
    drop("b.csv", ["v3"])
    assert run() == ["v1", "v2", "v3"]
    row = spark.read.parquet(target).where("video_id = 'v3'").first()
    assert (row["speech_pace"], row["avg_confidence"], row["is_distorted"]) == (140, None, None)


def test_seed_corpus_file(spark, tmp_path):
    path = tmp_path / "seeds.json"
    path.write_text(json.dumps({"dataset": "d", "harmful": ["a", "b", "c"], "clean": ["x", "y"]},
                               indent=2))
    rows = feeds.read_seed_corpus(spark, str(path), 2, 5).collect()
    assert [(r["class"], r["position"], r["text"]) for r in rows] == [
        ("harmful", 0, "a"), ("harmful", 1, "b"), ("clean", 0, "x"), ("clean", 1, "y")]


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared.checkpoint_dir(spark) == folder
    out = shared.written(spark.range(5).withColumn("x", F.col("id") * 2))
    assert out.count() == 5 and all(folder in f for f in out.inputFiles())
