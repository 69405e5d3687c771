"""Newest rows of a log by its zone map, and the first rows of each class from one scan."""

import glob
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from vidguard.operators import drift, split
from vidguard.sources import journal

SCHEMA = "id string, created_at timestamp, run_id string"


def log(spark, runs):
    start = datetime(2025, 1, 1)
    rows = [(f"{run}-{i}", start + timedelta(hours=h), run) for run, hours in runs.items()
            for i, h in enumerate(hours)]
    return spark.createDataFrame(rows, SCHEMA)


def newest(spark, path, n):
    schema = spark.createDataFrame([], SCHEMA).schema
    return [r.id for r in drift.recent(journal.read_newest(spark, path, n, schema), n).collect()]


def test_equal_to_the_full_scan(spark, tmp_path):
    """Overlapping runs, equal times across runs, a run name with odd characters."""
    runs = {"a": [0, 1, 2], "b": [2, 3, 3], "c/d: é": [3, 4], "e": [4, 4, 4], "f": [1, 9]}
    df, path = log(spark, runs), str(tmp_path / "log")
    for run in runs:
        journal.append_runs(df.where(F.col("run_id") == run), path)
    for n in (1, 2, 3, 5, 8, 13, 50):
        assert newest(spark, path, n) == [r.id for r in drift.recent(df, n).collect()]


def test_old_runs_are_not_read(spark, tmp_path):
    df, path = log(spark, {f"r{i}": [10 * i, 10 * i + 1] for i in range(6)}), str(tmp_path / "log")
    journal.append_runs(df, path)
    want = newest(spark, path, 3)
    for run in ("r0", "r1", "r2", "r3"):
        for f in glob.glob(f"{path}/run_id={run}/*.parquet"):
            open(f, "wb").write(b"not parquet")
        for f in glob.glob(f"{path}/run_id={run}/.*.crc"):
            open(f, "wb").write(b"")
    assert newest(spark, path, 3) == want == ["r5-1", "r5-0", "r4-1"]


def test_runs_without_a_note_are_read(spark, tmp_path):
    """A job ended between rows and note; a log from before there were notes; a replaced run."""
    df, path = log(spark, {"a": [0, 1], "b": [5, 6], "c": [3]}), str(tmp_path / "log")
    journal.append_runs(df.where("run_id <> 'b'"), path)
    df.where("run_id = 'b'").write.partitionBy("run_id").mode("append").parquet(path)
    assert newest(spark, path, 1) == ["b-1"] and newest(spark, path, 3) == ["b-1", "b-0", "c-0"]
    old = str(tmp_path / "old")
    df.write.partitionBy("run_id").parquet(old)
    assert newest(spark, old, 2) == ["b-1", "b-0"]
    journal.append_runs(log(spark, {"a": [40]}), path)
    assert newest(spark, path, 2) == ["a-0", "b-1"]


def test_first_of_each_class_in_one_scan(spark, tmp_path):
    df = spark.range(5000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 50 == 0, "rare").when(
            F.col("id") % 7 == 0, F.lit(None)).otherwise("hot").alias("c"))
    df.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    sizes = {"hot": 9, "rare": 4, "none": 3}
    out = split.first_per_class(table, sizes, "c", "k", seed=5)
    plan = out._jdf.queryExecution().executedPlan().toString()  # before it runs
    want = []
    for name, n in sizes.items():
        want += [(r.k, r.c) for r in df.where(F.col("c") == name).orderBy(
            split.order_hash(F.col("k"), 5), "k").limit(n).collect()]
    assert sorted((r.k, r.c) for r in out.collect()) == sorted(want) and len(want) == 13
    assert plan.count("FileScan") == 1 and plan.count("WindowGroupLimit") == 2
