"""Incremental snapshots: one rebuilt per change, whole or not at all, equal to a full build."""

import pytest
from pyspark.sql import functions as F

from vidguard.catalog import tables as T
from vidguard.operators import gold
from vidguard.plans import incremental
from vidguard.sources.shared import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feeds(spark):
    return {n: written(raw(spark, SF)) for n, raw in T.RAW.items()}


def rows(df):
    return sorted(map(repr, (r.asDict() for r in df.collect())))


def whole(feeds):
    from vidguard.operators import silver

    clean = {n: silver.clean_feed(n, df) for n, df in feeds.items()}
    return rows(gold.feature_store(**clean)), rows(gold.label_store(clean["label"]))


def gold_of(state):
    return rows(state.read(incremental.FEATURES)), rows(state.read(incremental.LABELS))


def one_row_other(feed, date, column):
    """The feed with one row of one snapshot changed."""
    first = feed.where(F.col("snapshot_date") == date).agg(F.min("video_id")).first()[0]
    hit = (F.col("video_id") == first) & (F.col("snapshot_date") == date)
    return feed.withColumn(column, F.when(hit, F.lit("77")).otherwise(F.col(column)))


def test_only_changed_snapshots_are_rebuilt(spark, feeds, tmp_path):
    state = incremental.SnapshotState(spark, str(tmp_path))
    dates = sorted(r[0] for r in feeds["label"].select("snapshot_date").distinct().collect())
    assert state.update(feeds) == dates and gold_of(state) == whole(feeds)
    shuffled = {n: df.repartition(7) for n, df in feeds.items()}
    assert state.update(shuffled) == [] and state.states.numbers() == [1]
    changed = {**feeds, "asr": one_row_other(feeds["asr"], dates[2], "speech_pace")}
    assert state.update(changed) == [dates[2]]
    assert gold_of(state) == whole(changed) != whole(feeds)
    new = state.states.latest()[1]["tables"]
    old = state.states.manifest(1)["tables"]
    moved = {(t, d) for t in new for d in new[t] if new[t][d] != old[t][d]}
    assert moved == {(t, dates[2]) for t in ("silver/asr", "gold/feature_store", "gold/label_store")}
    # a reader that named its state still sees it
    assert rows(state.read(incremental.FEATURES, generation=1)) == whole(feeds)[0]
    one = state.read(incremental.FEATURES, [dates[0]])
    assert {r.snapshot_date for r in one.collect()} == {dates[0]}
    # repeated rows leave their mark; a snapshot that goes leaves the state
    twice = {**changed, "ocr": changed["ocr"].unionByName(
        changed["ocr"].where(F.col("snapshot_date") == dates[1]))}
    assert state.update(twice) == [dates[1]]
    less = {n: df.where(F.col("snapshot_date") != dates[0]) for n, df in twice.items()}
    assert state.update(less) == [dates[0]] and gold_of(state) == whole(less)
    state.prune(keep=1)
    assert gold_of(state) == whole(less)


def test_a_killed_run_leaves_the_old_state(spark, feeds, tmp_path, monkeypatch):
    state = incremental.SnapshotState(spark, str(tmp_path))
    state.update(feeds)
    before = gold_of(state)
    dates = sorted(state.states.latest()[1]["tables"][incremental.FEATURES])
    changed = {**feeds, "ocr": one_row_other(feeds["ocr"], dates[0], "font_size")}
    plain = incremental.SnapshotState._write

    def dies(self, df, table, *rest):
        if table == incremental.LABELS:
            raise RuntimeError("lost")
        plain(self, df, table, *rest)

    monkeypatch.setattr(incremental.SnapshotState, "_write", dies)
    with pytest.raises(RuntimeError):
        state.update(changed)
    assert gold_of(state) == before and state.states.numbers() == [1]
    monkeypatch.setattr(incremental.SnapshotState, "_write", plain)
    assert state.update(changed) == [dates[0]] and gold_of(state) == whole(changed)


def test_a_lost_race_starts_from_the_winner(spark, feeds, tmp_path, monkeypatch):
    state, other = (incremental.SnapshotState(spark, str(tmp_path)) for _ in range(2))
    plain, once = incremental.Generations.publish, [True]

    def publish(self, number, manifest):
        if self is state.states and once:
            once.pop()
            other.update(feeds)
        return plain(self, number, manifest)

    monkeypatch.setattr(incremental.Generations, "publish", publish)
    assert state.update(feeds) == []  # the other run did it all
    assert state.states.numbers() == [1] and gold_of(state) == whole(feeds)


def test_texts_are_shuffled_once_and_only_where_keys_repeat(spark, tmp_path, monkeypatch):
    """Silver texts go through the join alone; the write sorts nothing; rows are those of a whole compare."""
    from vidguard.operators import silver, skew

    raw = spark.createDataFrame(
        [(f"v{i % 40}", "2025-01-01" if i % 3 else None, "s", "exact", f"Title {i}", f"ocr {i % 7}",
          None if i % 4 else f"asr {i}", "harmful" if i % 2 else "clean") for i in range(60)]
        + [(None, "2025-01-01", "s", "exact", t, "o", "a", "clean") for t in ("b", "c", "c")],
        "video_id string, snapshot_date string, seed_id string, variant_type string, title_text string, "
        "ocr_text string, asr_text string, label string")
    clean = written(silver.clean_feed("label", raw))
    assert rows(gold.one_row_per_written_video(clean)) == rows(gold.one_row_per_video(clean))
    assert rows(skew.latest_of_few(clean, gold.GRAIN, most=1)) == rows(
        skew.latest_per_key(clean, gold.GRAIN))
    assert rows(gold.with_combined_text(clean.drop("combined_text")).drop("combined_len")) == rows(
        clean.select(*[c for c in clean.columns if c != "combined_text"], "combined_text"))
    feeds = {n: raw(spark, SF) for n, raw in T.RAW.items()}
    seen, plain = {}, incremental.SnapshotState._write

    def noted(self, df, table, *rest):
        seen[table] = df._jdf.queryExecution().executedPlan().toString()
        plain(self, df, table, *rest)

    monkeypatch.setattr(incremental.SnapshotState, "_write", noted)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")  # as for tables of size
    try:
        incremental.SnapshotState(spark, str(tmp_path)).update(feeds)
    finally:
        spark.conf.set(name, before)
    features = seen[incremental.FEATURES]
    assert "title_text" in features and "combined_text#" in features
    assert not [x for x in features.splitlines() if "Scan parquet" in x and "combined_text" in x]
    assert "SortAggregate" not in features
    assert features.count("hashpartitioning(video_id") == 4
    assert "title_text" not in seen[incremental.LABELS]
