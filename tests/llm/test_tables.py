"""Mixing, sharding, neighbours, scorers, and the pipeline."""

import math
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vidguard.llm import ann, mixing, quality, sharding, toxicity
from vidguard.llm.folds import held_out


def filled(sizes, share=1.5, weights=(3, 1, 2), most=2.0):
    """Shares by weight; the excess over a limit is shared again until none is above."""
    target, left, total = {}, dict(enumerate(sizes)), share * sum(sizes)
    while left:
        level = (total - sum(target.values())) / sum(weights[i % 3] for i in left)
        over = [i for i, s in left.items() if level * weights[i % 3] > most * s]
        for i in over or list(left):
            size = left.pop(i)
            target[i] = most * size if over else level * weights[i % 3]
    return [target[i] for i in range(len(sizes))]


@pytest.mark.parametrize("sizes", [[100, 100, 100], [5, 1000, 3, 0, 400, 90, 7], [10], [0, 0]])
def test_targets_fill_to_the_limits(spark, sizes):
    rows = [(f"s{i:02d}", n) for i, n in enumerate(sizes)]
    df = mixing.targets(spark.createDataFrame(rows, "source string, source_size long"))
    got = [r["target"] for r in df.orderBy("source").collect()]
    assert got == pytest.approx(filled(sizes))


def test_permutations_and_draws():
    for n in (1, 2, 3, 17, 1000):
        for key in (0, 99):
            assert sorted(mixing.permute(np.arange(n), n, key)) == list(range(n))
    sizes, want = [50_000, 20_000, 900, 0], [60_000.0, 40_000.0, 1800.0, 0.0]
    rows = mixing.draw_slots(sizes, want)
    got = Counter()
    for s, _, first, n in rows:
        assert first == got[s]
        got[s] += n
    assert got[2] * 900 / 8 == pytest.approx(1800) and got[3] == 0
    assert got[0] == round(60_000 / (50_000 / 391)) and len({r[1] for r in rows}) == mixing.SHARDS
    assert rows == mixing.draw_slots(sizes, want)


def test_words_taken(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 400)), None if i % 9 == 0 else f"s{i % 4}")
            for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_documents(df.repartition(5)).collect()
    size = defaultdict(int)
    for i, t, s in rows:
        size[s] += len(t.split())
    want = dict(zip(["s0", "s1", "s2", "s3", None], filled([size[s] for s in (
        "s0", "s1", "s2", "s3", None)])))
    taken = defaultdict(int)
    for r in out:
        source = rows[r["doc_id"]][2]
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and r["source_size"] == size[source]
        assert r["target"] == pytest.approx(want[source]) and r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] + 128 for s in want)
    again = mixing.mix_documents(df.repartition(3)).collect()
    assert {(r["doc_id"], r["taken"]) for r in again} == {(r["doc_id"], r["taken"]) for r in out}


def test_mixed_documents_follow_the_slots(spark):
    """Sources of a few long documents, repeated rows, and rows without words."""
    rows = [(i, " ".join(["w"] * (3000 + 1700 * (i * 7 % 11))), f"s{i % 3}") for i in range(24)]
    rows += [(100, "same row", "s3")] * 9 + [(200, " ", "s0"), (200, " ", "s0"), (201, None, "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    taken, largest, got, empty, single = Counter(), Counter(), Counter(), Counter(), Counter()
    for r in mixing.mix_documents(df.withColumn("doc_id", F.col("doc_id"))).collect():
        source = next(s for d, _, s in rows if d == r["doc_id"])
        taken[source] += r["taken"]
        largest[source] = max(largest[source], r["size"])
    for r in mixing.mixed(df).collect():
        size = len((r["text"] or "").split())
        got[r["source"]] += size
        single[r["doc_id"]] += 1
        empty[r["doc_id"]] += not size
    assert all(abs(got[s] - taken[s]) <= largest[s] for s in taken)
    assert empty[200] == 2 and empty[201] == 1
    assert all(n <= 2 for d, n in single.items() if d < 100)


def test_mixing_odd_rows(odd_docs, no_docs):
    out = mixing.mix_documents(odd_docs).collect()
    assert len(out) == 13 and all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    assert {r["size"] for r in out if r["doc_id"] in (3, 4, 9)} == {0}
    assert mixing.mix_documents(no_docs).count() == 0
    assert mixing.mixed(odd_docs).columns == odd_docs.columns
    assert mixing.mixed(no_docs).count() == 0


def test_shards_move_few_and_number_without_gaps(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    out = sharding.shard_documents(rows.repartition(7)).collect()
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8) and r["text_crc32"] == crc32(b"x")
    assert set(by) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert all(abs(len(s) - 375) < 90 for s in by.values())
    assert abs(sum(r["grown_shard"] == 8 for r in out) - 3000 / 9) < 90
    heavy = sharding.shard_rows(rows, [1.0, 3.0, 0.0]).groupBy("shard").count().collect()
    counts = {r["shard"]: r["count"] for r in heavy}
    assert set(counts) == {0, 1} and abs(counts[1] / 3000 - 0.75) < 0.04


def test_sharding_odd_rows(spark, odd_docs, no_docs):
    out = sharding.shard_rows(odd_docs, [1.0] * 4, grown=1.0).collect()
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert len(out) == 13 and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({r["shard"] for r in out if r["doc_id"] == 1}) == 1
    hot = spark.range(4000).select((F.col("id") * 0 + 5).alias("doc_id"), F.lit("t").alias("text"))
    slots = [r["slot"] for r in sharding.shard_documents(hot).collect()]
    assert sorted(slots) == list(range(4000))
    assert sharding.shard_documents(no_docs).count() == 0
    plan = sharding.shard_documents(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def exact(rows, k):
    """Nearest by brute force over (id, vector) with usable vectors."""
    ok = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for i, q in ok:
        near = sorted((-float(sum(a * b for a, b in zip(q, v))), j) for j, v in ok if j != i)[:k]
        out[i] = [j for _, j in near]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8) * rng.uniform(0.2, 3)]) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # a group of copies
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    want = exact(rows, 20)
    found = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = []
    for q in (i for i, _ in rows if i % 20 == 0):
        got = sorted(found[q])
        assert [g[0] for g in got] == list(range(1, 21)) and q not in [g[1] for g in got]
        assert [(-g[2], g[1]) for g in got] == sorted((-g[2], g[1]) for g in got)
        hits.append(len({g[1] for g in got} & set(want[q])) / 20)
    assert np.mean(hits) >= 0.9
    # the largest products of a copy are its copies, smallest ids first, when nothing is longer
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]),
            (5, [nan, 1.0]), (6, [None, 1.0]), (7, [inf, 1.0]), (None, [1.0, 1.0]), (8, [1.0]),
            (9, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    out = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(
        df, F.lit(True), k=3).collect())
    assert out == [(1, 1, 2, 0.5), (1, 2, 9, 0.5), (2, 1, 1, 0.5), (2, 2, 9, 0.5), (9, 1, 1, 0.5),
                   (9, 2, 2, 0.5)]


def corpus(spark, n=900):
    rng = np.random.default_rng(4)
    words = [f"{a}{b}" for a in "ba co di fu ge ha".split() for b in "ler nam sti por".split()]
    docs, labels = [], []
    for i in range(n):
        text = [str(w) for w in rng.choice(words, 60)]
        toxic, bad = i % 6 == 0, i % 7 == 0
        if toxic:
            for k in rng.integers(0, 60, 4):
                text[k] = str(rng.choice(["you idiot", "moron", "vexzor", "scum"]))
        if bad:
            text = [w + "###" for w in text]
        docs.append((i, " ".join(text), "en", f"s{i % 3}"))
        labels.append((i, int(not bad), int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = corpus(spark)
    return docs, labels, toxicity.fit_toxicity(docs, labels)


def test_scorers_on_held_out_rows(learned):
    docs, labels, model = learned
    for scored, target in (
            (toxicity.score_toxicity(docs, model), "toxic"),
            (quality.score_quality(docs, quality.fit_quality(docs, labels)), "quality")):
        rows = scored.join(labels, "doc_id").where("held_out").collect()
        assert all(crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows) and len(rows) > 100
        assert np.mean([r["predicted"] == r[target] for r in rows]) >= 0.97
        assert all(0 <= r["score"] <= 1 for r in rows)
    assert "vexzor" in model.lexicon.weights


def test_scorers_odd_rows(spark, learned, odd_docs, no_docs, labels):
    docs, train, model = learned
    for scored in (toxicity.score_toxicity(odd_docs, model),
                   quality.score_quality(odd_docs, quality.fit_quality(docs, train))):
        rows = scored.collect()
        assert len(rows) == 13 and all(r["score"] is not None for r in rows)
        assert all(r["held_out"] for r in rows if r["doc_id"] is None)
    for d in (odd_docs, no_docs):  # few or no labelled texts
        assert toxicity.score_toxicity(d, toxicity.fit_toxicity(d, labels)).count() == d.count()
        assert quality.score_quality(d, quality.fit_quality(d, labels)).count() == d.count()
    none = toxicity.fit_toxicity(docs, labels.limit(0))
    assert toxicity.without_toxic(docs, none).count() == docs.count()
    kept = toxicity.without_toxic(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == 13


def test_toxicity_features():
    lexicon = toxicity.Lexicon({"vexzor": 4.0})
    f = dict(zip(toxicity.FEATURES, lexicon.features("YOU are a v3xz0r and an 1diot!! soooo bad")))
    assert f["near_second"] > 0 and f["hidden"] == pytest.approx(2 / 9)
    assert f["stretched"] > 0 and f["shouted"] > 0 and f["exclaims"] > 0
    assert lexicon.features(None) == lexicon.features(" ") == [0.0] * len(toxicity.FEATURES)
    long = "idiot you " * 50_000
    assert math.isclose(lexicon.features(long)[0], 0.5)


def test_fold_of_labels(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_pipeline_stages(spark, tmp_path, odd_docs, no_docs, learned):
    docs, labels, _ = learned
    near = docs.where("doc_id % 10 = 1").withColumn("doc_id", F.col("doc_id") + 5000)
    bench = docs.where("doc_id in (2, 3)").select(F.col("doc_id").alias("item_id"), "text")
    for name, table in (("documents", docs.unionByName(near)), ("labels", labels),
                        ("benchmark", bench)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    now, counts = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.written(stage(spark, now, str(tmp_path)))
        counts[name] = {r["doc_id"] for r in now.select("doc_id").collect()}
        assert now.columns[:4] == docs.columns
    assert len(counts) == 5 and max(counts["near_duplicates"]) < 5000
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    assert len(counts["toxicity"] & toxic) <= 0.05 * len(toxic)
    assert counts["near_duplicates"] - counts["decontamination"] == {2, 3}
    assert now.columns == [*docs.columns, "shard", "slot"]
    for table in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, str(tmp_path)).columns == table.columns
        assert corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path)).count() == table.count()
