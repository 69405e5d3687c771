"""Ids beyond 2^53 beside a null id in one batch come back as they were, from every operator."""

import pytest
from pyspark.sql import functions as F

from vidguard.llm import (chat, decontaminate, near_duplicates, periodic_runs, pii, quality, sharding,
                          token_counts, toxicity)

WIDE = [2 ** 53 + 1, -2 ** 63, 2 ** 63 - 1]
TEXT = "one two three four five six seven"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, TEXT) for i in WIDE] + [(None, TEXT), (2 ** 53 + 3, "other words of a text apart")]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def ids(df, name="doc_id"):
    return sorted((r[0] for r in df.select(name).collect() if r[0] is not None))


WANT = sorted([*WIDE, 2 ** 53 + 3])


def test_operators(spark, docs, labels):
    import public_tokenizers

    items = spark.createDataFrame([(1, TEXT), (2, "no such item")], "item_id long, text string")
    tokens = token_counts.token_counts(docs, str(public_tokenizers.path("word_bpe_49k.json")))
    assert ids(tokens) == ids(decontaminate.contamination(docs, items)) == WANT
    assert ids(pii.personal_data_digest(docs)) == ids(sharding.shard_documents(docs)) == WANT
    assert ids(periodic_runs.periodic_runs(docs)) == WANT
    model = toxicity.fit_toxicity(docs, labels)
    for scored in (toxicity.score_toxicity(docs, model),
                   quality.score_quality(docs, quality.fit_quality(docs, labels))):
        assert ids(scored) == WANT
        want = docs.where("doc_id is not null").select(
            "doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("h"))
        assert sorted(map(tuple, scored.where("doc_id is not null").select(
            "doc_id", "held_out").collect())) == sorted(map(tuple, want.collect()))


def test_trained_toxicity_keeps_ids(spark, docs):
    fit = spark.createDataFrame([(i, f"you {'fool' if i % 2 else 'friend'} number {i}", i % 2, i % 2)
                                 for i in range(400)], "doc_id long, text string, toxic int, quality int")
    model = toxicity.fit_toxicity(fit, fit)
    assert model.trees is not None and ids(toxicity.score_toxicity(docs, model)) == WANT
    assert ids(toxicity.without_toxic(docs, model)) == WANT


def test_near_duplicates(docs):
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicate_classes(docs).collect()}
    assert got == {**{i: min(WIDE) for i in WIDE}, 2 ** 53 + 3: 2 ** 53 + 3, None: None}


def test_conversations(spark):
    rows = spark.createDataFrame([(i, 0, "user", "hi") for i in [*WANT, None]],
                                 "conv_id long, turn long, role string, text string").coalesce(1)
    formatted = chat.format_conversations(rows).coalesce(1)
    assert ids(formatted, "conv_id") == ids(chat.digests(formatted), "conv_id") == WANT
    records = spark.createDataFrame(
        [(i, '{"prompt": "a", "response": "b"}') for i in [*WANT, None]],
        "conv_id long, record string").coalesce(1)
    assert ids(chat.from_json_records(records), "conv_id") == WANT
