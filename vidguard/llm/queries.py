"""Registered queries of the training-data operators: name -> (Spark query, DuckDB SQL or None)."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, chat, decontaminate, hard_negatives, mixing, near_duplicates, periodic_runs,
               pii, quality, sharding, token_counts, toxicity, warc)
from .tables import read

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}
WORD_VOCABULARY = "word_bpe_49k.json"


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn

    return add


@register("op1_near_duplicates")
def op1_near_duplicates(spark, sf):
    return near_duplicates.near_duplicate_classes(read(spark, sf, "documents"))


@register("op2_personal_data")
def op2_personal_data(spark, sf):
    return pii.personal_data_digest(read(spark, sf, "documents"))


@register("op3_nearest_neighbours")
def op3_nearest_neighbours(spark, sf):
    return ann.nearest(read(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op4_mixing")
def op4_mixing(spark, sf):
    return mixing.mix_documents(read(spark, sf, "documents"))


@register("op5_token_counts")
def op5_token_counts(spark, sf):
    import public_tokenizers

    return token_counts.token_counts(
        read(spark, sf, "documents"), str(public_tokenizers.path(WORD_VOCABULARY)))


@register("op6_decontamination")
def op6_decontamination(spark, sf):
    return decontaminate.contamination(
        read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@register("op7_toxicity")
def op7_toxicity(spark, sf):
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels))


@register("op8_quality")
def op8_quality(spark, sf):
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    return quality.score_quality(docs, quality.fit_quality(docs, labels))


@register("op9_chat_formatting")
def op9_chat_formatting(spark, sf):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = read(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    records = chat.as_mixed_records(rows.unionByName(extra))
    return chat.digests(chat.render(chat.from_json_records(records)))


@register("op10_sharding")
def op10_sharding(spark, sf):
    return sharding.shard_documents(read(spark, sf, "documents"))


@register("op11_hard_negatives", hard_negatives.SQL)
def op11_hard_negatives(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


@register("op12_periodic_runs")
def op12_periodic_runs(spark, sf):
    docs = periodic_runs.with_repeated_tail(read(spark, sf, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


@register("op13_warc", warc.SQL)
def op13_warc(spark, sf):
    return warc.read_back(warc.restore(warc.archive(read(spark, sf, "pages"))))
