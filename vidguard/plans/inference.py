"""Batch inference of one split against the harmful training videos."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators import classify, encode, infer
from ..operators.encode import EncoderFactory
from ..sources import journal, store
from .training import load_model


def score_layer1(
    spark: SparkSession, root: str, frame: DataFrame, factory: EncoderFactory | None = None
) -> DataFrame:
    matrix = encode.model_matrix(encode.embed(frame, factory=factory))
    scored = classify.layer1(classify.predict(load_model(root), matrix)).drop("vector", "x")
    return infer.with_text_key(scored)


def infer_split(
    spark: SparkSession, root: str, name: str = "test", run_id: str | None = None,
    run_at: datetime | None = None, replies: DataFrame | None = None, verifier: Callable[[Column], Column] | None = None,
    factory: EncoderFactory | None = None, encoder_version: str = "token-hash-1",
) -> DataFrame:
    """Score, match, route and write one split; with a run id and time also log the predictions.

    Layer 1 output is written before matching, which reads it several times. Seed vectors are kept
    under ``encoder_version``: name another one with every other encoder.
    """
    if run_id and run_at is None:
        raise ValueError("a logged run needs its time: a repeat must log the same rows")
    splits = store.read_split(spark, f"{root}/gold/splits")
    seeds = infer.seed_corpus(splits)
    layer1 = f"{root}/reports/layer1_{name}"
    score_layer1(spark, root, store.read_split(spark, f"{root}/gold/splits", name), factory) \
        .write.mode("overwrite").parquet(layer1)
    records = infer.inference_records(
        spark.read.parquet(layer1), seeds, replies, verifier, factory,
        seed_store=(f"{root}/models/seed_vectors", encoder_version))
    out = f"{root}/reports/inference_{name}"
    records.write.mode("overwrite").parquet(out)
    written = spark.read.parquet(out)
    if run_id:
        journal.append_predictions(written, f"{root}/log/predictions", run_id, run_at)
    return written
