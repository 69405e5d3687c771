"""Embed, train, evaluate and gate the Layer 1 model."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators import classify, encode, evaluate
from ..operators.encode import EncoderFactory
from ..sources import store


def embedded_splits(
    spark: SparkSession, root: str, factory: EncoderFactory | None = None
) -> DataFrame:
    """Split table with the 419-wide matrix; written once, because fitting reads it many times."""
    frame = store.read_split(spark, f"{root}/gold/splits")
    matrix = encode.model_matrix(encode.embed(frame, factory=factory))
    path = f"{root}/gold/matrix"
    matrix.select("video_id", "label", "split", "x").write.partitionBy("split").mode(
        "overwrite").parquet(path)
    return spark.read.parquet(path)


def train_and_evaluate(
    spark: SparkSession, root: str, factory: EncoderFactory | None = None
) -> tuple[PipelineModel, DataFrame]:
    """Fit on train, save the model, write the evaluation, return model and metrics."""
    matrix = embedded_splits(spark, root, factory)
    model = classify.train(matrix.where("split = 'train'"))
    model.write().overwrite().save(f"{root}/models/layer1")
    scored = classify.predict(model, matrix).select("split", "label", "pred", "score")
    scored.write.mode("overwrite").parquet(f"{root}/reports/scored")
    scored = spark.read.parquet(f"{root}/reports/scored")
    table = evaluate.metrics(scored)
    reports = {
        "model_evaluation": table, "confusion_matrix": evaluate.confusion_matrix(scored),
        "class_report": evaluate.class_report(scored), "overfit_gaps": evaluate.overfit_gaps(table),
        "promotion_gate": evaluate.promotion_gate(table),
    }
    for name, report in reports.items():
        store.write_document(report, f"{root}/reports/{name}")
    return model, table


def promoted(table: DataFrame) -> bool:
    row = evaluate.promotion_gate(table).first()
    return bool(row and row["promote"])


def load_model(root: str) -> PipelineModel:
    return PipelineModel.load(f"{root}/models/layer1")
