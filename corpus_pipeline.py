"""Corpus pipeline: documents in, sharded training documents out.

    toxicity -> near-duplicates -> decontamination -> mixing -> sharding

Each stage works on everything its predecessor kept, and is written before the next one reads it.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vidguard.llm import decontaminate, mixing, near_duplicates, sharding, toxicity
from vidguard.llm.tables import read
from vidguard.sources.shared import scratch, ship_package, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
SHARDS = 8
# rows of whole texts that a Python worker holds at once; its memory stays with it between stages
BATCH_ROWS = "1000"


def _ready(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones among them, does not reject.

    Null and empty texts get the score of a text without features. Rows that repeat doc_id and text are
    kept or go together. Without labels of both kinds a constant rate decides. Columns stay as they were,
    further ones too; an empty table stays empty.
    """
    _ready(spark)
    model = toxicity.fit_toxicity(docs, read(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every near-duplicate class, of its smallest doc_id; texts without words stay.

    Every row is a text of its own, whatever its doc_id; null ids come last. Columns stay as they were;
    an empty table stays empty.
    """
    _ready(spark)
    return near_duplicates.without_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Null and empty texts contain none and stay, as does everything where the benchmark is empty. Rows that
    repeat doc_id and text go together. Columns stay as they were.
    """
    _ready(spark)
    return decontaminate.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their blocks on average: never, once or twice.

    Texts without words, null ones too, stay once; null sources are one source. Rows are told apart by a
    written number, so repeated rows are taken each for itself. Columns stay as they were.
    """
    _ready(spark)
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their number in it.

    All rows stay: null ids share a shard, repeated ids too, with slots of their own. ``shard`` and
    ``slot`` replace columns of these names; an empty table stays empty.
    """
    _ready(spark)
    return sharding.shard_rows(docs, [1.0] * SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    with scratch() as keep_last:
        for _, stage in STAGES:
            with scratch() as keep:
                docs = keep(written(stage(spark, docs, sf_dir)))
        keep_last(docs)
    return docs
