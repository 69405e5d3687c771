"""Snapshot-partitioned tables, split tables, one-row JSON documents."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..schemas import RAW_FEEDS

INGEST_ORDER = "ingest_seq"
SPREAD = 64


def write_snapshots(df: DataFrame, path: str) -> None:
    """Replace exactly the snapshots present in ``df``; a rerun writes the same again.

    Rows of a snapshot stay spread over the tasks that hold them.
    """
    df.write.partitionBy("snapshot_date").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").parquet(path)


def write_bronze(df: DataFrame, path: str) -> None:
    """Landed feed as it came, in Parquet, one directory per snapshot, with an ingest order.

    A CSV file with quoted line breaks is read by one task, so its rows are spread right after.
    """
    landed = df.withColumn(INGEST_ORDER, F.monotonically_increasing_id())
    landed.repartition("snapshot_date", F.pmod(F.xxhash64("video_id"), F.lit(SPREAD))).write \
        .partitionBy("snapshot_date").mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").parquet(path)


def read_bronze(spark: SparkSession, name: str, path: str) -> DataFrame:
    schema = T.StructType([*RAW_FEEDS[name].fields, T.StructField(INGEST_ORDER, T.LongType())])
    return spark.read.schema(schema).parquet(path)


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All snapshots of a table; a filter on ``snapshot_date`` prunes directories.

    ``schema`` fixes columns and types, where files of several writers lie side by side; without one
    the first footer decides.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    df = spark.read.parquet(path)
    date = F.col("snapshot_date")
    if dict(df.dtypes)["snapshot_date"] != "string":
        df = df.withColumn("snapshot_date", date.cast("string"))
    return df


def write_splits(df: DataFrame, path: str, csv_path: str | None = None) -> None:
    df.write.partitionBy("split").mode("overwrite").parquet(path)
    if csv_path:  # from the written table, not by splitting again
        df.sparkSession.read.parquet(path).write.partitionBy("split").mode("overwrite").csv(csv_path, header=True, escape='"')


def read_split(spark: SparkSession, path: str, *names: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("split").isin(*names)) if names else df


def write_document(df: DataFrame, path: str) -> None:
    """A report as JSON lines in one file; the caller passes an aggregate of a few rows."""
    df.coalesce(1).write.mode("overwrite").json(path)


def feature_manifest(spark: SparkSession) -> DataFrame:
    """What a model may read, as one row."""
    numeric = K.numeric_features()

    def names(values) -> Column:
        return F.array(*[F.lit(v) for v in values])

    return spark.range(1).select(
        F.current_timestamp().alias("created_at"), F.lit(K.TARGET).alias("target"),
        names(numeric).alias("numeric_features"), names(K.TEXT_COLUMNS).alias("text_features"),
        names(K.ID_COLUMNS).alias("id_columns"), F.lit(len(numeric)).alias("n_numeric_features"),
        F.lit("numeric and text features may feed a model; id columns may not, some give away "
              "the label").alias("usage"),
    )
