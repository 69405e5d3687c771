"""Raw feed reader, snapshot discovery, seed corpus file."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_FEEDS, SEED_CORPUS


def read_feed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """CSV with header, quoted line breaks and doubled quotes; an empty field is NULL."""
    return spark.read.schema(RAW_FEEDS[name]).csv(path, header=True, multiLine=True, escape='"')


def snapshot_dates(label_feed: DataFrame) -> DataFrame:
    return label_feed.select(F.col("snapshot_date").cast("string").alias("snapshot_date")) \
        .distinct().orderBy("snapshot_date")


def snapshot(df: DataFrame, date: str | Column) -> DataFrame:
    return df.where(F.col("snapshot_date") == date)


def read_seed_corpus(
    spark: SparkSession, path: str, n_harmful: int | None = None, n_clean: int | None = None
) -> DataFrame:
    """(class, position, text), the first n of each class."""
    raw = spark.read.schema(SEED_CORPUS).json(path, multiLine=True)
    out = None
    for name, n in (("harmful", n_harmful), ("clean", n_clean)):
        rows = raw.select(F.lit(name).alias("class"), F.posexplode(name).alias("position", "text"))
        rows = rows if n is None else rows.where(F.col("position") < n)
        out = rows if out is None else out.unionByName(rows)
    return out
