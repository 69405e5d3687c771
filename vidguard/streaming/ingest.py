"""Pick up newly arrived feed files and land them in the silver table.

Feeds arrive as one batch per snapshot; ``availableNow`` runs the same way, taking what
arrived since the last run. The checkpoint remembers the files already taken, so a restart after a
lost executor or driver neither repeats nor drops a file.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.silver import clean_feed
from ..schemas import RAW_FEEDS


def feed_stream(spark: SparkSession, name: str, path: str) -> DataFrame:
    return spark.readStream.schema(RAW_FEEDS[name]).csv(
        path, header=True, multiLine=True, escape='"')


def ingest_new_files(
    spark: SparkSession, name: str, source: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Append cleaned rows of new files; copies are resolved when gold is built."""
    cleaned = clean_feed(name, feed_stream(spark, name, source))
    return cleaned.writeStream.format("parquet").partitionBy("snapshot_date").option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).outputMode("append").start(target)
