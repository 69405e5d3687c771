"""Label folds of the trained scorers: which labelled rows may be learned from, and how many."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(key: Column) -> Column:
    """Rows never learned from: crc32 of the id as text is divisible by 5. A null id is held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(True))


def sample(labels: DataFrame, target: str, fold: Column, rows: int) -> DataFrame:
    """At most ``rows`` learnable ids of a fold, in the order of a hash: (doc_id, label).

    The same ids whatever the partitioning; ids labelled twice count once, by the larger label.
    """
    known = labels.select("doc_id", F.col(target).cast("double").alias("label")).where(
        F.col("label").isin(0.0, 1.0) & ~held_out(F.col("doc_id")) & fold)
    one = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def third(i: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("third"), "doc_id"), F.lit(3)) == i
