"""Sharding by weighted rendezvous hashing of stable record keys.

Every shard draws a uniform number from the hash of (key, shard); the shard with the largest
``weight / -ln(draw)`` keeps the record. A key's shard depends on the key and the shards alone, and
an added shard takes records only into itself. Numbers within a shard come from one range shuffle:
rows are sorted by (shard, hash), written once, and counted per written piece, so no window and no
task ever sees a whole shard.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written
from . import tables

LAW = "key"


def _draw(key: Column, shard: int) -> Column:
    """Uniform in (0, 1) from 52 bits of the hash of key and shard."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit("shard"), F.lit(shard), key), 12)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Number of the shard that keeps a key; a shard of weight 0 takes nothing."""
    scores = [F.struct((F.lit(float(w)) / -F.log(_draw(key, i))).alias("score"),
                       F.lit(-i).alias("first"))
              for i, w in enumerate(weights) if w > 0]
    if not scores:
        raise ValueError("no shard of positive weight")
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best["first"]).cast("int")


def shard_rows(rows: DataFrame, weights: list[float], key: str = "doc_id",
               grown: float | None = None) -> DataFrame:
    """All columns of ``rows`` with shard, slot and, if ``grown`` is given, grown_shard.

    slot counts from 0 without gaps in every shard. ``grown_shard``: the shard after one more of
    weight ``grown``. Null keys are hashed as "null:" and share a shard; rows that repeat a key
    share its shard and have slots of their own. Added columns replace columns of the same names. Texts
    are not looked at, so empty, null and very long ones are rows like others; an empty table gives none.
    """
    named = F.coalesce(F.concat(F.lit("key:"), F.col(key).cast("string")), F.lit("null:"))
    given = rows.drop("shard", "slot", "grown_shard")
    placed = given.withColumn("shard", rendezvous(named, weights))
    if grown is not None:
        placed = placed.withColumn("grown_shard", rendezvous(named, [*weights, grown]))
    # the last range column splits a key that many rows repeat
    placed = placed.withColumn("__order", F.xxhash64(named)).withColumn(
        "__row", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange("shard", "__order", "__row").sortWithinPartitions(
        "shard", "__order", "__row").drop("__row", "__order")
    table = written(ranged.withColumn("__piece", F.spark_partition_id()).withColumn(
        "__at", F.monotonically_increasing_id()))
    # a row per piece and shard
    pieces = table.groupBy("shard", "__piece").agg(
        F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("shard").orderBy("__piece")) - F.col("__n")
    starts = pieces.select("shard", "__piece", (before - F.col("__first")).alias("__shift"))
    # a row per piece and shard: the rows themselves are not shuffled again
    out = tables.lookup(table, starts, ["shard", "__piece"], "inner", row_bytes=32).withColumn(
        "slot", F.col("__at") + F.col("__shift"))
    return out.select(*given.columns, "shard", "slot", *(
        ["grown_shard"] if grown is not None else []))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of ``docs(doc_id, text)``.

    size is the UTF-8 bytes of the text (null: none) plus 1; a null text has the crc32 of an empty
    one.
    """
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit(LAW).alias("law"))
    return shard_rows(slim, [1.0] * shards, grown=1.0)
