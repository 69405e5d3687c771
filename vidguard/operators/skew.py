"""Building blocks that stay balanced when one key holds a large share of the rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SMALL_ROWS = 100_000
SALTS = 16
# left rows of one key that a task can hold beside others
HOT_ROWS = 10_000


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: greatest by ``order``, then by the other columns.

    An aggregate rather than a window: copies of a hot key collapse inside each map task, so one
    row per key and task is shuffled. The whole row takes part in the comparison, which makes the
    choice independent of row order. With an ``order`` that is unique per key, select the columns
    you need first; without one, every caller has to pass the same columns to get the same row.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.max(F.struct(*order, *rest)).alias("_row")
    out = df.groupBy(*keys).agg(row)
    return out.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def latest_of_few(df: DataFrame, keys: Sequence[str], most: int = SMALL_ROWS) -> DataFrame:
    """``latest_per_key`` of a written table with wide rows: only rows whose key repeats are compared.

    The others are neither sorted nor shuffled. The keys that repeat are counted first, from their columns
    alone, and fetched up to ``most``; beyond it all rows are compared.
    """
    many = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*keys)
    rows = many.limit(most + 1).toArrow()
    if rows.num_rows > most:
        return latest_per_key(df, keys)
    if not rows.num_rows:
        return df
    few = F.broadcast(df.sparkSession.createDataFrame(rows, many.schema).toDF(*[f"_{k}" for k in keys]))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(few, on=same, how="left_anti").unionByName(
        latest_per_key(df.join(few, on=same, how="left_semi"), keys))


def small_table(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Run an aggregate that should be tiny once and keep its rows as a local table.

    Spark knows the size of a local table and broadcasts it. At most ``max_rows + 1`` rows are
    fetched; beyond the bound the input comes back unchanged and is joined by shuffle.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return df.sparkSession.createDataFrame(rows, df.schema)


def lookup_join(
    left: DataFrame, right: DataFrame, on: str, spread: str, salts: int = SALTS
) -> DataFrame:
    """Left join to a slim table with one row per key, when a key may be hot or NULL on the left.

    Left rows of a key are spread over ``salts`` partitions by another column, and each of those
    gets its own copy of the key's right row. Rows without a key are spread by that column too;
    they match nothing.
    """
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    key = F.coalesce(F.col(on), F.concat(F.lit("\0"), F.col(spread)))
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return left.withColumns({"_salt": salt, "_lookup": key}).join(
        right.withColumnRenamed(on, "_lookup").withColumn("_salt", copies),
        on=["_lookup", "_salt"], how="left",
    ).drop("_salt", "_lookup")


def wide_lookup_join(
    left: DataFrame, right: DataFrame, on: str, spread: str, salts: int = SALTS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``lookup_join`` to a table with wide rows, such as texts: only rows of hot keys are copied.

    A key is hot from ``hot_rows`` left rows on, so there are few, and the list of them is broadcast.
    The left keys are read once more to count them.
    """
    hot = F.broadcast(left.where(F.col(on).isNotNull()).groupBy(F.col(on).alias("_lookup")).agg(
        F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= hot_rows).select(
        "_lookup", F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(0).cast("int")
    key = F.coalesce(F.col(on), F.concat(F.lit("\0"), F.col(spread)))
    copies = F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                       .otherwise(F.array(F.lit(0))))
    rows = left.withColumn("_lookup", key).join(hot, on="_lookup", how="left").withColumn("_salt", salt)
    found = right.withColumnRenamed(on, "_lookup").join(hot, on="_lookup", how="left").withColumn(
        "_salt", copies)
    return rows.drop("_hot").join(found.drop("_hot"), on=["_lookup", "_salt"], how="left").drop(
        "_salt", "_lookup")


def _before(keys: Sequence[str], bucket: str) -> Window:
    return Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)


def running_total(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column], value: str, out: str
) -> DataFrame:
    """Inclusive running total of ``value`` per key, taken bucket by bucket.

    ``bucket`` must not decrease along ``order``. Totals of the buckets before give each bucket its
    start, so no task has to hold all rows of a key.
    """
    starts = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_in")).select(
        *keys, bucket,
        F.coalesce(F.sum("_in").over(_before(keys, bucket)), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    total = F.col("_start") + F.sum(value).over(inside)
    return df.join(starts, on=[*keys, bucket]).withColumn(out, total).drop("_start")


def bucketed_rank(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column], out: str,
    parts: Sequence[str] = (),
) -> DataFrame:
    """``row_number`` per key along (bucket, order) without one task per key.

    ``parts``: columns that split a bucket further, in the direction of ``order``; with the leading
    order keys in them, rows that tie in one bucket are dealt to many tasks as well.
    """
    counts = df.groupBy(*keys, bucket, *parts).agg(F.count(F.lit(1)).alias("_in"))
    starts = counts.groupBy(*keys, bucket).agg(F.sum("_in").alias("_in")).select(
        *keys, bucket,
        F.coalesce(F.sum("_in").over(_before(keys, bucket)), F.lit(0)).alias("_start"),
    )
    if parts:
        earlier = Window.partitionBy(*keys, bucket).orderBy(*parts).rowsBetween(
            Window.unboundedPreceding, -1)
        fine = counts.withColumn("_part", F.coalesce(F.sum("_in").over(earlier), F.lit(0)))
        starts = fine.join(starts, on=[*keys, bucket]).select(
            *keys, bucket, *parts, (F.col("_start") + F.col("_part")).alias("_start"))
    inside = Window.partitionBy(*keys, bucket, *parts).orderBy(*order)
    rank = F.col("_start") + F.row_number().over(inside)
    return df.join(starts, on=[*keys, bucket, *parts]).withColumn(out, rank).drop("_start")
