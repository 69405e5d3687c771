"""Medians from stored quantile sketches, for feeds whose rows arrive late or in many parts.

A KLL sketch per snapshot and column has a fixed size and merges with others of its kind, so a late part
is sketched alone and the medians follow without reading the older rows again. The exact path is
``gold.snapshot_medians``; a sketched median differs from it by a share of ranks, not by a value.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N

SNAPSHOT = "snapshot_date"
# size of a sketch, and the share of ranks by which its median may be off (published for this size: under
# 0.5 % in 99 of 100 sketches); sketches of at most SIZE values are exact
SIZE, RANK_ERROR = 800, 0.01


def median_sketches(feeds: Sequence[tuple[DataFrame, Sequence[str]]], size: int = SIZE) -> DataFrame:
    """(snapshot_date, feature, n, sketch) of the finite values of each feed's columns.

    Sketches are combined inside the map tasks: one per snapshot, column and task is shuffled. A
    column without a finite value has n = 0 and a null sketch.
    """
    out = None
    for df, columns in feeds:
        cells = df.select(
            SNAPSHOT, *[F.col(c).cast("double").alias(c) for c in columns]
        ).unpivot(SNAPSHOT, list(columns), "feature", "value")
        known = F.when(N.finite(F.col("value")), F.col("value"))
        part = cells.groupBy(SNAPSHOT, "feature").agg(
            F.count(known).alias("n"), F.kll_sketch_agg_double(known, F.lit(size)).alias("sketch"))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("sketch", F.when(F.col("n") > 0, F.col("sketch")))


def merged(*parts: DataFrame) -> DataFrame:
    """One sketch per snapshot and feature from several tables of sketches."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(SNAPSHOT, "feature").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_medians(sketches: DataFrame) -> DataFrame:
    """(snapshot_date, feature, n, median); null without a finite value, as in the exact path."""
    median = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)))
    return sketches.select(SNAPSHOT, "feature", "n", median.alias("median"))
