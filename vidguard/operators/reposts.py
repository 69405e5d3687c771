"""Repost expansion: several evaded copies of each seed text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import augment as A


def expand(seeds: DataFrame, key: str, copies: int = K.REPOSTS_PER_SEED) -> DataFrame:
    """``copies`` rows per seed with new ids '<key>-<copy>'."""
    return seeds.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).withColumns({
        "video_id": F.concat_ws("-", F.col(key), "_copy"),
        "seed_id": F.concat(F.lit("s"), F.col(key)),
    }).drop("_copy")


def reposts(
    seeds: DataFrame, key: str, text: str = "text", copies: int = K.REPOSTS_PER_SEED, seed: int = 0
) -> DataFrame:
    """Label feed rows: every copy with its own title, on-screen and spoken variant."""
    rows = expand(seeds, key, copies).withColumns({
        m: A.variant(F.col(text), F.col("video_id"), m, seed=seed) for m in K.MEDIUMS
    })
    return rows.select(
        "video_id", "seed_id", F.col("title.variant_type").alias("variant_type"),
        *[F.col(f"{m}.text").alias(f"{m}_text") for m in K.MEDIUMS],
    )
