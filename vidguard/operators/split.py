"""Stratified 80/10/10 split and per-class sampling by a stable hash order."""

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.hashing import hash_bucket, order_hash

SPLITS = ("train", "val", "test")
_DIGITS = 3  # 4096 hash buckets per label


def quotas(counts: Mapping[int, int], take: int) -> dict[int, int]:
    """Share ``take`` rows among the classes: floors first, then the largest remainders."""
    total = sum(counts.values())
    exact = {k: n * take / total for k, n in counts.items()}
    out = {k: math.floor(v) for k, v in exact.items()}
    spare = take - sum(out.values())
    for k in sorted(counts, key=lambda k: (out[k] - exact[k], k))[:spare]:
        out[k] += 1
    return out


def split_quotas(counts: Mapping[int, int]) -> dict[int, tuple[int, int]]:
    """Rows per label for (train, val); the rest of a label is its test share."""
    n = sum(counts.values())
    held = math.ceil(K.HOLDOUT_SHARE * n)
    train = quotas(counts, n - held)
    rest = {k: counts[k] - train[k] for k in counts}
    tested = math.ceil(K.TEST_SHARE_OF_HOLDOUT * held)
    val = quotas(rest, held - tested) if held else dict.fromkeys(counts, 0)
    return {k: (train[k], val[k]) for k in counts}


def _cut_points(slim: DataFrame, quota: Mapping[int, tuple[int, int]], buckets: Mapping) -> dict:
    """Hash value at each wanted rank; ranks only the rows of the buckets those ranks fall in."""
    wanted = []  # (label, bucket, rank inside the bucket, rank in the label)
    for label, (train, val) in quota.items():
        for rank in {train, train + val} - {0}:
            seen = 0
            for bucket, n in sorted(buckets[label].items()):
                if rank <= seen + n:
                    wanted.append((label, bucket, rank - seen, rank))
                    break
                seen += n
    if not wanted:
        return {}
    hit = F.lit(False)
    for label, bucket, _, _ in wanted:
        hit = hit | ((F.col("label") == label) & (F.col("bucket") == bucket))
    place = F.row_number().over(Window.partitionBy("label", "bucket").orderBy("hash"))
    ranked = slim.where(hit).withColumn("place", place)
    at = F.lit(False)
    for label, bucket, inside, _ in wanted:
        at = at | (
            (F.col("label") == label) & (F.col("bucket") == bucket) & (F.col("place") == inside)
        )
    found = {(r["label"], r["bucket"], r["place"]): r["hash"] for r in ranked.where(at).collect()}
    return {(label, rank): found[label, bucket, inside] for label, bucket, inside, rank in wanted}


def split_column(frame: DataFrame, seed: int = K.SPLIT_SEED, key: str = "video_id") -> Column:
    """Expression giving each row its split.

    Two small aggregates over (key, label) find the hash value at which each label's train and val
    shares end; the rows themselves are then only compared with those few values. The wide table is
    never sorted or shuffled, and the result does not depend on partitioning.
    """
    hashed = order_hash(F.col(key), seed)
    slim = frame.select("label", hashed.alias("hash")).withColumn(
        "bucket", hash_bucket(F.col("hash"), _DIGITS)
    )
    buckets: dict[int, dict[int, int]] = {}
    # at most labels x 4096 rows
    for r in slim.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n")).collect():
        buckets.setdefault(r["label"], {})[r["bucket"]] = r["n"]
    counts = {k: sum(v.values()) for k, v in buckets.items()}
    if not counts:
        raise ValueError("nothing to split: the modelling frame is empty")
    quota = split_quotas(counts)
    cuts = _cut_points(slim, quota, buckets)
    out = None
    for label, (train, val) in quota.items():
        mine = F.col("label") == label
        for name, rank in (("train", train), ("val", train + val)):
            if rank:
                cond = mine & (hashed <= cuts[label, rank])
                out = F.when(cond, name) if out is None else out.when(cond, name)
    return F.lit("test") if out is None else out.otherwise("test")


def stratified_split(frame: DataFrame, seed: int = K.SPLIT_SEED) -> DataFrame:
    return frame.withColumn("split", split_column(frame, seed))


def first_per_class(
    df: DataFrame, sizes: Mapping[str, int], cls: str, key: str, seed: int = K.SPLIT_SEED
) -> DataFrame:
    """The first n rows of each class in hash order, from one scan.

    Every task keeps the first rows of a class it has met, at most the largest n, before anything is
    shuffled; so a class meets in one task with that many rows a task, whatever its size.
    """
    order = Window.partitionBy(cls).orderBy(order_hash(F.col(key), seed), F.col(key))
    wanted = F.create_map(*[F.lit(x) for item in sizes.items() for x in item])
    placed = df.where(F.col(cls).isin(*sizes)).withColumn("_place", F.row_number().over(order))
    return placed.where(F.col("_place") <= max(sizes.values(), default=0)).where(
        F.col("_place") <= wanted[F.col(cls)]).drop("_place")


class TooFewSamples(ValueError):
    """Raised when a class has fewer usable texts than asked for."""


def class_of(
    label: Column, harmful: Sequence[str] = K.HARMFUL_VALUES, clean: Sequence[str] = K.CLEAN_VALUES
) -> Column:
    value = F.lower(F.trim(label.cast("string")))
    return F.when(value.isin(*harmful), "harmful").when(value.isin(*clean), "clean")


def usable_texts(
    df: DataFrame, text: str, label: str, key: str, max_length: int = K.SAMPLE_TEXT_LENGTH
) -> DataFrame:
    """Squeezed, length-limited, non-empty texts of the two classes."""
    squeezed = F.trim(F.regexp_replace(F.col(text), r"\s+", " "))
    return df.select(
        F.col(key), F.substring(squeezed, 1, max_length).alias("text"),
        class_of(F.col(label)).alias("class"),
    ).where((F.col("text") != "") & F.col("class").isNotNull())


def corpus_sample(
    df: DataFrame, text: str, label: str, key: str, n_harmful: int, n_clean: int,
    strict: bool = False, seed: int = K.SPLIT_SEED, max_length: int = K.SAMPLE_TEXT_LENGTH,
) -> DataFrame:
    sizes = {"harmful": n_harmful, "clean": n_clean}
    sample = first_per_class(
        usable_texts(df, text, label, key, max_length), sizes, "class", key, seed
    )
    if strict:
        found = {r["class"]: r["count"] for r in sample.groupBy("class").count().collect()}
        short = {c: (found.get(c, 0), n) for c, n in sizes.items() if found.get(c, 0) < n}
        if short:
            raise TooFewSamples(", ".join(f"{c}: {a} of {n}" for c, (a, n) in short.items()))
    return sample
