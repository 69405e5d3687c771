"""Feeds to bronze, silver, gold and splits; every step covers all snapshots in one job."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators import gold, quality, silver, split
from ..sources import feeds, store
from ..sources.shared import forget, written

FEEDS = ("label", "ocr", "asr", "metadata")


def land(spark: SparkSession, paths: Mapping[str, str], root: str) -> None:
    for name in FEEDS:
        store.write_bronze(feeds.read_feed(spark, name, paths[name]), f"{root}/bronze/{name}")


def refine(spark: SparkSession, root: str) -> None:
    for name in FEEDS:
        raw = store.read_bronze(spark, name, f"{root}/bronze/{name}")
        store.write_snapshots(silver.clean_feed(name, raw), f"{root}/silver/{name}")


def build_gold(spark: SparkSession, root: str) -> None:
    """Each feed is de-duplicated and written once; medians, features and labels read that table."""
    latest = {n: written(gold.one_row_per_video(store.read_snapshots(spark, f"{root}/silver/{n}")))
              for n in FEEDS}
    store.write_snapshots(gold.assemble_features(**latest), f"{root}/gold/feature_store")
    store.write_snapshots(gold.labels_of(latest["label"]), f"{root}/gold/label_store")
    for table in latest.values():
        forget(table)


def modeling_frame(spark: SparkSession, root: str) -> DataFrame:
    return gold.modeling_frame(
        store.read_snapshots(spark, f"{root}/gold/feature_store"),
        store.read_snapshots(spark, f"{root}/gold/label_store"),
    )


def split_and_report(spark: SparkSession, root: str, with_csv: bool = True) -> None:
    """Write the joined frame once; checks, split and report then read the written table."""
    store.write_snapshots(modeling_frame(spark, root), f"{root}/gold/frame")
    frame = store.read_snapshots(spark, f"{root}/gold/frame")
    quality.require_ready(quality.readiness_checks(frame))
    store.write_document(store.feature_manifest(spark), f"{root}/reports/feature_manifest")
    store.write_splits(
        split.stratified_split(frame), f"{root}/gold/splits",
        f"{root}/gold/splits_csv" if with_csv else None,
    )
    written = store.read_split(spark, f"{root}/gold/splits")
    store.write_document(quality.quality_report(written), f"{root}/reports/data_quality")


def backfill(spark: SparkSession, paths: Mapping[str, str], root: str) -> None:
    land(spark, paths, root)
    refine(spark, root)
    build_gold(spark, root)
    split_and_report(spark, root)
