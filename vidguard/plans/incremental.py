"""Incremental medallion: only snapshots whose feeds changed are rebuilt, each state published whole.

A state is a manifest (``sources.generations``) that says, for every table and snapshot, which folder
holds it, and the fingerprint of every feed's snapshot it was built from. A run fingerprints the feeds
in one pass each, rebuilds what differs into a folder of its own and publishes. A killed run leaves the old
state; a repeated one finds nothing to do. Readers name no schema by chance: every table's is fixed.
"""

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gold, silver
from ..schemas import RAW_FEEDS
from ..sources.generations import Generations
from ..sources.shared import scratch, written

FEEDS = ("label", "ocr", "asr", "metadata")
FEATURES, LABELS = "gold/feature_store", "gold/label_store"
DATE = "snapshot_date"
# snapshots a task writes side by side; it sorts its rows by snapshot when there are more
OPEN_FILES = 12
# how a null snapshot date is named in a manifest, and by the writer in a path
_NONE, _NONE_PATH = "", "__HIVE_DEFAULT_PARTITION__"


def _date() -> Column:
    return F.coalesce(F.col(DATE).cast("string"), F.lit(_NONE))


def fingerprints(feed: DataFrame) -> DataFrame:
    """(snapshot_date, n, first, second): rows and two sums of row hashes, in whatever order rows come.

    Sums rather than exclusive-or, so a row that repeats twice leaves its mark. Combined before the
    shuffle: a row per snapshot and task travels.
    """
    row = F.to_json(F.struct(*feed.columns), {"ignoreNullFields": "false"})
    exact = "decimal(38,0)"
    return feed.select(_date().alias(DATE), row.alias("row")).groupBy(DATE).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("row").cast(exact)).alias("first"),
        F.sum(F.xxhash64(F.lit("second"), "row").cast(exact)).alias("second"))


@cache
def _schemas(spark: SparkSession) -> dict[str, T.StructType]:
    """Schema of every table, from the plan over empty feeds."""
    clean = {n: silver.clean_feed(n, spark.createDataFrame([], RAW_FEEDS[n])) for n in FEEDS}
    return {**{f"silver/{n}": df.schema for n, df in clean.items()},
            FEATURES: gold.feature_store(**clean).schema,
            LABELS: gold.label_store(clean["label"]).schema}


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Writes by snapshot keep a file open per snapshot instead of sorting wide rows, up to a bound."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class SnapshotState:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.states = Generations(spark, root)

    def read(self, table: str, dates: Iterable[str] | None = None,
             generation: int | None = None) -> DataFrame:
        """A table ("silver/asr", "gold/feature_store", ...) of one state, of some dates if given."""
        manifest = self.states.latest()[1] if generation is None else (
            self.states.manifest(generation))
        return self._read(manifest.get("tables", {}), table, dates)

    def _read(self, tables: Mapping, table: str, dates: Iterable[str] | None = None) -> DataFrame:
        schema = _schemas(self.spark)[table]
        by_folder: dict[str, list[str]] = {}
        for date, folder in tables.get(table, {}).items():
            if dates is None or date in dates:
                by_folder.setdefault(folder, []).append(date)
        parts = []
        for folder, held in sorted(by_folder.items()):
            base = f"{self.states.path}/{folder}/{table}"
            paths = [f"{base}/{DATE}={d or _NONE_PATH}" for d in sorted(held)]
            parts.append(self.spark.read.schema(schema).option("basePath", base).parquet(*paths))
        empty = self.spark.createDataFrame([], schema)
        return reduce(lambda a, b: a.unionByName(b), parts, empty) if len(parts) != 1 else (
            parts[0].select(*schema.names))

    def update(self, feeds: Mapping[str, DataFrame]) -> list[str]:
        """Bring the state to what the four feeds hold now; the snapshots rebuilt, in order.

        A snapshot no feed holds any more leaves the state. If another run publishes first, the work
        starts from its state.
        """
        while True:
            number, old = self.states.latest()
            now = {n: {r[DATE]: [r["n"], str(r["first"]), str(r["second"])]
                       for r in fingerprints(feeds[n]).collect()} for n in FEEDS}  # a row a snapshot
            before = old.get("feeds", {n: {} for n in FEEDS})
            changed = {n: {d for d in {*now[n], *before[n]} if now[n].get(d) != before[n].get(d)}
                       for n in FEEDS}
            rebuilt = sorted(set().union(*changed.values()))
            if not rebuilt:
                return []
            folder = self.states.new_folder()
            tables = {t: dict(held) for t, held in old.get("tables", {}).items()}
            for name in FEEDS:
                self._silver(feeds[name], name, changed[name], now[name], folder, tables)
            self._gold(rebuilt, now["label"], folder, tables)
            folders = sorted({f for held in tables.values() for f in held.values()})
            if self.states.publish(number + 1, {"feeds": now, "tables": tables, "folders": folders}):
                return rebuilt

    def _write(self, df: DataFrame, table: str, dates: set[str], folder: str, tables: dict) -> None:
        held = tables.setdefault(table, {})
        if dates:
            with _unsorted(self.spark):
                df.write.partitionBy(DATE).option("compression", "zstd").parquet(
                    f"{self.states.path}/{folder}/{table}")
            held.update({d: folder for d in dates})

    def _silver(self, feed: DataFrame, name: str, changed: set[str], now: Mapping, folder: str,
                tables: dict) -> None:
        for gone in changed - set(now):
            tables.get(f"silver/{name}", {}).pop(gone, None)
        wanted = changed & set(now)
        rows = feed.where(_date().isin(*sorted(wanted))) if wanted else feed
        self._write(silver.clean_feed(name, rows), f"silver/{name}", wanted, folder, tables)

    def _gold(self, rebuilt: list[str], labels: Mapping, folder: str, tables: dict) -> None:
        """Features and labels of the rebuilt snapshots; the label feed says which snapshots exist."""
        for table in (FEATURES, LABELS):
            for gone in set(rebuilt) - set(labels):
                tables.get(table, {}).pop(gone, None)
        wanted = set(rebuilt) & set(labels)
        with scratch():
            silver_now = {n: self._read(tables, f"silver/{n}", wanted) for n in FEEDS}
            # the texts are read where they lie; the combined one follows from the others
            latest = {"label": gold.one_row_per_written_video(silver_now["label"].drop(gold.COMBINED))}
            latest |= {n: written(gold.one_row_per_video(df)) for n, df in silver_now.items()
                       if n != "label"}
            self._write(gold.assemble_features(**latest), FEATURES, wanted, folder, tables)
            self._write(gold.labels_of(latest["label"]), LABELS, wanted, folder, tables)

    def prune(self, keep: int = 2) -> None:
        self.states.prune(keep)
