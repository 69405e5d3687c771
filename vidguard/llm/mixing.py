"""Mixing sources to target weights over fixed-length blocks of words.

Every source is one stream of words (documents in hash order, positions from distributed running
sums) packed into blocks of ``BLOCK`` words. Output shards draw multinomial source counts, each with
the shares that are still owed; the last shard takes what remains. The draws hand every source a run
of slots; slot i of pass p holds block ``permutation(i)`` of the source, so a pass uses each block
once and no block more than twice. Slots and document pieces are joined by (source, block).

Only rows per source pass through the driver and are broadcast: at most MAX_SOURCES, about 20 MB;
more sources raise an error before any work.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import scratch, written
from . import tables

WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
BLOCK, SHARDS, SEED = 128, 64, 20240607
MAX_SOURCES = 200_000
GROUP = 20_000
_M = np.uint64(0xFFFFFFFF)


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """Adds target to (source, source_size): shares by weight, at most MOST times the size.

    The excess over a limit is shared again by weight: every source below its limit gets ``level``
    times its weight. With sources by rising limit per weight, the level is what is left over the
    weights that are left, at the first source whose limit is not below it (the largest such level).
    One row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (n % len(WEIGHTS) + 1).cast("int"))
    limited = sources.withColumn("w", weight).withColumn("limit", MOST * F.col("source_size"))
    rising = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    owed = SHARE * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    left = F.sum("w").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = limited.withColumn("level", owed / left)
    level = level.withColumn("level", F.max(F.when(
        F.col("level") * F.col("w") <= F.col("limit"), F.col("level"))).over(whole))
    target = F.least(F.coalesce(F.col("level") * F.col("w"), F.col("limit")), F.col("limit"))
    return level.select("source", "source_size", target.alias("target"))


def draw_slots(sizes: list[int], wanted: list[float], block: int = BLOCK, shards: int = SHARDS,
               seed: int = SEED) -> list[tuple[int, int, int, int]]:
    """(source number, shard, first slot, slots): multinomial counts per shard and source."""
    blocks = -(-np.array(sizes, np.int64) // block)
    per_block = np.array(sizes, float) / np.maximum(blocks, 1)
    most = (MOST * blocks).astype(np.int64)
    owed = np.minimum(np.rint(np.array(wanted) / np.maximum(per_block, 1e-9)).astype(np.int64), most)
    rng, given, rows = np.random.Generator(np.random.PCG64(seed)), np.zeros(len(sizes), np.int64), []
    for shard in range(shards):
        left = owed - given
        if left.sum() == 0:
            break
        if shard < shards - 1:
            slots = int(left.sum() // (shards - shard))
            count = np.minimum(rng.multinomial(slots, left / left.sum()), left)
        else:
            count = left
        rows += [(int(s), shard, int(given[s]), int(count[s])) for s in np.flatnonzero(count)]
        given += count
    return rows


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1 at ``index``: four Feistel rounds, walked until inside."""
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out, open_ = index.astype(np.uint64).copy(), np.ones(len(index), bool)
    while open_.any():
        x = out[open_]
        left, right = x >> np.uint64(half), x & low
        for r in range(4):
            f = (right + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & low)
        out[open_] = left << np.uint64(half) | right
        open_[open_] = out[open_] >= n
    return out.astype(np.int64)


def _slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            for at in range(r.first, r.first + r.slots, 100_000):
                slot = np.arange(at, min(at + 100_000, r.first + r.slots))
                block = np.empty(len(slot), np.int64)
                for turn in np.unique(slot // r.blocks):
                    own = slot // r.blocks == turn
                    block[own] = permute(slot[own] % r.blocks, r.blocks,
                                         (r.number * 1_000_003 + int(turn) * 7919 + SEED) & (2**63 - 1))
                yield pd.DataFrame({"number": r.number, "shard": r.shard, "slot": slot,
                                    "block": block})


def packed(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """Adds ``first``: the place of a document's first word in its source's stream.

    ``docs(number, doc_id, size)`` by hash of the id in groups of about ``group`` rows: sums per
    group, running sums over groups, then inside a group. No task orders a whole source.
    """
    total = docs.count()
    groups = max(1, -(-total // group))
    keyed = docs.withColumn("_h", F.xxhash64("doc_id", "size")).withColumn(
        "_g", F.pmod("_h", F.lit(groups)))
    sums = keyed.groupBy("number", "_g").agg(F.sum("size").alias("_s"))
    before = F.sum("_s").over(Window.partitionBy("number").orderBy("_g")) - F.col("_s")
    sums = sums.select("number", "_g", before.alias("_before"))
    inside = F.sum("size").over(Window.partitionBy("number", "_g").orderBy("_h", "doc_id", "_row")
                                .rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    return keyed.withColumn("_inside", inside).join(sums, ["number", "_g"]).withColumn(
        "first", F.col("_before") + F.col("_inside")).drop("_h", "_g", "_before", "_inside")


class Mix:
    """A drawn mixture: ``documents`` with sizes and targets, ``slots`` (number, shard, slot, block)
    and ``pieces`` (number, block, doc_id, words) of every block."""

    def __init__(self, docs: DataFrame, block: int = BLOCK, shards: int = SHARDS,
                 row: Column | None = None):
        spark = docs.sparkSession
        row = F.monotonically_increasing_id() if row is None else row
        slim = written(tables.row_key(docs.select("doc_id", "source", "text", row.alias("_row"))).select(
            "doc_id", "__id", "__text", "source", n_words(F.col("text")).alias("size"),
            "_row"))
        sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
        if sizes.count() > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
        plan = written(targets(sizes).withColumn("number", number))
        rows = plan.orderBy("number").collect()  # at most MAX_SOURCES, one per source
        drawn = draw_slots([r["source_size"] for r in rows], [r["target"] for r in rows],
                           block, shards)
        blocks = {r["number"]: -(-r["source_size"] // block) for r in rows}
        runs = spark.createDataFrame(
            [(*d, blocks[d[0]]) for d in drawn],
            "number int, shard int, first long, slots long, blocks long")
        self.slots = runs.repartition("number", "shard").mapInPandas(
            _slots, "number int, shard int, slot long, block long")
        known = slim.join(F.broadcast(plan), slim["source"].eqNullSafe(plan["source"])).drop("source")
        self.documents = written(packed(known.select(
            "number", "doc_id", "__id", "__text", "_row", "size", "source_size", "target")))
        last = F.col("first") + F.col("size") - 1
        at = self.documents.where("size > 0").select(
            "number", "doc_id", "_row", "first", last.alias("last"), F.explode(F.sequence(
                F.floor(F.col("first") / block), F.floor(last / block))).alias("block"))
        overlap = F.least(F.col("last") + 1, (F.col("block") + 1) * block) - F.greatest(
            "first", F.col("block") * block)
        self.pieces = at.select(
            "number", "block", "doc_id", "_row", overlap.alias("words"))

    def uses(self) -> DataFrame:
        """(_row, taken): words the slots take of a row."""
        used = self.slots.groupBy("number", "block").agg(F.count("*").alias("times"))
        return self.pieces.join(used, ["number", "block"]).groupBy("_row").agg(
            F.sum(F.col("words") * F.col("times")).alias("taken"))

    def copies(self, group: int = GROUP) -> DataFrame:
        """(_row, copies): whole copies of every row, 0 to 2; 1 of a row without words.

        A document is used taken / size times on average over its blocks, and gets that number
        rounded down or up. Rounded up are, per source, those with the largest fractions (to 1/64), as
        many as it takes until their words make up for the words lost by rounding down. So a source's words
        differ from those taken by less than one document. Running sums as in ``packed``, with
        groups in the order of the fractions.
        """
        docs = self.documents.join(self.uses(), "_row", "left").select(
            "_row", "number", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
        whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(1)
        docs = written(docs.withColumn("whole", whole.cast("long")).withColumn(
            "part", F.col("taken") - F.col("whole") * F.col("size")))
        open_ = docs.where("size > 0 and part > 0").withColumn(
            "_f", F.col("part") / F.col("size")).withColumn("_h", F.xxhash64("_row"))
        groups = max(1, -(-docs.count() // group))
        open_ = open_.withColumn("_g", F.floor((1 - F.col("_f")) * 64) * groups + F.pmod(
            "_h", F.lit(groups)))
        sums = open_.groupBy("number", "_g").agg(F.sum("size").alias("_s"), F.sum("part").alias("_p"))
        one = Window.partitionBy("number")
        sums = sums.select("number", "_g", F.sum("_p").over(one).alias("_owed"), (
            F.sum("_s").over(one.orderBy("_g")) - F.col("_s")).alias("_before"))
        inside = F.sum("size").over(Window.partitionBy("number", "_g").orderBy(
            F.desc("_f"), "_h", "_row").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
        up = open_.withColumn("_inside", inside).join(sums, ["number", "_g"]).where(
            F.col("_before") + F.col("_inside") + F.col("size") / 2 <= F.col("_owed")).select(
            "_row", F.lit(1).alias("_up"))
        return docs.join(up, "_row", "left").select(
            "_row", (F.col("whole") + F.coalesce("_up", F.lit(0))).alias("copies"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs(doc_id, source, text)``.

    Null texts have no words, are never taken and keep their row; null sources form one source, the
    last. Rows that repeat a doc_id are separate documents. The same input gives the same mix,
    unless rows repeat a doc_id with other texts, whose order is that of the scan.
    """
    mix = Mix(docs)
    return mix.documents.join(mix.uses(), "_row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` as whole documents, each 0 to 2 times, by the mean use of all its blocks.

    Texts are not cut; a source's words are within one document of those the slots take. Rows
    without words stay once. Rows are told apart by a written number. Columns stay as they were.
    """
    with scratch() as keep:
        rows = keep(written(docs.withColumn("__row", F.monotonically_increasing_id())))
        copies = keep(written(Mix(rows, row=F.col("__row")).copies().where("copies > 0").select(
            F.col("_row").alias("__row"), F.col("copies").alias("__copies"))))
    out = tables.lookup(rows, copies, ["__row"], "inner", row_bytes=32)
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(
        *docs.columns)
