"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by size (powers of two of their shingle count). For a partition of size m
a document is read in windows of 2m shingles every m, so an item lies in a window at most a few
times its own size, where a MinHash sketch can meet it however long the document is. Sketches keep
the minimum of each of 128 hash bins (all shingles of items of up to 16). A shared minimum makes a
candidate; it is confirmed by exact containment of the item's shingle set in the document's.

Items travel in blocks of bounded bytes; documents are mapped once per block, without a shuffle.
"""

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tables
from .words import shingle_hashes, shingle_set, words

BINS_SHIFT = np.uint64(57)  # 128 bins by the leading bits
FULL = 16
CONTAINMENT = 0.8
BLOCK_BYTES = 8 << 20
LEADING_BITS = 22
SCHEMA = "{columns}, n_shingles long, items array<struct<item_id long, shared long, size long>>"


def bin_minima(hashes: np.ndarray) -> np.ndarray:
    """The least hash of every bin that has one; hashes of a bin are neighbours when sorted."""
    ordered = np.unique(hashes)
    return ordered[np.unique(ordered >> BINS_SHIFT, return_index=True)[1]]


def members(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values stand in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class Items:
    """Sketches of a block of test items, by size partition."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids, self.sets = [], []
        by_size: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in rows:
            own = shingle_set(text)
            if not len(own):
                continue
            m = max(FULL, 1 << int(len(own) - 1).bit_length())
            for value in (own if len(own) <= FULL else bin_minima(own)).tolist():
                by_size[m][value].append(len(self.ids))
            self.ids.append(item_id)
            self.sets.append(own)
        self.parts = [(m, np.sort(np.array(list(d), np.uint64)), dict(d))
                      for m, d in sorted(by_size.items())]
        self.known = np.unique(np.concatenate([k for _, k, _ in self.parts])) if self.parts \
            else np.empty(0, np.uint64)
        # most hashes are told apart from the sketches' by their leading bits alone
        self.leading = np.zeros(1 << LEADING_BITS, bool)
        self.leading[self.known >> np.uint64(64 - LEADING_BITS)] = True

    def candidates(self, hashes: np.ndarray) -> set[int]:
        """Items whose sketch shares a minimum with a window of the document."""
        found: set[int] = set()
        marked = np.flatnonzero(self.leading[hashes >> np.uint64(64 - LEADING_BITS)])
        if len(marked):
            marked = marked[members(hashes[marked], self.known)]
        if not len(marked):
            return found
        for m, known, items in self.parts:
            at = marked[members(hashes[marked], known)]
            for w in np.unique(np.concatenate([at // m, np.maximum(at // m - 1, 0)])):
                window = hashes[w * m:w * m + 2 * m]
                sketch = np.unique(window) if m == FULL else bin_minima(window)
                for value in sketch[members(sketch, known)].tolist():
                    found.update(items[value])
        return found

    def contained(self, text: str | None, least: float) -> tuple[int, list[dict]]:
        """Shingles of the text, and the items it contains."""
        hashes = shingle_hashes(words(text))
        own, out = np.unique(hashes), []
        for i in sorted(self.candidates(hashes)):
            shared = int(members(self.sets[i], own).sum())
            if shared >= least * len(self.sets[i]):
                out.append({"item_id": self.ids[i], "shared": shared, "size": len(self.sets[i])})
        return len(own), out


def n_blocks(benchmark: DataFrame) -> int:
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // BLOCK_BYTES))


def _blocks(benchmark: DataFrame, n: int) -> Iterator[list[tuple[int, str]]]:
    """Test items in n blocks of about BLOCK_BYTES, one at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        F.length("text") > 0)
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def find_items(docs: DataFrame, benchmark: DataFrame, least: float = CONTAINMENT,
               keep_text: bool = False) -> DataFrame:
    """doc_id, n_shingles, items (and text, if wanted) for every row of ``docs(doc_id, text)``.

    ``items``: (item_id, shared, size) of each item with ``shared >= least * size`` of its distinct
    shingles in the text, by item. An item of fewer than five words is one shingle, met only by a
    text of just these words; items without words are met by none. Null and empty texts hold no
    item. Without items every list is empty. Rows are independent.
    """
    spark = docs.sparkSession
    blocks = n_blocks(benchmark)
    columns = "doc_id string, text string"
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for i, rows in enumerate(_blocks(benchmark, blocks)):
        sent = spark.sparkContext.broadcast(rows)  # at most about BLOCK_BYTES
        # texts go along only while another block of items has to see them
        kept = ["doc_id", "text"] if keep_text or i < blocks - 1 else ["doc_id"]

        def run(batches: Iterator[pd.DataFrame], sent=sent, kept=kept) -> Iterator[pd.DataFrame]:
            block = Items(sent.value)
            for pdf in batches:
                made = [block.contained(t, least) for t in pdf["text"]]
                items = [new for _, new in made]
                if "items" in pdf:
                    items = [[dict(x.asDict() if hasattr(x, "asDict") else x) for x in old] + new
                             for old, new in zip(pdf["items"], items)]
                yield pdf[kept].assign(n_shingles=[n for n, _ in made], items=items)

        out = tables.through_python(out, run, SCHEMA.format(
            columns=columns if len(kept) == 2 else "doc_id string"))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_shingles, item_ids, n_items, contaminated for every row of ``docs``.

    Null and empty texts hold no item; very long ones are searched whole. Rows are independent:
    repeated rows and null ids each give a row, an empty table none. Items that repeat are listed as often.
    Other columns of either table are ignored, whatever their names.
    """
    ids = F.array_sort(F.transform("items", lambda i: i["item_id"]))
    return find_items(docs, benchmark).select(
        "doc_id", "n_shingles", ids.alias("item_ids"), F.size("items").cast("long").alias("n_items"),
        (F.size("items") > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that contain no item; all columns as they were."""
    found = find_items(docs, benchmark, keep_text=True).where(F.size("items") > 0)
    return tables.without(docs, tables.row_key(found))
