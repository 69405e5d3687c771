"""Near-duplicate classes by b-bit MinHash.

Every text gets 128 minima of its shingle set. Bands of 6 minima (5 for thresholds below 0.85) give
candidates; two low bits of each minimum are packed into four longs, and the collision-corrected
similarity estimated from equal bit pairs drops unlikely candidates. What remains is confirmed on
full shingle sets.

Scale: texts with equal shingle sets collapse to their smallest id first. A bucket is not opened into
pairs: its members join the *cell* of the bucket's smallest id, which most bands of a group of
copies agree on. A cell is worked on in chunks of ``CHUNK`` members, and only a spanning forest of
confirmed links leaves a task. Links between chunks are sought for members that their own chunk left
unlinked to the cell's leader (``_between``); members already in one class need no further pair.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import scratch, written
from . import graph, tables
from .words import shingle_set

HASHES, BITS = 128, 2
CHUNK = 3000
_LOW = np.uint64(0x5555555555555555)
_rng = np.random.RandomState(20240607)
_A = (_rng.randint(0, 2**32, HASHES, np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _rng.randint(0, 2**32, HASHES, np.uint64).astype(np.uint32)

SKETCH = ("doc_id string, n_shingles long, same long, same2 long, bands array<long>, "
          "packed array<long>")


def minima(shingles: np.ndarray) -> np.ndarray:
    """HASHES minima (uint32) of a non-empty set of 64-bit shingle hashes."""
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 2**32 - 1, np.uint32)
    for at in range(0, len(h), 1024):
        values = _A[:, None] * h[None, at:at + 1024]
        values += _B[:, None]
        np.minimum(out, values.min(axis=1), out=out)
    return out


def band_rows(percent: int) -> int:
    """Minima per band: a pair exactly at 0.85 or 0.8 shares no band once in 20,000 cases."""
    return 6 if percent >= 85 else 5 if percent >= 80 else 3


def band_keys(mins: np.ndarray, rows: int) -> np.ndarray:
    """(n, HASHES) minima -> (n, bands) 64-bit bucket keys; the band number is part of the key."""
    bands = HASHES // rows
    keys = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    keys = np.repeat(keys, len(mins), axis=0)
    for r in range(rows):
        keys = (keys ^ mins[:, r:bands * rows:rows].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(29)
    return keys


def pack(mins: np.ndarray) -> np.ndarray:
    """(n, HASHES) minima -> (n, 4) longs of two low bits each."""
    low = ((mins ^ (mins >> np.uint32(16))) & np.uint32(3)).astype(np.uint64)
    shift = np.arange(32, dtype=np.uint64) * np.uint64(2)
    return (low.reshape(len(mins), -1, 32) << shift).sum(axis=2, dtype=np.uint64)


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal bit pairs, corrected for chance collisions (1 in 4)."""
    differ = one ^ many
    unequal = np.bitwise_count((differ | (differ >> np.uint64(1))) & _LOW).sum(axis=-1)
    return (1.0 - unequal / HASHES - 0.25) / 0.75


def least_estimate(percent: int) -> float:
    """Four standard errors below the threshold: a link is missed by the filter once in 30,000."""
    j = percent / 100
    p = j + (1 - j) / 4
    return j - 4 * np.sqrt(p * (1 - p) / HASHES) / 0.75


def fingerprint(sets: list[np.ndarray]) -> np.ndarray:
    """(n, 2) longs that identify each shingle set."""
    return np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                     for s in sets], np.int64).reshape(-1, 2)


def _sketches(rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                part = pdf.iloc[at:at + 1000]
                sets = [shingle_set(t) for t in part["text"]]
                full = np.array([len(s) > 0 for s in sets], bool)
                mins = np.zeros((len(sets), HASHES), np.uint32)
                for i in np.flatnonzero(full):
                    mins[i] = minima(sets[i])
                same = fingerprint(sets)
                keys, packed = band_keys(mins, rows).view(np.int64), pack(mins).view(np.int64)
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "n_shingles": [len(s) for s in sets],
                    "same": same[:, 0], "same2": same[:, 1],
                    "bands": [k if f else None for k, f in zip(keys, full)],
                    "packed": [k if f else None for k, f in zip(packed, full)],
                })

    return run


def _linked(sets: list[np.ndarray], i: int, others: np.ndarray, percent: int) -> np.ndarray:
    """Which of ``others`` reach the threshold with member i on full sets."""
    hit = np.array([np.isin(sets[j], sets[i], assume_unique=True).sum() for j in others], np.int64)
    size = np.array([len(sets[j]) for j in others], np.int64)
    return others[100 * hit >= percent * (len(sets[i]) + size - hit)]


def spanning_links(ids: np.ndarray, sets: list[np.ndarray], packed: np.ndarray, percent: int,
                   rows: np.ndarray, with_: np.ndarray, group: np.ndarray) -> list[tuple[int, int]]:
    """Confirmed links of ``rows`` with members ``with_`` that join different classes of ``group``.

    ``group`` holds a class per member and is updated. Per row: the estimate and the size bound pick
    candidates in other classes, full sets decide, most similar class members first.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    low, links = least_estimate(percent), []
    for i in rows:
        small, large = np.minimum(sizes[i], sizes[with_]), np.maximum(sizes[i], sizes[with_])
        ok = (group[with_] != group[i]) & (100 * small >= percent * large)
        near = with_[ok]
        if not len(near):
            continue
        guess = estimate(packed[i], packed[near])
        near = near[guess >= low][np.argsort(-guess[guess >= low], kind="stable")]
        while len(near):
            for j in _linked(sets, i, near[:64], percent):
                if group[j] != group[i]:
                    links.append((int(ids[i]), int(ids[j])))
                    group[group == group[j]] = group[i]
            near = near[64:]
            near = near[group[near] != group[i]]
    return links


def _chunks(percent: int):
    """Per (cell, chunk): links found inside, and per member whether it reached the leader."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", ignore_index=True)
        ids = pdf["doc_id"].to_numpy()
        sets = [np.frombuffer(b, np.uint64) for b in pdf["shingles"]]
        packed = np.stack(pdf["packed"]).view(np.uint64)
        group, all_ = np.arange(len(ids)), np.arange(len(ids))
        lead = int(np.searchsorted(ids, pdf["cell"].iloc[0]))
        links = spanning_links(ids, sets, packed, percent, np.array([lead]), all_, group)
        rest = all_[group != group[lead]]
        links += spanning_links(ids, sets, packed, percent, rest, all_, group)
        open_ = ids[group != group[lead]]
        cell, chunk = pdf["cell"].iloc[0], pdf["chunk"].iloc[0]
        return pd.DataFrame({
            "cell": cell, "chunk": chunk, "u": [a for a, _ in links] + list(open_),
            "v": [b for _, b in links] + [None] * len(open_),
        }).astype({"u": "int64", "v": "Int64"})

    return one


def _between(percent: int):
    """Per pair of chunks of a large cell: open members of either against the other."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["doc_id"].to_numpy()
        sets = [np.frombuffer(b, np.uint64) for b in pdf["shingles"]]
        packed = np.stack(pdf["packed"]).view(np.uint64)
        first = (pdf["chunk"] == pdf["i"]).to_numpy()
        open_ = pdf["open"].to_numpy()
        group = np.where(open_, np.arange(len(ids)), len(ids))
        links = []
        for side in (first, ~first):
            links += spanning_links(ids, sets, packed, percent, np.flatnonzero(side & open_),
                                    np.flatnonzero(~side), group)
        return pd.DataFrame(links, columns=["u", "v"]).astype("int64")

    return one


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sets = [shingle_set(t) for t in pdf.pop("text")]
        pdf["same"] = fingerprint(sets)[:, 0]
        pdf["shingles"] = [s.tobytes() for s in sets]
        yield pdf


def near_duplicate_classes(docs: DataFrame, percent: int = 85, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs(doc_id, text)``.

    Documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets;
    component_id is the smallest doc_id reachable. Null and empty texts have no shingles and stand
    alone. Rows with a null doc_id come back with a null class and are kept. Rows repeating a
    doc_id are separate texts of one node. Other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = written(tables.through_python(base, _sketches(band_rows(percent)), SKETCH))
    full = sketch.where("n_shingles > 0 and doc_id is not null")
    first = full.groupBy("same", "same2").agg(F.min("doc_id").alias("rep"))
    placed = written(full.select("doc_id", "same", "same2").join(first, ["same", "same2"])
                     .select("doc_id", "rep").distinct())
    # one row per distinct set; a doc_id that repeats with other texts has several
    reps = written(full.join(first.withColumnRenamed("rep", "doc_id"),
                             ["same", "same2", "doc_id"], "left_semi")
                   .dropDuplicates(["same", "same2"])
                   .select("doc_id", "same", "bands", "packed"))
    bands = reps.select("doc_id", "same", F.explode("bands").alias("bucket"))
    buckets = bands.groupBy("bucket").agg(
        F.min("doc_id").alias("cell"), F.count("*").alias("n")).where("n > 1").drop("n")
    cells = written(bands.join(buckets, "bucket").select("cell", "doc_id", "same")
                    .distinct())
    links = _confirmed(base, reps, cells, percent, chunk)
    edges = links.unionByName(placed.where("doc_id <> rep").select(
        F.col("doc_id").alias("u"), F.col("rep").alias("v")))
    classes = graph.components(edges)
    joined = sketch.select("doc_id", "n_shingles").join(
        classes, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("component", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _confirmed(base: DataFrame, reps: DataFrame, cells: DataFrame, percent: int,
               chunk: int) -> DataFrame:
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / chunk)
    dealt = cells.join(sizes, "cell").withColumn("parts", parts).withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    wanted = tables.lookup(
        base, cells.select("doc_id").distinct(), ["doc_id"], "left_semi", row_bytes=16)
    sets = tables.through_python(wanted, _sets, "doc_id string, same long, shingles binary")
    full = written(sets.join(reps.select("doc_id", "same", "packed"), ["doc_id", "same"])
                   .dropDuplicates(["doc_id", "same"]))
    members = dealt.join(full, ["doc_id", "same"])
    leaders = dealt.where("doc_id = cell").where("parts > 1").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    leaders = leaders.join(full, ["doc_id", "same"])
    in_chunks = members.where("not (doc_id = cell and parts > 1)").unionByName(leaders)
    found = written(in_chunks.groupBy("cell", "chunk").applyInPandas(
        _chunks(percent), "cell long, chunk long, u long, v long"))
    links = found.where("v is not null").select("u", "v")
    large = members.where("parts > 1 and doc_id <> cell")
    opened = found.where("v is null").select("cell", F.col("u").alias("doc_id"),
                                             F.lit(True).alias("open")).distinct()
    if found.where("v is null").join(sizes.where(F.col("n") > chunk), "cell", "left_semi") \
            .isEmpty():
        return links
    large = large.join(opened, ["cell", "doc_id"], "left").withColumn(
        "open", F.coalesce("open", F.lit(False)))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    units = large.withColumn("other", other).where("other <> chunk").select(
        "cell", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
        "chunk", "doc_id", "shingles", "packed", "open")
    across = units.groupBy("cell", "i", "j").applyInPandas(_between(percent), "u long, v long")
    return links.unionByName(across)


def without_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of ``docs`` per near-duplicate class of rows; all columns as they were.

    Every row is a text of its own, whatever its doc_id, so rows are written with a number that tells
    them apart. The row of the smallest doc_id stays, null ones last; among those of one doc_id the
    one of the smallest text hash, then of the smallest number. Texts without words all stay.
    """
    with scratch() as keep:
        rows = keep(written(docs.withColumn("__row", F.monotonically_increasing_id())))
        classes = written(near_duplicate_classes(
            rows.select(F.col("__row").alias("doc_id"), "text"), percent).select(
            F.col("doc_id").alias("__row"), F.col("component_id").alias("__class"), "kept"))
        several = classes.where(~F.col("kept")).select("__class").distinct()
        linked = tables.lookup(classes.drop("kept"), several, ["__class"], "left_semi", row_bytes=16)
        keys = tables.row_key(rows.select("doc_id", "text", "__row")).select(
            "__row", F.col("doc_id").isNull().alias("none"), "__id", "__text")
        members = written(tables.lookup(keys, linked, ["__row"], "inner", row_bytes=24))
        first = members.groupBy("__class").agg(F.min(F.struct("none", "__id", "__text", "__row"))[
            "__row"].alias("__row"))
        dropped = keep(written(
            members.join(first, ["__class", "__row"], "left_anti").select("__row")))
    return tables.lookup(rows, dropped, ["__row"], "left_anti", row_bytes=16).select(*docs.columns)
