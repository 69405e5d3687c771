"""Hard negatives by exact inner products, scored in the manner of the Four Russians.

Every vector is quantised to integers and packed once: eight dimensions make a group, and each bit
plane of a group is one byte. An anchor's part in a group is a table of 256 sums, one for every
subset of its eight components. A candidate's score is then looked up instead of multiplied:

    score = sum over planes p of 2^p * sum over groups g of table[g][byte[g][p]]

taken from the highest plane down by shift and add; the highest plane carries the sign.

Anchors travel in blocks of bounded size, one after another, to the packed rows, which stay where they
were written: nothing but the best few rows of an anchor and task is shuffled. The first pass finds
each anchor's positives among the rows of its label; the second finds, below each positive's score, the
negatives among the rows of other labels.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import forget, written

# anchors of one broadcast block; their best rows are what a task holds (positives x negatives each)
BLOCK_ANCHORS = 8_192
# anchors whose subset sums are held at once, and rows scored at once
STEP_ANCHORS, STEP_ROWS = 64, 4_096
LEAST = np.iinfo(np.int64).min
_GROUP = 8
PACKED = "vec_id long, label long, planes binary"


class Best:
    """The first ``n`` (score, id) of each of many lists: higher scores first, then smaller ids."""

    def __init__(self, lists: int, n: int):
        self.n = n
        self.score = np.full((lists, n), LEAST, np.int64)
        self.id = np.zeros((lists, n), np.int64)
        self.held = np.zeros(lists, np.int64)

    def enters(self, lists: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which (score, id) come before the last of a list; the arguments may broadcast."""
        last, at = self.score[lists, self.n - 1], self.id[lists, self.n - 1]
        return (score > last) | ((score == last) & (ids < at))

    def add(self, lists: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(lists):
            return
        touched = np.unique(lists)
        old, place = np.nonzero(np.arange(self.n) < self.held[touched][:, None])
        old = touched[old]
        lists = np.concatenate([old, lists])
        score = np.concatenate([self.score[old, place], score])
        ids = np.concatenate([self.id[old, place], ids])
        # the complement reverses the order of all 64-bit scores without overflow
        order = np.lexsort((ids, ~score, lists))
        lists, score, ids = lists[order], score[order], ids[order]
        first = np.searchsorted(lists, lists)
        rank = np.arange(len(lists)) - first
        kept = rank < self.n
        self.score[lists[kept], rank[kept]] = score[kept]
        self.id[lists[kept], rank[kept]] = ids[kept]
        self.held[touched] = np.minimum(np.bincount(lists, minlength=touched[-1] + 1)[touched], self.n)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists, place = np.nonzero(np.arange(self.n) < self.held[:, None])
        return lists, self.score[lists, place], self.id[lists, place]


def subset_sums(vectors: np.ndarray) -> np.ndarray:
    """(groups, 256, rows): sums of every subset of each eight components of integer rows."""
    rows, dim = vectors.shape
    groups = -(-dim // _GROUP)
    padded = np.zeros((groups * _GROUP, rows), vectors.dtype)
    padded[:dim] = vectors.T
    parts = padded.reshape(groups, _GROUP, rows)
    table = np.zeros((groups, 1, rows), vectors.dtype)
    for bit in range(_GROUP):
        table = np.concatenate([table, table + parts[:, bit:bit + 1]], axis=1)
    return table


def pack(vectors: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes * groups) bytes of integer rows: bit planes of two's complement, lowest first."""
    rows, dim = vectors.shape
    bits = (vectors[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").reshape(rows, -1)


def looked_up(table: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(rows, anchors) exact scores. ``planes``: (planes, groups, rows) bytes."""
    total = None
    for top in range(len(planes) - 1, -1, -1):
        here = table[0][planes[top, 0]]
        for g in range(1, len(table)):
            here += table[g][planes[top, g]]
        # the first plane taken is the sign
        total = -here if total is None else (total << 1) + here
    return total


def _quantised(vector: str, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def _usable(key: str, label: str, vector: str, scale: int) -> Column:
    """Neither null nor beyond what 63 bits hold; comparison with NaN is false both ways here."""
    bound = float(1 << 62)
    fine = F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(F.lit(float(scale)) * x.cast("double")) < bound), F.lit(False)))
    return F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(fine, F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Integer rows of a list column; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), dim), np.int64)
    out[np.arange(dim) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _packer(dim: int, planes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(at, STEP_ROWS)
                packed = pack(_matrix(part.column(2), dim), planes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(list(map(bytes, packed)), pa.binary())],
                    names=["vec_id", "label", "planes"])

    return run


def _steps(batches: Iterator[pa.RecordBatch], planes: int, groups: int
           ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and (planes, groups, rows) bytes of at most STEP_ROWS rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, STEP_ROWS):
            part = batch.slice(at, STEP_ROWS)
            flat = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8)
            cube = flat.reshape(part.num_rows, planes, groups).transpose(1, 2, 0)
            yield (part.column(0).to_numpy(), part.column(1).to_numpy(),
                   np.ascontiguousarray(cube))


def _tables(vectors: np.ndarray, planes: int) -> Iterator[tuple[int, np.ndarray]]:
    """Subset sums of a few anchors at a time, in 32 bits where every partial score fits."""
    for at in range(0, len(vectors), STEP_ANCHORS):
        part = vectors[at:at + STEP_ANCHORS]
        largest = np.abs(part.astype(np.float64)).sum(axis=1).max() * 2.0 ** planes
        yield at, subset_sums(part.astype(np.int32) if largest < 2 ** 30 else part)


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns.values()], names=list(columns))


def _positives(block, planes: int, groups: int, n: int) -> Callable:
    """Per task, the n best rows of each anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, key, label, vectors = block.value
        best = Best(len(number), n)
        for ids, labels, cube in _steps(batches, planes, groups):
            for one in np.intersect1d(label, labels):
                mine, rows = np.flatnonzero(label == one), np.flatnonzero(labels == one)
                part = np.ascontiguousarray(cube[:, :, rows])
                for at, table in _tables(vectors[mine], planes):
                    lists = mine[at:at + STEP_ANCHORS]
                    score = looked_up(table, part).T.astype(np.int64)
                    score[ids[rows][None, :] == key[lists][:, None]] = LEAST
                    a, r = np.nonzero(
                        best.enters(lists[:, None], score, ids[rows][None, :])
                        & (score > LEAST) & (score >= _nth_best(score, n)))
                    best.add(lists[a], score[a, r], ids[rows[r]])
        lists, score, ids = best.rows()
        yield _batch({"number": number[lists], "positive_id": ids, "positive_score": score})

    return run


def _nth_best(score: np.ndarray, n: int) -> np.ndarray:
    """(lists, 1): the n-th best score of each list, the least one of a shorter list."""
    n = min(n, score.shape[1])
    return np.partition(score, -n, axis=1)[:, -n][:, None]


def _negatives(block, planes: int, groups: int, n: int, low: int, high: int) -> Callable:
    """Per task, for each (anchor, positive) the n best rows of other labels inside the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, key, label, vectors, positive = block.value
        per = positive.shape[1]
        # least and greatest score allowed: low * positive <= 100 * score <= high * positive
        absent, wide = positive == LEAST, positive.astype(object)
        # in Python's integers, as the products may need more than 64 bits
        bounds = (-(-low * wide // 100), high * wide // 100)
        least, most = (np.clip(b, LEAST, -LEAST - 1).astype(np.int64) for b in bounds)
        least[absent], most[absent] = -LEAST - 1, LEAST
        best = Best(len(number) * per, n)
        for ids, labels, cube in _steps(batches, planes, groups):
            for at, table in _tables(vectors, planes):
                mine = np.arange(at, min(at + STEP_ANCHORS, len(number)))
                score = looked_up(table, cube).T.astype(np.int64)
                # first what is inside any window of the anchor, then window by window
                a, r = np.nonzero(
                    (score >= least[mine].min(axis=1)[:, None])
                    & (score <= most[mine].max(axis=1)[:, None])
                    & (labels[None, :] != label[mine][:, None])
                    & (ids[None, :] != key[mine][:, None]))
                found, at_id, a = score[a, r], ids[r], mine[a]
                for k in range(per):
                    lists = a * per + k
                    fits = (found >= least[a, k]) & (found <= most[a, k]) & best.enters(
                        lists, found, at_id)
                    best.add(lists[fits], found[fits], at_id[fits])
        lists, score, ids = best.rows()
        yield _batch({"number": number[lists // per], "place": lists % per + 1,
                      "negative_id": ids, "negative_score": score})

    return run


def _first(rows: DataFrame, keys: list[str], score: str, key: str, n: int) -> DataFrame:
    """First n per key; at most n rows of a key come from one task."""
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), key)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(
    rows: DataFrame, anchors: Column, key: str = "vec_id", label: str = "label",
    vector: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 5,
    low: int = 80, high: int = 100, block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become ``floor(scale * x)``; a score is the integer inner product. An anchor's
    positives are its best ``positives`` rows of the same label; each gets its best ``negatives`` rows
    of another label with ``low * positive <= 100 * negative <= high * positive``. Equal scores are
    ordered by smaller key. All candidates are scored; nothing is approximate.

    Rows with a null key, label, vector or component, or one that is not finite (or, scaled, beyond
    2^62) take no part. Vectors of different lengths are compared as if the shorter one ended in zeros;
    an empty vector scores 0 with everyone. Rows that repeat a key are rows of their own, each an anchor
    if its key is one; a row is never a positive or negative of its own key. Scores are exact while
    they fit 64 bits. Other columns are ignored; an empty table gives no rows.
    """
    spark = rows.sparkSession
    given = rows.where(_usable(key, label, vector, scale)).select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        _quantised(vector, scale).alias("q"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    size = given.agg(
        F.max(F.size("q")).alias("dim"), F.min(F.array_min("q")).alias("lo"),
        F.max(F.array_max("q")).alias("hi"), F.sum(F.col("anchor").cast("long")).alias("n")).first()
    dim = max(size["dim"] or 0, 1)
    planes = max(int(size["lo"] or 0).bit_length(), int(size["hi"] or 0).bit_length()) + 1
    groups = -(-dim // _GROUP)
    packed = written(given.select("vec_id", "label", "q").mapInArrow(_packer(dim, planes), PACKED))
    # a block is what one broadcast holds: bounded rows, however many anchors there are
    blocks = max(1, -(-(size["n"] or 0) // max(1, block_anchors // 2)))
    chosen = written(given.where("anchor").select(
        "vec_id", "label", "q", F.monotonically_increasing_id().alias("number")).withColumn(
        "block", F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int")).repartition("block"))
    out = None
    for i in range(blocks):
        anchors_ = chosen.where(F.col("block") == i).orderBy("label", "number").toArrow()
        if not anchors_.num_rows:
            continue
        block = _block(anchors_, dim)
        sent = spark.sparkContext.broadcast(block)
        best = _first(packed.mapInArrow(
            _positives(sent, planes, groups, positives),
            "number long, positive_id long, positive_score long"),
            ["number"], "positive_score", "positive_id", positives)
        near = written(best.withColumnRenamed("rank", "place"))
        again = spark.sparkContext.broadcast((*block, _scores(near, block[0], positives)))
        far = packed.mapInArrow(
            _negatives(again, planes, groups, negatives, low, high),
            "number long, place long, negative_id long, negative_score long")
        part = written(_first(far, ["number", "place"], "negative_score", "negative_id", negatives)
                       .join(near.withColumn("place", F.col("place").cast("long")),
                             ["number", "place"])
                       .join(chosen.where(F.col("block") == i).select(
                           "number", F.col("vec_id").alias("anchor_id")), "number"))
        sent.destroy()
        again.destroy()
        forget(near)
        out = part if out is None else out.unionByName(part)
    forget(packed)
    forget(chosen)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, "
                                     "negative_id long, positive_score long, negative_score long")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                      "negative_score")


def _block(anchors: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, keys, labels and integer vectors of one block of anchors."""
    table = anchors.combine_chunks()
    q = table.column("q").chunk(0)
    return (*(table.column(c).to_numpy() for c in ("number", "vec_id", "label")), _matrix(q, dim))


def _scores(near: DataFrame, number: np.ndarray, positives: int) -> np.ndarray:
    """(anchors of the block, positives): the score of each place, LEAST where there is none."""
    found = near.select("number", "place", "positive_score").toArrow()
    out = np.full((len(number), positives), LEAST, np.int64)
    order = np.argsort(number)
    at = order[np.searchsorted(number[order], found.column("number").to_numpy())]
    out[at, found.column("place").to_numpy() - 1] = found.column("positive_score").to_numpy()
    return out


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
         list_inner_product(a.q, c.q)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER (
         PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.alike
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
