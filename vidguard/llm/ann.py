"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Each tree splits a bounded sample by the hyperplane between two of its vectors until leaves are
small. Every vector, however many there are, is then dropped down every tree. Vectors get one more
component, sqrt(longest^2 - length^2), so the largest inner product is the nearest neighbour. A query
walks all trees through one priority queue of margins and opens the most promising leaves until they
hold the wanted share of the vectors; candidates are reranked by exact inner products.

Equal vectors are one entry with their smallest ids, which is all that a result can show. Leaves
(large ones in parts) are dealt to buckets of bounded rows, queries to blocks of bounded rows; a
bucket meets a block once and returns only its best entries per query.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written

TREES, LEAF, SAMPLE = 4, 64, 8192
SHARE = 1.5
BUCKET_ROWS, PART_ROWS, QUERY_BLOCK = 16384, 4096, 4096
# queries that one task walks through the forest
WALKS = 256


@dataclass
class Forest:
    """Trees as flat arrays: an inner node has a plane, an offset and two children; a leaf has -1."""

    planes: list[np.ndarray]
    offsets: list[np.ndarray]
    children: list[np.ndarray]
    longest: float

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes all of them as long as the longest."""
        rest = np.maximum(self.longest ** 2 - (x ** 2).sum(axis=1), 0.0)
        return np.hstack([x, np.sqrt(rest)[:, None]])

    def leaves(self, tree: int, lifted: np.ndarray) -> np.ndarray:
        """Leaf (node number) of every vector in a tree."""
        node = np.zeros(len(lifted), np.int64)
        planes, offsets, children = self.planes[tree], self.offsets[tree], self.children[tree]
        while True:
            inner = np.flatnonzero(children[node, 0] >= 0)
            if not len(inner):
                return node
            at = node[inner]
            side = np.einsum("ij,ij->i", planes[at], lifted[inner]) > offsets[at]
            node[inner] = children[at, side.astype(np.int64)]

    def walk(self, query: np.ndarray, held: list[np.ndarray], wanted: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of one priority queue, until they hold ``wanted`` rows."""
        margins = [p @ query - o for p, o in zip(self.planes, self.offsets)]
        queue = [(-np.inf, t, 0) for t in range(len(self.planes))]
        out, have = [], 0.0
        while queue and have < wanted:
            worst, tree, node = heapq.heappop(queue)
            left, right = self.children[tree][node]
            if left < 0:
                out.append((tree, node))
                have += held[tree][node]
                continue
            m = margins[tree][node]
            heapq.heappush(queue, (max(worst, m), tree, int(left)))
            heapq.heappush(queue, (max(worst, -m), tree, int(right)))
        return out


def plant(sample: np.ndarray, longest: float, trees: int = TREES, leaf: int = LEAF,
          seed: int = 11) -> Forest:
    """Forest of a sample. Vectors that no plane separates stay in one leaf."""
    rng = np.random.default_rng(seed)
    forest = Forest([], [], [], longest)
    lifted = forest.lift(sample)
    for _ in range(trees):
        planes, offsets, children = [], [], []

        def grow(rows: np.ndarray) -> int:
            node = len(planes)
            planes.append(np.zeros(lifted.shape[1]))
            offsets.append(0.0)
            children.append([-1, -1])
            if len(rows) <= leaf:
                return node
            a, b = lifted[rng.choice(rows, 2, replace=False)]
            plane = (b - a) / max(float(np.linalg.norm(b - a)), 1e-12)
            along = lifted[rows] @ plane
            cut = float(np.median(along))
            low = along <= cut
            if low.all() or not low.any():
                return node
            planes[node], offsets[node] = plane, cut
            children[node] = [grow(rows[low]), grow(rows[~low])]
            return node

        grow(np.arange(len(lifted)))
        forest.planes.append(np.array(planes))
        forest.offsets.append(np.array(offsets))
        forest.children.append(np.array(children, np.int64))
    return forest


def usable(vector: Column) -> Column:
    """Not null, not all zero, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _stacked(column: pd.Series, dim: int) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else \
        np.empty((0, dim))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding",
            trees: int = TREES, share: float = SHARE, sample_rows: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows found per query, by inner product.

    ``vectors(vec_id, <vector>)``; ``is_query`` selects queries by vec_id. Rows with a null id, and
    unusable vectors (null, zero, null or non-finite parts) take no part; vectors of another length
    than the most frequent one neither. Ties go to the smaller vec_id. Rows that repeat an id and a
    vector count once. The forest is fitted on at most ``sample_rows`` vectors; every row is indexed.
    Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    ids = F.col("vec_id").cast("long")
    rows = vectors.select(ids.alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dim = sizes["dim"]
    rows = rows.where(F.size("v") == dim).distinct()
    # the smallest ids of equal vectors; one more than k, as a query leaves itself out
    order = Window.partitionBy("v").orderBy("vec_id")
    least = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    entries = written(least.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                      .withColumn("entry", F.xxhash64("v")))
    asked = rows.where(is_query)
    forest = _fit(entries, dim, trees, sample_rows)
    sent = vectors.sparkSession.sparkContext.broadcast(forest)  # bounded by the sample

    def dropped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lifted = sent.value.lift(_stacked(pdf["v"], dim))
            for t in range(trees):
                leaf, n = np.unique(sent.value.leaves(t, lifted), return_counts=True)
                yield pd.DataFrame({"tree": t, "leaf": leaf, "n": n})

    # one row per leaf: at most two leaves per sample row and tree
    counted = entries.select("v").mapInPandas(dropped, "tree int, leaf long, n long")
    deal = Deal.of(forest, counted.groupBy("tree", "leaf").agg(F.sum("n").alias("n")).collect())
    dealt = vectors.sparkSession.sparkContext.broadcast(deal)

    def indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lifted = sent.value.lift(_stacked(pdf["v"], dim))
            for t in range(trees):
                leaf = sent.value.leaves(t, lifted)
                part = pdf["entry"].to_numpy() % dealt.value.parts[t][leaf]
                yield pd.DataFrame({"bucket": dealt.value.bucket(t, leaf, part), "code": leaf << 8 | t,
                                    "entry": pdf["entry"], "ids": pdf["ids"], "v": pdf["v"]})

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for q, v, lifted in zip(pdf["entry"], pdf["v"], sent.value.lift(_stacked(pdf["v"], dim))):
                codes = dealt.value.codes(sent.value.walk(lifted, dealt.value.rows,
                                                          share * dealt.value.total))
                yield pd.DataFrame({"bucket": list(codes), "query": q, "v": [v] * len(codes),
                                    "codes": list(codes.values())})

    questions = asked.select("v").distinct().withColumn("entry", F.xxhash64("v"))
    n_questions = questions.count()
    blocks = max(1, -(-n_questions // QUERY_BLOCK))
    block = F.pmod("query", F.lit(blocks))
    # a numbered repartition: adaptive execution would put small rows of long walks into one task
    walkers = max(1, -(-n_questions // WALKS))
    visits = questions.repartition(walkers, "entry").mapInPandas(
        walked, "bucket long, query long, v array<double>, codes array<long>").withColumn(
        "block", block)
    index = entries.mapInPandas(
        indexed, "bucket long, code long, entry long, ids array<long>, v array<double>").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def search(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return best_of_bucket(points, queries, dim, k + 1, trees)

    found = index.groupBy("bucket", "block").cogroup(visits.groupBy("bucket", "block")).applyInPandas(
        search, "query long, entry long, ids array<long>, score double")
    top = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    entries_of = found.dropDuplicates(["query", "entry"]).withColumn(
        "_n", F.row_number().over(top)).where(F.col("_n") <= k + 1)
    named = asked.select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("query"))
    rows_of = entries_of.groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    pairs = named.join(rows_of, "query").select("query_id", F.explode("found").alias("f")).select(
        "query_id", "f.score", F.explode("f.ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


@dataclass
class Deal:
    """Rows and parts of every leaf, and the bucket of every part."""

    rows: list[np.ndarray]
    parts: list[np.ndarray]
    buckets: int
    total: int

    @classmethod
    def of(cls, forest: Forest, counted: list) -> "Deal":
        rows = [np.zeros(len(c), np.int64) for c in forest.children]
        for r in counted:
            rows[r["tree"]][r["leaf"]] = r["n"]
        parts = [np.maximum(1, -(-n // PART_ROWS)) for n in rows]
        return cls(rows, parts, int(max(1, -(-sum(n.sum() for n in rows) // BUCKET_ROWS))),
                   int(rows[0].sum()))

    def bucket(self, tree: int, leaf: np.ndarray, part: np.ndarray) -> np.ndarray:
        # neighbouring leaves (in walking order) share a bucket as far as it goes
        start = np.cumsum(self.rows[tree]) - self.rows[tree]
        before = start[leaf] + self.total * tree + part * PART_ROWS
        return before // BUCKET_ROWS % self.buckets

    def codes(self, path: list[tuple[int, int]]) -> dict[int, list[int]]:
        """Leaves of a walk by the buckets that hold a part of them."""
        out: dict[int, list[int]] = {}
        for tree, leaf in path:
            parts = np.arange(self.parts[tree][leaf])
            for b in set(self.bucket(tree, np.full(len(parts), leaf), parts).tolist()):
                out.setdefault(b, []).append(int(leaf) << 8 | tree)
        return out


def best_of_bucket(points: pd.DataFrame, queries: pd.DataFrame, dim: int, most: int,
                   trees: int) -> pd.DataFrame:
    """The ``most`` best entries of a bucket per query, among the leaves that the query opens."""
    out = []
    if len(points) and len(queries):
        points = points.sort_values("code", ignore_index=True)
        x, q = _stacked(points["v"], dim), _stacked(queries["v"], dim)
        entry = points["entry"].to_numpy()
        first = np.array([ids[0] for ids in points["ids"]], np.int64)
        codes, starts = np.unique(points["code"].to_numpy(), return_index=True)
        ends = np.append(starts[1:], len(points))
        place = {c: i for i, c in enumerate(codes.tolist())}
        for row, (query, opened) in enumerate(zip(queries["query"], queries["codes"])):
            open_ = [place[c] for c in opened if c in place]
            if not open_:
                continue
            at = np.concatenate([np.arange(starts[i], ends[i]) for i in open_])
            near = x[at] @ q[row]
            if len(at) > most:
                # an entry may stand once per tree in a bucket
                keep = min(len(at), most * trees)
                at = at[near >= np.partition(near, len(at) - keep)[len(at) - keep] - 1e-9]
            _, one = np.unique(entry[at], return_index=True)
            at = at[one]
            score = np.einsum("ij,j->i", x[at], q[row])
            best = np.lexsort((first[at], -score))[:most]
            out.append(pd.DataFrame({"query": query, "entry": entry[at[best]], "ids": list(
                points["ids"].to_numpy()[at[best]]), "score": score[best]}))
    return pd.concat(out) if out else pd.DataFrame(
        {"query": [], "entry": [], "ids": [], "score": []}).astype({"query": "int64", "entry": "int64"})


def _fit(entries: DataFrame, dim: int, trees: int, rows: int) -> Forest:
    """Forest of the ``rows`` entries of smallest hash, with the length of the longest vector."""
    longest = entries.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    chosen = entries.orderBy("entry").limit(rows).select("v").toPandas()["v"]
    return plant(_stacked(chosen, dim), float(np.sqrt(longest)), trees)
