"""Periodic runs of words: maximal stretches that repeat one block of words at least a few times.

A run of period q starts, somewhere inside, a Lyndon word of length q that is the longest Lyndon word at
its place under the word order or under the reversed one. So two candidates a place are enough: the
Lyndon root ends before the next smaller (or next greater) suffix. Each root is extended to both sides by
longest common extensions, read in constant time as string depths of lowest common ancestors: forwards
in the suffix tree of the words, backwards in the tree of the reversed words. Trees are built by
Ukkonen's algorithm; the Euler tour keeps, between consecutive leaves, only its shallowest node, which
decides every query, under a sparse table of minima.

Before that a text is cut where no run can be. In a run of length L every word has an equal word at
distance q <= L / exponent, so a word whose nearest equal word is further away than this share of its
piece is in no run and cuts the piece, and so on until nothing changes. A run never loses a word to
this, and a run of a piece is a run of the text. Trees are built for what is left.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
# words of the texts that are coded and cut together
STEP_WORDS = 500_000
BLANKS = r"[\x20\x09-\x0D]+"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_BLANK_BYTES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


class SuffixTree:
    """Ranks of the suffixes of a list of positive integers, and constant-time common extensions."""

    def __init__(self, symbols: list[int]):
        leaves, low = _tour(*_ukkonen([*symbols, 0]))
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        # level k holds the minima of 2^k consecutive entries
        self.levels = [low]
        step = 1
        while 2 * step <= len(low):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at a and at b, a <> b."""
        ra, rb = self.rank[a], self.rank[b]
        first, last = np.minimum(ra, rb) + 1, np.maximum(ra, rb)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(ra), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] - (1 << k) + 1])
        return out


def _ukkonen(s: list[int]) -> tuple[dict[int, int], list[int], list[int], int]:
    """Edges {node * width + symbol: child}, depths of inner nodes, suffixes of leaves, width.

    ``s`` ends with a symbol that is nowhere else. Leaves appear in the order of their suffixes.
    """
    width = max(s) + 1
    edges: dict[int, int] = {}
    start, stop, link, depth, suffix = [0], [0], [0], [0], [-1]
    n = len(s)
    node = at = length = waiting = leaves = 0
    for i, symbol in enumerate(s):
        made = 0
        waiting += 1
        while waiting:
            if not length:
                at = i
            key = node * width + s[at]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                depth.append(0)
                suffix.append(leaves)
                leaves += 1
                if made:
                    link[made] = node
                    made = 0
            else:
                first = start[child]
                size = stop[child] - first
                if length >= size:
                    at += size
                    length -= size
                    node = child
                    continue
                if s[first + length] == symbol:
                    length += 1
                    if made:
                        link[made] = node
                    break
                split = len(start)
                edges[key] = split
                start += (first, i)
                stop += (first + length, n)
                link += (0, 0)
                depth += (depth[node] + length, 0)
                suffix += (-1, leaves)
                leaves += 1
                first += length
                start[child] = first
                edges[split * width + symbol] = split + 1
                edges[split * width + s[first]] = child
                if made:
                    link[made] = split
                made = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                at = i - waiting + 1
    return edges, depth, suffix, width


def _tour(edges: dict[int, int], depth: list[int], suffix: list[int], width: int
          ) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in tour order, and for each the depth of its ancestor shared with the one before."""
    keys = np.fromiter(edges.keys(), np.int64, len(edges))
    order = np.argsort(keys)
    kids = np.fromiter(edges.values(), np.int64, len(edges))[order]
    parents = keys[order] // width
    first = np.searchsorted(parents, np.arange(len(depth) + 1)).tolist()
    below = np.empty(len(depth), np.int64)
    below[kids] = np.asarray(depth)[parents]
    # a child that is not the first one is marked by its complement
    later = np.ones(len(kids), bool)
    later[np.unique(parents, return_index=True)[1]] = False
    marked = np.where(later, ~kids, kids)[::-1].tolist()
    below_of, total = below.tolist(), len(marked)
    leaves, lows, low = [], [], 0
    stack = [0]
    while stack:
        node = stack.pop()
        if node < 0:
            node = ~node
            low = below_of[node]
        if suffix[node] >= 0:
            leaves.append(suffix[node])
            lows.append(low)
        else:
            stack += marked[total - first[node + 1]:total - first[node]]
    return np.array(leaves), np.array(lows)


def _next_smaller(rank: list[int]) -> list[int]:
    """For every place the next one of smaller rank, the end of the list where there is none."""
    out, stack = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def runs_of(symbols: np.ndarray, least_length: int = LEAST_LENGTH,
            least_exponent: int = LEAST_EXPONENT) -> np.ndarray:
    """(start, length, period) rows of all runs of an integer sequence, by start, then period."""
    n = len(symbols)
    code = (np.unique(symbols, return_inverse=True)[1] + 1).tolist()
    ahead, back = SuffixTree(code), SuffixTree(code[::-1])
    rank = ahead.rank.tolist()
    smaller = np.array(_next_smaller(rank)[:n], np.int64)
    greater = np.array(_next_smaller([-r for r in rank])[:n], np.int64)
    i = np.tile(np.arange(n), 2)
    j = np.concatenate([smaller, greater])
    # the suffix without words is the smallest of all, so only ``greater`` can miss
    i, j = i[j <= n], j[j <= n]
    period = j - i
    right = ahead.extension(i, j)
    left = np.zeros(len(i), np.int64)
    inner = np.flatnonzero(i > 0)
    left[inner] = back.extension(n - i[inner], n - j[inner])
    start, length = i - left, period + left + right
    good = length >= np.maximum(least_length, least_exponent * period)
    found = np.stack([start[good], length[good], period[good]], axis=1)
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def pieces(code: np.ndarray, ends: np.ndarray, least_length: int, least_exponent: int
           ) -> list[tuple[int, int]]:
    """(start, stop) of the stretches of concatenated texts that can hold a run."""
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    order = np.lexsort((code, text))
    gap = np.where((code[order[1:]] == code[order[:-1]]) & (text[order[1:]] == text[order[:-1]]),
                   order[1:] - order[:-1], len(code) + 1)
    near = np.full(len(code), len(code) + 1)
    near[order[1:]] = gap
    near[order[:-1]] = np.minimum(near[order[:-1]], gap)
    # stretches as (start, stop); their words are looked at again until a round cuts nothing
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    stops = ends.astype(np.int64)
    done: list[tuple[int, int]] = []
    while True:
        size = stops - starts
        long = size >= least_length
        starts, stops, size = starts[long], stops[long], size[long]
        if not len(starts):
            return sorted(done)
        owner = np.repeat(np.arange(len(starts)), size)
        at = np.arange(len(owner)) + np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        kept = near[at] * least_exponent <= size[owner]
        whole = np.bincount(owner[~kept], minlength=len(starts)) == 0
        done += zip(starts[whole].tolist(), stops[whole].tolist())
        kept &= ~whole[owner]
        edge = np.flatnonzero(kept)
        if not len(edge):
            return sorted(done)
        fresh = np.concatenate([[True], (np.diff(at[edge]) != 1) | (np.diff(owner[edge]) != 0)])
        begin = np.flatnonzero(fresh)
        starts = at[edge[begin]]
        stops = at[edge[np.concatenate([begin[1:] - 1, [len(edge) - 1]])]] + 1


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _one_step(texts: list[list[bytes]], least_length: int, least_exponent: int
              ) -> Iterator[tuple[np.ndarray, bytes]]:
    """Runs and collapsed text of each list of words."""
    codes = _Codes()
    ends = np.cumsum([len(t) for t in texts])
    code = np.fromiter((codes[w] for t in texts for w in t), np.int64, int(ends[-1]))
    first = np.concatenate([[0], ends[:-1]])
    found: dict[int, list[np.ndarray]] = {}
    for start, stop in pieces(code, ends, least_length, least_exponent):
        runs = runs_of(code[start:stop], least_length, least_exponent)
        text = int(np.searchsorted(ends, start, side="right"))
        found.setdefault(text, []).append(runs + [start - first[text], 0, 0])
    none = np.empty((0, 3), np.int64)
    for i, words in enumerate(texts):
        if i not in found:
            yield none, b" ".join(words)
            continue
        runs = np.concatenate(found[i])
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        drop = np.zeros(len(words) + 1, np.int64)
        np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
        np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
        yield runs, b" ".join([w for w, d in zip(words, np.cumsum(drop).tolist()) if not d])


def _mapper(column: int, least_length: int, least_exponent: int) -> Callable:
    def results(texts: pa.Array) -> Iterator[tuple[np.ndarray, bytes]]:
        step, total = [], 0
        for text in texts:
            words = _split(text.as_py())
            step.append(words)
            total += len(words)
            if total >= STEP_WORDS:
                yield from _one_step(step, least_length, least_exponent)
                step, total = [], 0
        if step:
            yield from _one_step(step, least_length, least_exponent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, rows, collapsed = [0], [], []
            for runs, text in results(batch.column(column)):
                rows.append(runs)
                offsets.append(offsets[-1] + len(runs))
                collapsed.append(text)
            every = np.concatenate([np.empty((0, 3), np.int64), *rows])
            values = pa.StructArray.from_arrays(
                [pa.array(every[:, k]) for k in range(3)], fields=list(_RUN))
            kept = [c for i, c in enumerate(batch.columns) if i != column]
            names = [n for i, n in enumerate(batch.schema.names) if i != column]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
                 pa.array(collapsed, pa.binary())], names=[*names, "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",),
                  least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """``keep`` columns, runs and collapsed of every row of ``docs(text)``.

    ``runs`` lists (start, length, period) of every run of at least ``least_length`` words and
    ``least_exponent`` periods, by start, then period; ``collapsed`` is the text without the words that
    repeat a run's first period, words joined by one space.

    A word is ``[^\\x20\\x09-\\x0D]+``, compared as it is. Null, empty and blank texts have no runs and
    an empty ``collapsed``; rows are independent, so repeated rows and null ids give a row each. A text
    is worked on whole, whatever its length. Other columns are ignored; ``keep`` columns may not be
    named runs or collapsed. An empty table gives no rows.
    """
    given = docs.select(*keep, F.col("text").alias("__text"))
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("runs", T.ArrayType(
        T.StructType([T.StructField(f.name, T.LongType()) for f in _RUN]))),
        T.StructField("collapsed", T.BinaryType())])
    out = given.mapInArrow(_mapper(len(keep), least_length, least_exponent), schema)
    return out.withColumn("collapsed", F.decode("collapsed", "UTF-8"))


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """doc_id and text; one text in ten (by the crc32 of its id) repeats a stretch of itself to its end.

    h = crc32(doc_id), g = h div 10, a = g % n for n words, p = 1 + (n - a) div (3 + g % 8): where
    h % 10 = 0, every word i >= a becomes word a + (i - a) % p. A null id changes nothing.
    """
    words = F.filter(F.split("text", BLANKS), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    n = F.greatest(F.size("w"), F.lit(1)).cast("long")
    g = F.floor(F.col("h") / 10)
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    chosen = docs.select("doc_id", "text").withColumn("h", h)
    hit = F.coalesce((F.col("h") % 10 == 0) & F.col("text").isNotNull(), F.lit(False))
    parts = chosen.withColumn("w", F.when(hit, words)).withColumn("n", n).withColumn("g", g).withColumn(
        "a", F.col("g") % F.col("n")).withColumn("p", p)

    def repeated(i: Column) -> Column:
        at = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.get(F.col("w"), at.cast("int"))

    places = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    return parts.select("doc_id", F.when(F.col("w").isNotNull() & (F.size("w") > 0), F.array_join(
        F.transform(places, repeated), " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Counts, the longest run and digests of ``periodic_runs``; of equal lengths the smallest start."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                    r["period"].cast("string")), F.lit("\n"))), "")
    b = F.col("best")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-b["before"]).alias("start"), b["length"].alias("length"), (-b["shorter"]).alias("period"),
        F.floor(b["length"] * 1000 / -b["shorter"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
