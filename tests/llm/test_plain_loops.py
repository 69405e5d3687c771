"""Sharding, mixing slots and the regularised leader against plain loops."""

import math

import numpy as np
import xxhash
from pyspark.sql import functions as F

from vidguard.llm import mixing, quality, sharding


def plain_shard(key, weights):
    """The shard of largest weight / -ln(draw), the first of equal ones."""
    best = None
    for shard, w in enumerate(weights):
        h = xxhash.xxh64_intdigest(b"shard", 42)
        h = xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), h)
        h = xxhash.xxh64_intdigest(key.encode(), h)
        draw = ((h >> 12) + 0.5) / 2 ** 52
        if w > 0 and (best is None or w / -math.log(draw) > best[0]):
            best = (w / -math.log(draw), shard)
    return best[1]


def test_shards_equal_a_loop(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 5)) for i in range(-50, 450)] + [(None, "n")],
                                 "doc_id long, text string").repartition(3)
    for r in sharding.shard_documents(docs).collect():
        key = "null:" if r.doc_id is None else f"key:{r.doc_id}"
        assert r.shard == plain_shard(key, [1.0] * 8)
        assert r.grown_shard == plain_shard(key, [1.0] * 9) and r.grown_shard in (r.shard, 8)
    weights = [1.0, 0.0, 2.5]
    for r in sharding.shard_rows(docs, weights).collect():
        assert r.shard == plain_shard("null:" if r.doc_id is None else f"key:{r.doc_id}", weights)


def test_taken_words_are_those_of_the_drawn_blocks(spark):
    """Every word of a source's stream counted by hand, for as often as its block was drawn."""
    docs = spark.createDataFrame([(i, " ".join(["w"] * (i * 13 % 90)), f"s{i % 4}") for i in range(160)],
                                 "doc_id long, text string, source string").repartition(3)
    mix = mixing.Mix(docs, block=16, shards=8)
    times = {}
    for r in mix.slots.collect():
        times[r.number, r.block] = times.get((r.number, r.block), 0) + 1
    taken = {r._row: r.taken for r in mix.uses().collect()}
    rows = mix.documents.collect()
    places = {}
    for r in rows:
        want = 0
        for at in range(r.first, r.first + r.size):
            assert places.setdefault((r.number, at), r._row) == r._row  # streams have no overlap
            want += times.get((r.number, at // 16), 0)
        assert taken.get(r._row, 0) == want
    for number in {r.number for r in rows}:
        size = sum(r.size for r in rows if r.number == number)
        assert {at for n, at in places if n == number} == set(range(size))


def test_regularised_leader_equals_a_loop():
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(60):
        index = np.unique(rng.integers(0, 2 ** quality.BITS, 6))
        rows.append((float(rng.random() < 0.4), index, rng.random(len(index))))
    rows += [(1.0, rows[0][1], rows[0][2])] * 5
    prior = 0.3
    z, n, bias = {}, {}, math.log(prior / (1 - prior))

    def weight(i):
        if abs(z.get(i, 0)) <= quality.L1:
            return 0.0
        s = math.copysign(1, z[i])
        return -(z[i] - s * quality.L1) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for label, index, value in rows:
            w = [weight(i) for i in index]
            dot = bias + 10 * sum(a * b for a, b in zip(w, value))
            p = 1 / (1 + math.exp(-max(-30, min(30, dot))))
            for i, wi, v in zip(index, w, value):
                g = 10 * (p - label) * v
                sigma = (math.sqrt(n.get(i, 0) + g * g) - math.sqrt(n.get(i, 0))) / quality.ALPHA
                z[i] = z.get(i, 0) + g - sigma * wi
                n[i] = n.get(i, 0) + g * g
    got = quality.ftrl(rows, prior)
    want = np.zeros(2 ** quality.BITS + 1)
    for i in z:
        want[i] = 10 * weight(i)
    want[-1] = bias
    assert np.allclose(got, want, atol=1e-5) and np.count_nonzero(want) > 10
