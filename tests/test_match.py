import numpy as np
import pytest
from pyspark.sql import functions as F

from vidguard import constants as K
from vidguard.operators import match as M
from vidguard.operators.skew import bucketed_rank, latest_per_key, lookup_join, running_total

DIM = 8


def unit(v):
    return (v / np.linalg.norm(v)).astype(np.float32)


def make(rng, n, prefix, base, gap=0.25):
    out = {}
    for i in range(n):
        vectors = []
        for _ in range(3):
            if rng.random() < gap:
                vectors.append(None)
            elif rng.random() < 0.4:
                vectors.append(base[rng.integers(len(base))])  # copies, so ties occur
            else:
                vectors.append(unit(rng.normal(size=DIM)))
        out[f"{prefix}{i}"] = vectors
    return out


def frame(spark, data, key):
    rows = [(k, *[None if v is None else [float(x) for x in v] for v in vs])
            for k, vs in data.items()]
    return spark.createDataFrame(
        rows, f"{key} string, title_vec array<float>, ocr_vec array<float>, asr_vec array<float>")


def brute_cells(queries, seeds):
    for q, qv in queries.items():
        for i, a in enumerate(qv):
            for s, sv in seeds.items():
                for j, b in enumerate(sv):
                    if a is not None and b is not None:
                        dot = float(np.dot(a.astype(np.float64), b.astype(np.float64)))
                        yield q, s, round(min(1.0, max(0.0, dot)), 10), i, j


def brute_best(cells):
    best = {}
    for q, s, score, i, j in cells:
        if (q, s) not in best or (-score, i, j) < best[q, s]:
            best[q, s] = (-score, i, j)
    return {k: (-a, i, j) for k, (a, i, j) in best.items()}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    base = [unit(rng.normal(size=DIM)) for _ in range(4)]
    queries = make(rng, 40, "q", base)
    queries["blank"] = [None, None, None]
    queries["negative"] = [-base[0], None, None]
    seeds = make(rng, 30, "s", base)
    return queries, seeds, frame(spark, queries, "query_id"), frame(spark, seeds, "seed_id")


def as_dict(hits):
    return {(r["query_id"], r["seed_id"]): (r["score"], r["q_ord"], r["c_ord"])
            for r in hits.collect()}


# one chunk of seeds, two, and one per few seeds
SIZES = [{}, {"broadcast_bytes": 4000}, {"broadcast_bytes": 900}]


@pytest.mark.parametrize("sizes", SIZES)
def test_hits_equal_brute_force(data, sizes):
    queries, seeds, q, s = data
    best = brute_best(brute_cells(queries, seeds))
    got = as_dict(M.match_hits(q.repartition(5), s, **sizes))
    above = {k: v for k, v in best.items() if round(v[0], 4) >= K.TEXT_GATE}
    assert {k: got[k] for k in above} == above
    assert all(got[k] == best[k] for k in got)
    winners = {r["query_id"]: (r["seed_id"], r["score"], r["q_ord"], r["c_ord"])
               for r in M.best_per_query(M.match_hits(q, s, **sizes)).collect()}
    for name in queries:
        mine = [(-v[0], v[1], seed, v[2]) for (k, seed), v in best.items() if k == name]
        if not mine:
            assert name not in winners
            continue
        score, i, seed, j = min(mine)
        assert winners[name] == (seed, -score, i, j)
    assert "blank" not in winners and winners["negative"][1] >= 0.0


@pytest.mark.parametrize("sizes", SIZES)
def test_top_n_and_top_k(data, sizes):
    queries, seeds, q, s = data
    cells = list(brute_cells(queries, seeds))
    best = brute_best(cells)
    want = {}
    for name in queries:
        mine = sorted((-v[0], v[1], seed, v[2]) for (k, seed), v in best.items() if k == name)
        want.update({(name, seed): (-a, i, j) for a, i, seed, j in mine[:3]})
    assert as_dict(M.match_hits(q, s, top_n=3, **sizes)) == want
    near = []
    for name in queries:
        for medium in range(3):
            mine = sorted((-sc, seed, j) for k, seed, sc, i, j in cells
                          if k == name and i == medium)
            near += [(name, seed, -a, medium, j) for a, seed, j in mine[:5]]
    assert as_dict(M.search_top_k(q, s, 5, **sizes)) == brute_best(near)


def test_no_seeds(data, spark):
    q = data[2]
    assert M.match_hits(q, frame(spark, {}, "seed_id")).count() == 0


def test_tags(spark, data):
    _, _, q, s = data
    for r in M.tag_pairs(M.match_hits(q, s)).collect():
        assert r["is_cross_medium"] == (r["q_medium"] != r["c_medium"])
        assert r["medium_transition"] == f"{r['c_medium']}->{r['q_medium']}"
        assert r["text_score"] == round(r["score"], 4)


def test_bucketed_rank_and_running_total(spark):
    # key a holds most rows
    df = spark.range(2000).select(
        F.when(F.col("id") % 10 < 8, "a").otherwise("b").alias("k"), "id",
        (F.col("id") * 7919 % 997).alias("v"),
    ).withColumn("bucket", F.floor(F.col("v") / 100))
    order = [F.col("v"), F.col("id")]
    ranked = bucketed_rank(df, ["k"], "bucket", order, "rank").collect()
    totals = {(r["k"], r["id"]): r["t"] for r in
              running_total(df, ["k"], "bucket", order, "v", "t").collect()}
    for key in "ab":
        mine = sorted((r for r in ranked if r["k"] == key), key=lambda r: (r["v"], r["id"]))
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        total = 0
        for r in mine:
            total += r["v"]
            assert totals[key, r["id"]] == total


def test_bucketed_rank_of_ties(spark):
    """One key, all scores equal: order falls to the keys that follow, part by part."""
    df = spark.range(3000).select(
        F.lit("hot").alias("k"), F.lit(0).alias("bucket"), (F.col("id") % 3).alias("m"),
        F.format_string("s%05d", F.col("id") * 7919 % 3001).alias("s"))
    df = df.withColumn("lead", F.substring("s", 1, 3))
    order = [F.col("m"), F.col("s")]
    rows = bucketed_rank(df, ["k"], "bucket", order, "rank", parts=["m", "lead"]).collect()
    want = sorted((r["m"], r["s"]) for r in rows)
    assert [(r["m"], r["s"]) for r in sorted(rows, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in rows) == list(range(1, 3001))


def test_lookup_join_keeps_all_rows(spark):
    left = spark.range(500).select(
        F.col("id").cast("string").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id"))
        .alias("key"))
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("zzz", 3)], "key string, x int")
    out = {r["row"]: (r["key"], r["x"]) for r in lookup_join(left, right, "key", "row").collect()}
    assert len(out) == 500
    for i in range(500):
        key = "hot" if i % 3 == 0 else f"k{i}" if i % 3 == 1 else None
        assert out[str(i)] == (key, {"hot": 1, "k1": 2}.get(key))


def test_latest_per_key_hot(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), "id", (F.col("id") * 3).alias("x"))
    assert [tuple(r) for r in latest_per_key(df, ["k"], ["id"]).collect()] == [("hot", 999, 2997)]


@pytest.mark.parametrize("kernel", ["dense", "inverted"])
@pytest.mark.parametrize("sizes", SIZES)
def test_summary_counts_the_hits(data, spark, sizes, kernel):
    queries, seeds, q, s = data
    weights = spark.createDataFrame([(k, 1 + i % 4) for i, k in enumerate(seeds)],
                                    "seed_id string, members long")
    best = brute_best(brute_cells(queries, seeds))
    got = {r["query_id"]: r for r in M.match_summary(
        q.repartition(3), s.join(weights, "seed_id"), kernel=kernel, **sizes).collect()}
    members = {r["seed_id"]: r["members"] for r in weights.collect()}
    for name in queries:
        mine = {seed: v for (k, seed), v in best.items() if k == name}
        if not mine:
            assert name not in got
            continue
        above = [seed for seed, v in mine.items() if round(v[0], 4) >= K.TEXT_GATE]
        first = min((-v[0], v[1], seed, v[2]) for seed, v in mine.items())
        r = got[name]
        assert (r["n_links"], r["n_candidates"]) == (len(above), sum(members[x] for x in above))
        assert (-r["score"], r["q_ord"], r["seed_id"], r["c_ord"]) == first


def test_scores_beside_the_gate_are_counted_exactly(spark):
    """Products nearer to the gate than single precision can tell."""
    gate = K.TEXT_GATE - 0.00005
    near = [gate + d for d in (-2e-7, -1e-8, 1e-8, 2e-7)]
    seeds = spark.createDataFrame(
        [(f"s{i}", [x, (1 - x * x) ** 0.5], None, None) for i, x in enumerate(near)],
        "seed_id string, title_vec array<double>, ocr_vec array<double>, asr_vec array<double>")
    queries = spark.createDataFrame(
        [("q", [1.0, 0.0], None, None)],
        "query_id string, title_vec array<double>, ocr_vec array<double>, asr_vec array<double>")
    row = M.match_summary(queries, seeds, kernel="dense").first()
    assert (row["n_links"], row["seed_id"]) == (2, "s3")


def test_no_vector_passes_through_the_driver(data, monkeypatch):
    _, _, q, s = data

    def refused(self):
        raise AssertionError("seed vectors were fetched by the driver")

    monkeypatch.setattr(type(s), "toArrow", refused)
    for sizes in SIZES:
        assert M.match_hits(q, s, **sizes).count()
    assert M.search_top_k(q, s, 5).count()


def test_equal_mediums_are_multiplied_once():
    """Blocks hold the different vectors of an id; scores, ties and gaps are those of all nine cells."""
    rng = np.random.default_rng(5)
    base = [unit(np.abs(rng.normal(size=DIM))) for _ in range(4)]
    blocks, data = [], []
    for prefix, n in (("q", 60), ("s", 80)):
        made = make(rng, n, prefix, base, gap=0.4)
        made = {k: [v[0], v[1], v[0] if rng.random() < 0.7 else v[2]] for k, v in made.items()}
        ids = sorted(made)
        mediums = [(np.array([np.zeros(DIM) if made[k][i] is None else made[k][i] for k in ids], np.float64),
                    np.array([made[k][i] is not None for k in ids])) for i in range(3)]
        blocks.append(M._Block(ids, mediums))
        data.append(made)
        different = sum(len({v.tobytes() for v in vs if v is not None}) for vs in made.values())
        assert sum(map(len, blocks[-1].layers.double)) == different < sum(p.sum() for _, p in mediums)
    q, s = blocks
    want = {}
    for a, b, score, i, j in brute_cells(*data):
        if score > want.get((a, b), (-1.0,))[0]:
            want[a, b] = score, i, j
    best, q_ord, c_ord = M._best_cells(q, s)
    near = M._near_best(q, s)
    rows, cols = np.nonzero(best >= 0)
    got = {(q.ids[r], s.ids[c]): (best[r, c], q_ord[r, c], c_ord[r, c]) for r, c in zip(rows, cols)}
    assert got == want and (near >= 0).sum() == len(want)
    assert np.abs(near - best).max() <= M._room(q, s)
    settled = M._settled(q, s, rows, cols)
    assert all((x == y[rows, cols]).all() for x, y in zip(settled, (best, q_ord, c_ord)))
