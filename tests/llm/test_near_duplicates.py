import random
import re
from collections import Counter, defaultdict

import numpy as np

from vidguard.llm import near_duplicates as N
from vidguard.llm.words import shingle_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    n = min(5, len(w))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute(docs, percent=85):
    sets = {d: shingles(t) for d, t in docs}
    held = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            held[x].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sets.items():
        for e, k in Counter(e for x in s for e in held[x] if e > d).items():
            if 100 * k >= percent * (len(s) + len(sets[e]) - k):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def cloud(n=150, seed=5):
    """Noisy copies of a few texts around the threshold, exact copies, and others."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    bases = [[rng.choice(words) for _ in range(120)] for _ in range(3)]
    docs = []
    for i in range(n):
        t = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            t[rng.randrange(len(t))] = rng.choice(words)
        docs.append((i, " ".join(t)))
    return docs


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_classes_equal_brute_force(spark):
    docs = cloud()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert got(N.near_duplicate_classes(df)) == brute(docs)
    assert got(N.near_duplicate_classes(df, percent=80)) == brute(docs, 80)


def test_chunks_of_a_large_cell_lose_no_link(spark):
    docs = cloud(80, 6)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(N.near_duplicate_classes(df, chunk=16)) == brute(docs)


def test_estimate_is_corrected_for_collisions():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    for share in (0.0, 0.5, 0.9):
        other = base.copy()
        other[int(share * 400):] = rng.integers(0, 2**63, 400 - int(share * 400), dtype=np.uint64)
        true = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
        packed = N.pack(np.stack([N.minima(np.unique(base)), N.minima(np.unique(other))]))
        assert abs(float(N.estimate(packed[0], packed[1:])[0]) - true) < 0.16


def test_shingles_are_words_of_ascii_case_and_space():
    assert len(shingle_set("a B c d e f")) == 2 and len(shingle_set("a b")) == 1
    assert (shingle_set("A b") == shingle_set("a\x0bB")).all()
    assert len(shingle_set(None)) == len(shingle_set(" \n")) == 0
    assert not set(shingle_set("a\xa0b c d e f")) & set(shingle_set("a b c d e f"))


def test_odd_rows(odd_docs, no_docs):
    rows = N.near_duplicate_classes(odd_docs).collect()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert len(rows) == 13 and all(r["kept"] for r in rows if r["doc_id"] is None)
    assert by[2]["component_id"] == 1 and not by[2]["kept"] and by[1]["kept"]
    assert by[6]["component_id"] == 5 and by[8]["component_id"] == 7
    assert by[3]["kept"] and by[9]["kept"] and by[3]["n_shingles"] == by[4]["n_shingles"] == 0
    assert N.near_duplicate_classes(no_docs).count() == 0
    kept = N.without_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 3, 4, 5, 7, 9, None}


def test_stage_keeps_one_row_of_each_class_of_texts(spark):
    """Other texts under a repeated id live on; exact copies under one id or without an id go."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(3, a, "x"), (7, a + " end", "x"), (7, b, "x"), (9, b + " end", "y"), (5, c, "x"),
            (5, c, "y"), (5, c + " end", "x"), (None, d, "x"), (None, d, "y"), (None, a, "x"),
            (4, None, "x"), (4, None, "x"), (None, " ", "x"), (8, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    kept = N.without_duplicates(df).collect()
    alive = sorted((r["doc_id"] or 0, (r["text"] or "")[:2]) for r in kept)
    assert alive == sorted([(3, "a0"), (7, "b0"), (5, "c0"), (0, "d0"), (4, ""), (4, ""), (0, " "),
                            (8, "")])
    assert all((r["doc_id"], r["text"], r["source"]) in rows for r in kept)
