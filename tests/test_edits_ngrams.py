"""Edit distance with difference runs, and the character n-gram encoder."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from vidguard import constants as K
from vidguard.functions import augment, edits
from vidguard.operators import encode, review
from vidguard.sources.shared import ship_package, written


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    ship_package(spark)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def replay(a, b, runs):
    out, at = "", 0
    for i0, i1, j0, j1 in runs:
        assert i0 >= at and (i0 > at or not out or at == 0 or i0 == at)
        out, at = out + a[at:i0] + b[j0:j1], i1
    return out + a[at:]


def changed(rnd, text, times):
    b = list(text)
    for _ in range(times):
        at, what = rnd.randrange(len(b) + 1), rnd.random()
        if what < 0.3 or not b:
            b.insert(at, rnd.choice("abZ\U0001f600"))
        elif what < 0.6:
            del b[min(at, len(b) - 1)]
        else:
            b[min(at, len(b) - 1)] = rnd.choice("abQ")
    return "".join(b)


@pytest.mark.parametrize("way", ["auto", "columns", "halves"])
def test_distance_and_runs(monkeypatch, way):
    if way != "auto":
        monkeypatch.setattr(edits, "_by_diagonals", lambda *_: None)
    if way == "halves":
        monkeypatch.setattr(edits, "_CELLS", 6)
    rnd = random.Random(4)
    for _ in range(400):
        letters = "abcdefghijklmné\U0001f600"[:rnd.choice([2, 4, 16])]
        a = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        b = changed(rnd, a, rnd.randint(0, 6)) if rnd.random() < 0.6 else "".join(
            rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        n, runs = edits.difference(a, b)
        assert n == levenshtein(a, b) and replay(a, b, runs) == b
        # runs are apart: equal characters lie between two of them
        assert all(x[1] < y[0] and x[3] < y[2] for x, y in zip(runs, runs[1:]))
        assert bool(runs) == (a != b)


def test_a_million_characters():
    rnd = random.Random(9)
    a = "".join(rnd.choice("abcdefgh ") for _ in range(1_000_000))
    b = changed(rnd, a, 400)
    start = time.time()
    n, runs = edits.difference(a, b)
    assert n <= 400 and replay(a, b, runs) == b and time.time() - start < 30


def test_columns(spark):
    rows = [("kitten", "sitting"), (None, "abc"), ("abc", None), (None, None), ("same", "same"),
            ("x" * 5000 + "a" + "y" * 5000, "x" * 5000 + "b" + "y" * 5000), ("né\U0001f600z", "nez")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    out = review.differences(df, "a", "b").orderBy("i")
    got = out.collect()
    assert [r.edit_distance for r in got] == [3, 3, 3, 0, 0, 1, 2]
    assert [tuple(x) for x in got[0].runs] == [
        ("replace", 0, 1, 0, 1), ("replace", 4, 5, 4, 5), ("insert", 6, 6, 6, 7)]
    assert got[0].divergence == 0.4286 and got[3].divergence == 0.0
    both = [F.coalesce(c, F.lit("")) for c in ("a", "b")]
    assert all(r[0] for r in out.select(
        review.replayed(*both, F.col("runs")) == both[1]).collect())


def plain_counts(text, dim, sizes):
    out = np.zeros(dim)
    data = b" " + text.encode() + b" " if text else b""
    for n in sizes:
        for i in range(len(data) - n + 1):
            value = 0
            for byte in data[i:i + n]:
                value = value * encode.GRAM_BASE + byte
            out[value % encode.GRAM_PRIME * encode.GRAM_FACTOR % encode.GRAM_PRIME % dim] += 1
    return out


@pytest.mark.parametrize("window", [1 << 20, 5, 1])
def test_ngrams_equal_a_loop(monkeypatch, window):
    monkeypatch.setattr(encode, "_GRAM_BYTES", window)
    texts = ["", "a", "ab cd", "", "naïve text", "the quick brown fox " * 3]
    for sizes in ((3, 4), (1,), (2, 5)):
        got = encode.char_ngram_encoder(64, sizes)()(texts)
        assert (got == np.stack([plain_counts(t, 64, sizes) for t in texts])).all()


def test_respelt_copies_stay_near(spark):
    """Leetspeak at the rates of the variants: nearer by n-grams than by whole tokens."""
    text = "kill yourself nobody likes someone like this on the board ever again"
    df = written(spark.createDataFrame(
        [(i, text) for i in range(20)], "id int, text string").withColumn(
        "leet", augment.leetspeak(F.col("text"), F.col("id"), 0.3)))

    def near(factory):
        made = encode.encode_column(factory)
        rows = df.select(made("text").alias("a"), made("leet").alias("b")).collect()
        return np.mean([np.dot(r.a, r.b) for r in rows])
    by_ngrams, by_tokens = near(encode.char_ngram_encoder()), near(None)
    assert by_ngrams > by_tokens + 0.05
    wide = encode.embed(df, "text", "v", encode.char_ngram_encoder(16)).first()["v"]
    assert len(wide) == 16 and len(encode.embed(df, "text", "v", encode.char_ngram_encoder())
                                  .first()["v"]) == K.VECTOR_DIM
