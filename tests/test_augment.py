import pytest
from pyspark.sql import functions as F

from vidguard import constants as K
from vidguard.functions import augment as A
from vidguard.functions.hashing import position_uniform, uniform
from vidguard.operators import reposts

TEXTS = ["Learn to see the clear modern vvorld, two by two!", "one two", "I know: no phone here.",
         "Ünï code\nline  two", "", "BALL bell", "Hear, here; THERE! back phrase cliff inn rn"]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "k int, text string")


def run(df, expr):
    return [r["v"] for r in df.select("k", expr.alias("v")).orderBy("k").collect()]


def test_leetspeak(df):
    want = ["".join(K.LEET.get(c.lower(), c) for c in t) for t in TEXTS]
    assert run(df, A.leetspeak(F.col("text"), F.col("k"))) == want
    assert run(df, A.leetspeak(F.col("text"), F.col("k"), 0.0)) == TEXTS
    some = run(df, A.leetspeak(F.col("text"), F.col("k"), 0.5))
    assert all(len(a) == len(t) and all(x in (y, w) for x, y, w in zip(a, t, full))
               for a, t, full in zip(some, TEXTS, want))
    assert some != TEXTS and some != want


def test_symbol_injection(df):
    for text, got in zip(TEXTS, run(df, A.symbol_injection(F.col("text"), F.col("k")))):
        assert got in {"".join(c if c == " " else c + s for c in text) for s in K.SEPARATORS}
    assert run(df, A.symbol_injection(F.col("text"), F.col("k"), 0.0)) == TEXTS


def test_ocr_misread(df):
    def misread(t):
        for a, b in K.MISREAD_PAIRS:
            t = t.replace(a, b, 1)
        return "".join(K.MISREAD_CHARS.get(c, c) for c in t)

    assert run(df, A.ocr_misread(F.col("text"), F.col("k"))) == [misread(t) for t in TEXTS]
    assert run(df, A.ocr_misread(F.col("text"), F.col("k"), 0.0)) == TEXTS


def test_homophones(df):
    got = run(df, A.homophones(F.col("text"), F.col("k")))
    for text, out in zip(TEXTS, got):
        base = " ".join(K.HOMOPHONES.get(w.lower().strip(".,!?;:"), w) for w in text.split())
        f = base.replace("ph", "f", 1)
        assert out in {base, f, base.replace("ck", "k", 1), f.replace("ck", "k", 1)}


def test_structural_and_near_duplicate(df):
    def shuffled(t):
        w = t.split()
        if len(w) > 4:
            return " ".join(w[len(w) // 2:] + w[:len(w) // 2])
        return " ".join(reversed(w))

    assert run(df, A.structural(F.col("text"))) == [shuffled(t) for t in TEXTS]
    for t, out in zip(TEXTS, run(df, A.near_duplicate(F.col("text"), F.col("k")))):
        assert out in {t + "!!!", t + " ...", t.upper(), t.lower()}


def test_variants_do_not_depend_on_partitioning(spark):
    df = spark.range(300).select(
        F.concat(F.lit("row"), "id").alias("k"),
        F.concat(F.lit("some clear text number "), "id").alias("text"))
    first, second = (
        {r["k"]: tuple(r["v"]) for r in frame.select(
            "k", A.variant(F.col("text"), F.col("k"), "title").alias("v")).collect()}
        for frame in (df.repartition(1), df.repartition(7)))
    assert first == second
    kinds = [v[1] for v in first.values()]
    assert set(kinds) == {"exact", "leetspeak", "symbol_injection", "near_duplicate", "structural"}
    assert 60 < kinds.count("exact") < 120


def test_draws_are_spread(spark):
    df = spark.range(20000).select(
        uniform(F.col("id"), "x").alias("u"), position_uniform(F.lit(12345), F.col("id")).alias("p"))
    for c in ("u", "p"):
        r = df.agg(F.avg(c).alias("m"), F.avg((F.col(c) < 0.3).cast("int")).alias("s"),
                   F.min(c).alias("lo"), F.max(c).alias("hi")).first()
        assert abs(r["m"] - 0.5) < 0.02 and abs(r["s"] - 0.3) < 0.02
        assert 0 <= r["lo"] and r["hi"] < 1


def test_gaps_and_reposts(spark):
    df = spark.range(5000).withColumn("v", A.with_gaps(F.lit("x"), F.col("id"), 0.12))
    missing = df.where(F.col("v").isNull()).count() / 5000
    assert abs(missing - 0.12) < 0.02
    seeds = spark.createDataFrame([(1, "a clear text"), (2, "another one")], "id int, text string")
    out = reposts.reposts(seeds, "id", copies=40)
    assert out.count() == 80 and out.select("video_id").distinct().count() == 80
    assert {r["seed_id"] for r in out.collect()} == {"s1", "s2"}


def test_repost_texts_follow_their_type(spark):
    """Every copy's title by its variant type, from the source text alone."""
    texts = {1: "Hello to the big blue sea of two", 2: "one word each", 3: "Bi so"}
    df = spark.createDataFrame(list(texts.items()), "item_id int, text string").repartition(2)
    rows = reposts.reposts(df, "item_id", copies=60).collect()
    assert len({r.video_id for r in rows}) == len(rows) == 180
    both = {**K.LEET, **{k.upper(): v for k, v in K.LEET.items()}}
    seen = set()
    for r in rows:
        source, title = texts[int(r.seed_id[1:])], r.title_text
        seen.add(r.variant_type)
        if r.variant_type == "exact":
            assert title == source
        elif r.variant_type == "leetspeak":
            assert len(title) == len(source)
            assert all(b in (a, both.get(a)) for a, b in zip(source, title))
        elif r.variant_type == "symbol_injection":
            assert any(plain(title, mark, source) for mark in K.SEPARATORS)
        elif r.variant_type == "near_duplicate":
            assert title in (source + "!!!", source + " ...", source.upper(), source.lower())
        else:
            words = source.split()
            half = len(words) // 2
            assert title.split() == (words[half:] + words[:half] if len(words) > 4 else words[::-1])
    assert seen == {"exact", "leetspeak", "symbol_injection", "near_duplicate", "structural"}


def plain(title, mark, source):
    """Whether taking some marks out of the title leaves the source."""
    at = 0
    for c in title:
        if at < len(source) and c == source[at]:
            at += 1
        elif c != mark:
            return False
    return at == len(source)
