import random

from pyspark.sql import functions as F

from vidguard import constants as K
from vidguard.functions import numeric as N
from vidguard.functions import rounding, text


def one(spark, expr, **values):
    """Value of an expression over one row of given columns."""
    schema = ", ".join(
        f"{k} {'string' if isinstance(v, str) or v is None else 'double'}"
        for k, v in values.items()) or "z string"
    row = tuple(values.values()) or ("",)
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def test_clean_and_token_counts(spark):
    assert one(spark, text.clean_or_empty(F.col("t")), t="  Hé\tLLO--w0rld!\n") == "h llo w0rld"
    assert one(spark, text.clean_or_empty(F.col("t")), t=None) == ""
    assert one(spark, text.token_count(F.col("t")), t="a b  c") == 4
    assert one(spark, text.token_count(F.col("t")), t="") == 1
    joined = text.combined(F.col("a"), F.col("b"), F.col("c"))
    assert one(spark, joined, a="x", b="", c="y") == "x  y"


def test_casts_never_throw(spark):
    assert one(spark, N.to_int(F.col("t")), t="22.9") == 22
    assert one(spark, N.to_int(F.col("t")), t="n/a") is None
    assert one(spark, N.to_bool(F.col("t")), t="True") is True
    assert one(spark, N.to_bool(F.col("t")), t="unsure") is None
    assert one(spark, N.to_timestamp(F.col("t")), t="not a time") is None
    assert abs(one(spark, N.to_float(F.col("t")).cast("double"), t="0.88") - 0.88) > 1e-9


def test_not_finite(spark):
    for bad in ("NaN", "Infinity", "-Infinity"):
        assert one(spark, N.not_finite(F.col("t").cast("double")), t=bad) is True
    assert one(spark, N.not_finite(F.col("t").cast("double")), t=None) is True
    assert one(spark, N.not_finite(F.col("t").cast("double")), t="0") is False


def test_order_bucket_is_monotone(spark):
    rng = random.Random(5)
    values = sorted(rng.uniform(-10, 10) ** 5 for _ in range(2000))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r["b"] for r in df.select("i", N.order_bucket(F.col("v")).alias("b"))
           .orderBy("i").collect()]
    assert got == sorted(got)


def test_rounding_equals_python(spark):
    rng = random.Random(11)
    values = [k / 100000 for k in range(5, 100000, 10)]  # all decimal ties at four places
    values += [rng.random() for _ in range(5000)] + [0.5565, 0.54995, 1.0, 0.0, 0.00005]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for digits in (2, 3, 4):
        rows = df.select("v", rounding.round_exact(F.col("v"), digits).alias("r")).collect()
        assert all(r["r"] == round(r["v"], digits) for r in rows)


def test_decimal_text_equals_python(spark):
    values = [0.5, 1.0, 0.0003, 0.25, 0.0, 0.1234]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", rounding.decimal_text(F.col("v"), 4).alias("t")).collect()
    assert all(r["t"] == str(r["v"]) for r in rows)


def test_feature_list():
    names = K.numeric_features()
    assert len(names) == len(set(names)) == 35
    assert names[:4] == ["title_len", "combined_len", "has_ocr_text", "has_asr_text"]
    assert not set(names) & set(K.ID_COLUMNS)
