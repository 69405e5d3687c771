"""The moderation tables, derived from the given ones with whole tables and whole texts.

A document is an upload. Missing feeds, missing values, bad values, evaded texts and repeated
ingests follow from a document's language, source and length, so they grow with the data.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import augment as A
from ..operators import classify, gold, infer, silver, split
from ..operators import match as M
from ..sources.shared import written

NO_OCR_TEXT = ("src3", "src11", "src17")
MISREAD_OCR = ("src2", "src6", "src9", "src15")
NO_ASR_TEXT = ("src5", "src12", "src19")
NOISE_ASR = ("src7",)
LEET_ASR = ("src14", "src16")
LEET_TITLE = ("src1", "src4", "src8", "src13")
PLAIN_TITLE = ("src18",)
NO_OCR_LANG = "de"
NO_ASR_SOURCE = "src7"
NO_META_SOURCE = "src12"
TWICE_LANG = "fr"
PLACES = (" Top", "center", "bottom", "LEFT", "right", "corner")
HOME = {"en": "sg ", "fr": "MY", "de": "us", "es": "ID"}
# literal Layer 1 coefficients over scalar features, used where the check needs fixed scores
WEIGHTS = {"title_len": -0.8, "combined_len": 0.6, "has_ocr_text": 0.3, "font_size": 0.9,
           "contrast_level": -0.7, "speech_pace": 0.5, "avg_confidence": 0.8,
           "upload_hour": 0.4, "loc_top": 0.6, "reg_sg": -0.5, "is_animated": 0.35}
INTERCEPT = 0.25
# most labels, of some 40 bytes each, that are sent to all executors
BROADCAST_LABELS = 2_000_000

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
    "benchmark": "item_id long, text string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def spread(df: DataFrame) -> DataFrame:
    """Rows for text work: a scan with fewer pieces than cores is spread over the cores first."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _keys() -> list[Column]:
    date = F.concat(F.lit("2025-0"), (F.col("doc_id") % 6 + 1).cast("string"), F.lit("-01"))
    return [F.concat(F.lit("v"), "doc_id").alias("video_id"), date.alias("snapshot_date")]


def _percent(factor: int) -> Column:
    return ((F.col("doc_id") * factor % 101) / 100.0).cast("string")


def _in(names: tuple[str, ...]) -> Column:
    return F.col("source").isin(*names)


def raw_label(spark: SparkSession, sf: str) -> DataFrame:
    marks = table(spark, sf, "labels").select("doc_id", "toxic")
    # the texts stay where they are while the labels are slim enough to go to them
    docs = spread(documents(spark, sf)).join(
        F.broadcast(marks) if marks.count() <= BROADCAST_LABELS else marks, on="doc_id", how="left")
    text, key = F.col("text"), F.col("doc_id")
    leet = A.leetspeak(text, key)
    title = F.when(_in(LEET_TITLE), leet).when(
        _in(PLAIN_TITLE), F.concat(F.lit("Upload from "), "source")).otherwise(text)
    misread = F.translate(text, "".join(K.MISREAD_CHARS), "".join(K.MISREAD_CHARS.values()))
    ocr = F.when(~_in(NO_OCR_TEXT), F.when(_in(MISREAD_OCR), misread).otherwise(text))
    asr = F.when(~_in(NO_ASR_TEXT), F.when(_in(NOISE_ASR), "!!!").when(_in(LEET_ASR), leet)
                 .otherwise(text))
    return docs.select(
        *_keys(), F.lit(1).alias("ingest_seq"), F.col("source").alias("seed_id"),
        F.when(_in(LEET_TITLE), "leetspeak").otherwise("exact").alias("variant_type"),
        title.alias("title_text"), ocr.alias("ocr_text"), asr.alias("asr_text"),
        F.when(F.col("toxic") == 1, " Harmful").when(F.col("toxic") == 0, "clean").alias("label"),
    )


def raw_ocr(spark: SparkSession, sf: str) -> DataFrame:
    n, i = F.col("n_chars"), F.col("doc_id")
    seq = F.explode(F.when(F.col("lang") == TWICE_LANG, F.array(F.lit(1), F.lit(2)))
                    .otherwise(F.array(F.lit(1))))
    docs = documents(spark, sf).where(F.col("lang") != NO_OCR_LANG).select(
        "doc_id", "n_chars", seq.alias("ingest_seq"))
    places = F.array(*[F.lit(p) for p in PLACES])
    return docs.select(
        *_keys(), "ingest_seq",
        F.when(n % 25 == 0, None).when(n % 25 == 1, "n/a").otherwise(F.concat(
            (8 + i * 7 % 30 + F.col("ingest_seq") - 1).cast("string"), F.lit(".9")))
        .alias("font_size"),
        F.get(places, (i % 7).cast("int")).alias("text_location"),
        F.when(n % 20 == 3, None).when(n % 37 == 5, "NaN").otherwise(_percent(13))
        .alias("contrast_level"),
        _percent(17).alias("text_density"),
        F.when(n % 19 != 0, F.when(i % 2 == 0, "True").otherwise("False")).alias("is_animated"),
        F.when(n % 20 != 7, _percent(29)).alias("ocr_confidence"),
    )


def raw_asr(spark: SparkSession, sf: str) -> DataFrame:
    n, i = F.col("n_chars"), F.col("doc_id")

    def flag(k: int) -> Column:
        return F.when(i % k == 0, "True").otherwise("False")

    return documents(spark, sf).where(F.col("source") != NO_ASR_SOURCE).select(
        *_keys(),
        F.when(n % 25 != 4, (60 + i * 11 % 140).cast("string")).alias("speech_pace"),
        _percent(19).alias("speech_volume"),
        F.when(n % 20 != 11, _percent(31)).alias("avg_confidence"),
        flag(2).alias("has_silence"), flag(3).alias("has_overlap"),
        F.when(n % 23 == 0, "unsure").otherwise(flag(5)).alias("is_distorted"),
    )


def raw_metadata(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        F.col("event_id").alias("doc_id"), "ts", "user_id", "event_type")
    docs = documents(spark, sf).where(F.col("source") != NO_META_SOURCE).select(
        "doc_id", "lang", "n_chars")
    region = F.element_at(F.create_map(*[F.lit(x) for kv in HOME.items() for x in kv]),
                          F.col("lang"))
    shown = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return docs.join(events, on="doc_id", how="left").select(
        *_keys(),
        F.concat(F.lit("user_"), F.col("user_id") % 9).alias("user_id"),
        F.concat(F.lit("device_"), F.col("doc_id") % 8).alias("device_id"),
        F.concat(F.lit("audio_"), F.col("doc_id") % 5).alias("audio_id"),
        F.when(F.col("n_chars") % 11 == 0, "XX").when(F.col("n_chars") % 13 != 0, region)
        .alias("region"),
        F.when(F.col("event_type") == "signup", "not a time")
        .when(F.col("event_type") != "error", shown).alias("uploaded_at"),
    )


RAW = {"label": raw_label, "ocr": raw_ocr, "asr": raw_asr, "metadata": raw_metadata}


def silver_feed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return silver.clean_feed(name, RAW[name](spark, sf))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return gold.feature_store(**{n: silver_feed(spark, sf, n) for n in RAW})


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return gold.label_store(silver_feed(spark, sf, "label"))


def frame(spark: SparkSession, sf: str) -> DataFrame:
    return gold.modeling_frame(features(spark, sf), labels(spark, sf))


def split_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Modelling frame with its split; cut points come from the label store alone."""
    cut = split.split_column(labels(spark, sf))
    return frame(spark, sf).withColumn("split", cut)


def pair_sides(spark: SparkSession, sf: str, *wanted: str) -> DataFrame:
    """Every upload next to its successor, with typed records of both (NULL if a feed lacks it)."""
    sides = documents(spark, sf).select(*_keys(), "doc_id")
    records = {
        "ocr": [*K.OCR_NUMERIC, *K.OCR_BOOL, "text_location"],
        "asr": [*K.ASR_NUMERIC, *K.ASR_BOOL],
        "meta": [*K.EXACT_FIELDS, "uploaded_at"],
    }
    records = {k: v for k, v in records.items() if not wanted or k in wanted}
    for name, fields in records.items():
        feed = gold.one_row_per_video(
            silver_feed(spark, sf, "metadata" if name == "meta" else name))
        sides = sides.join(
            feed.select("video_id", F.struct(*fields).alias(name)), on="video_id", how="left")
    q = sides.select("doc_id", *[F.col(c).alias(f"q_{c}") for c in ("video_id", *records)])
    s = sides.select((F.col("doc_id") - 1).alias("doc_id"),
                     *[F.col(c).alias(f"s_{c}") for c in ("video_id", *records)])
    return q.join(s, on="doc_id")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "embedding")


def _grid(df: DataFrame, key: str, group: Column, ordinal: Column, vec: str) -> DataFrame:
    """Three vectors per key from rows (group, ordinal)."""
    return df.groupBy(group.alias(key)).agg(*[
        F.max(F.when(ordinal == i, F.col(vec))).alias(f"{m}_vec") for i, m in enumerate(K.MEDIUMS)
    ])


def seed_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors, three consecutive ones per seed, mediums rotated on every other seed."""
    i = F.col("vec_id")
    group = F.floor(i / 3).cast("long")
    return _grid(vectors(spark, sf), "seed_id", F.concat(F.lit("s"), group),
                 (i + group % 2) % 3, "embedding")


def query_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors, each blended with the next one by a weight between 0 and 12/13."""
    v = vectors(spark, sf)
    after = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    w = (F.col("vec_id") * 7 % 13) / 13.0
    mixed = v.join(after, on="vec_id", how="left").withColumn("w", w).select(
        "vec_id",
        F.zip_with("embedding", F.coalesce("other", "embedding"), lambda a, b:
                   F.col("w") * a.cast("double") + (1.0 - F.col("w")) * b.cast("double"))
        .alias("mix"),
    )
    length = F.sqrt(F.aggregate("mix", F.lit(0.0), lambda s, x: s + x * x))
    unit = mixed.withColumn("len", length).select(
        "vec_id", F.transform("mix", lambda x: (x / F.col("len")).cast("float")).alias("unit"))
    i = F.col("vec_id")
    return _grid(unit, "query_id", F.concat(F.lit("q"), F.floor(i / 3).cast("long")), i % 3, "unit")


def vector_hits(spark: SparkSession, sf: str) -> DataFrame:
    return M.match_hits(query_vectors(spark, sf), seed_vectors(spark, sf))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Events as logged predictions."""
    harmful = ~F.col("event_type").isin("error", "signup")
    k = F.col("event_id") * 37 % 1001
    score = F.when(F.floor(F.col("event_id") / 500) % 2 == 0, k / 1000.0).otherwise(
        k * k / 1000000.0)
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.concat(F.lit("v"), "user_id").alias("video_id"),
        F.when(harmful, "harmful").otherwise("clean").alias("layer1_label"),
        F.when(harmful, F.col("event_id") % 2 == 0).alias("is_cross_medium"),
        F.when(harmful & (F.col("event_id") % 3 == 0), k / 1000.0).alias("feature_score"),
        F.when(harmful, score).alias("match_confidence"),
        F.when(harmful, K.REVIEW).otherwise(K.ALLOW).alias("decision"),
        F.when(F.col("event_type") == "purchase", "urgent").when(harmful, "normal")
        .alias("priority"),
        F.when(harmful, F.when(F.col("event_id") % 2 == 0, "cross_medium")
               .when(F.col("event_id") % 3 == 0, "same_asset").otherwise("re_authored"))
        .alias("duplicate_type"),
        F.col("ts").cast("timestamp").alias("created_at"),
    ).withColumn("lane", F.when(F.col("layer1_label") == "harmful", F.when(
        F.col("duplicate_type") == "same_asset", "fast").otherwise("investigation")))


def verdicts(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(v) for v in K.VERDICTS])
    return table(spark, sf, "events").where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("id"), F.concat(F.lit("v"), "user_id").alias("video_id"),
        F.get(names, (F.col("event_id") % 3).cast("int")).alias("verdict"),
        F.concat(F.lit("analyst_"), F.col("event_id") % 4).alias("reviewed_by"),
        F.col("ts").cast("timestamp").alias("reviewed_at"),
    )


def evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with a fixed score and prediction, in three splits."""
    score = (F.col("doc_id") * 41 % 101) / 100.0 + 0.2 * F.col("toxic")
    names = F.array(F.lit("train"), F.lit("val"), F.lit("test"))
    return table(spark, sf, "labels").select(
        F.get(names, (F.col("doc_id") % 3).cast("int")).alias("split"),
        F.col("toxic").alias("label"), score.alias("score"),
        (score > 0.5).cast("int").alias("pred"),
    )


def inference_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every upload with fixed-coefficient Layer 1 output, and the harmful training seeds."""
    base = written(infer.with_text_key(split_frame(spark, sf)))
    stats = classify.collected_stats(classify.scaler_stats(base, list(WEIGHTS)))
    scored = classify.layer1(classify.linear_predict(base, INTERCEPT, WEIGHTS, stats))
    return scored.drop("score", "pred"), infer.seed_corpus(base)
