"""The registered queries: name -> (Spark query, DuckDB SQL or None)."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import augment as A
from ..functions import numeric as N
from ..functions import routing as R
from ..functions import scoring as S
from ..functions import text as X
from ..functions import vectors as V
from ..operators import classify, drift, encode, evaluate, gold, infer, quality, review, split
from ..operators import match as M
from ..operators import sketches
from ..operators import pairs as P
from ..operators.skew import small_table
from ..plans import incremental
from ..sources import feeds, journal, store
from ..sources.shared import checkpoint_dir, written
from . import sql as Q
from . import tables as T

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        REGISTRY[name] = (fn, None if sql is None else Q.query(sql))
        return fn

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


_NUM = K.numeric_features()


# --- feeds and silver -------------------------------------------------------------------------

@register("snapshot_dates", "SELECT DISTINCT snapshot_date FROM raw_label")
def snapshot_dates(spark, sf):
    return feeds.snapshot_dates(T.raw_label(spark, sf))


@register("snapshot_slice", """
    SELECT video_id, snapshot_date, seed_id, label FROM raw_label
    WHERE snapshot_date = '2025-03-01'""")
def snapshot_slice(spark, sf):
    return feeds.snapshot(T.raw_label(spark, sf), "2025-03-01").select(
        "video_id", "snapshot_date", "seed_id", "label")


@register("feed_row_counts", """
    SELECT 'label' AS feed, snapshot_date, count(*) AS n FROM silver_label GROUP BY ALL
    UNION ALL SELECT 'ocr', snapshot_date, count(*) FROM silver_ocr GROUP BY ALL
    UNION ALL SELECT 'asr', snapshot_date, count(*) FROM silver_asr GROUP BY ALL
    UNION ALL SELECT 'metadata', snapshot_date, count(*) FROM silver_metadata GROUP BY ALL""")
def feed_row_counts(spark, sf):
    out = None
    for name in T.RAW:
        part = quality.row_counts(T.silver_feed(spark, sf, name)).select(
            F.lit(name).alias("feed"), "snapshot_date", "n")
        out = part if out is None else out.unionByName(part)
    return out


@register("feed_class_counts", """
    SELECT label, snapshot_date, count(*) AS n FROM raw_label GROUP BY ALL""")
def feed_class_counts(spark, sf):
    return T.raw_label(spark, sf).groupBy("label", "snapshot_date").agg(
        F.count(F.lit(1)).alias("n"))


@register("clean_text", f"""
    SELECT doc_id AS id, 'document' AS kind, {Q.clean("coalesce(text, '')")} AS cleaned
    FROM documents
    UNION ALL SELECT page_id, 'page', {Q.clean("coalesce(html, '')")} FROM pages
    UNION ALL SELECT conv_id * 1000 + turn, 'turn', {Q.clean("coalesce(text, '')")}
    FROM conversations""")
def clean_text(spark, sf):
    def part(name: str, key: Column, kind: str, text: str) -> DataFrame:
        return T.spread(T.table(spark, sf, name)).select(
            key.alias("id"), F.lit(kind).alias("kind"),
            X.clean_or_empty(F.col(text)).alias("cleaned"))

    return part("documents", F.col("doc_id"), "document", "text").unionByName(
        part("pages", F.col("page_id"), "page", "html")).unionByName(
        part("conversations", F.col("conv_id") * 1000 + F.col("turn"), "turn", "text"))


@register("silver_label", "SELECT * FROM silver_label")
def silver_label(spark, sf):
    return T.silver_feed(spark, sf, "label")


@register("silver_ocr", """
    SELECT * REPLACE (CASE WHEN isnan(contrast_level) THEN -1 ELSE contrast_level::DOUBLE END
      AS contrast_level, text_density::DOUBLE AS text_density,
      ocr_confidence::DOUBLE AS ocr_confidence) FROM silver_ocr""")
def silver_ocr(spark, sf):
    wide = T.silver_feed(spark, sf, "ocr").withColumns({
        c: F.col(c).cast("double") for c in ("contrast_level", "text_density", "ocr_confidence")})
    # NaN does not compare equal to itself
    return wide.withColumn("contrast_level", F.when(F.isnan("contrast_level"), -1.0)
                           .otherwise(F.col("contrast_level")))


@register("silver_asr", """
    SELECT * REPLACE (speech_volume::DOUBLE AS speech_volume,
      avg_confidence::DOUBLE AS avg_confidence) FROM silver_asr""")
def silver_asr(spark, sf):
    return T.silver_feed(spark, sf, "asr").withColumns({
        c: F.col(c).cast("double") for c in ("speech_volume", "avg_confidence")})


@register("silver_metadata", """
    SELECT * REPLACE (strftime(uploaded_at, '%Y-%m-%d %H:%M:%S') AS uploaded_at)
    FROM silver_metadata""")
def silver_metadata(spark, sf):
    return T.silver_feed(spark, sf, "metadata").withColumn(
        "uploaded_at", F.date_format("uploaded_at", "yyyy-MM-dd HH:mm:ss"))


# --- gold -------------------------------------------------------------------------------------

@register("text_features", "SELECT * FROM features_text")
def text_features(spark, sf):
    return gold.text_features(gold.one_row_per_video(T.silver_feed(spark, sf, "label")))


@register("dedupe_latest", """
    SELECT video_id, snapshot_date, font_size, text_location FROM one_ocr""")
def dedupe_latest(spark, sf):
    return gold.one_row_per_video(T.silver_feed(spark, sf, "ocr")).select(
        "video_id", "snapshot_date", "font_size", "text_location")


@register("snapshot_medians", """
    SELECT * FROM medians_ocr JOIN medians_asr USING (snapshot_date)
      JOIN medians_metadata USING (snapshot_date)""")
def snapshot_medians(spark, sf):
    return _medians(spark, sf).withColumnsRenamed({
        f"{c}_median": c for _, cols in _FEEDS for c in cols})


_FEEDS = (("ocr", K.OCR_NUMERIC), ("asr", K.ASR_NUMERIC), ("metadata", K.META_NUMERIC))


def _medians(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    return gold.snapshot_medians([
        (gold.one_row_per_video(T.silver_feed(spark, sf, name), cols), cols)
        for name, cols in _FEEDS if not names or name in names
    ])


def _side(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    one = gold.one_row_per_video(T.silver_feed(spark, sf, name))
    return build(one, small_table(_medians(spark, sf, name)))


@register("sketched_medians", " UNION ALL ".join(
    f"SELECT snapshot_date, '{c}' AS feature, count(*) FILTER (WHERE {c} IS NOT NULL AND NOT isnan({c}) "
    f"AND NOT isinf({c})) AS n, TRUE AS within FROM {'one' if name == 'ocr' else 'silver'}_{name} GROUP BY snapshot_date"
    for name, cols in _FEEDS for c in cols))
def sketched_medians(spark, sf):
    """Sketches of two halves of each feed, merged; whether the median's rank is within the bound."""
    one = {n: written(gold.one_row_per_video(T.silver_feed(spark, sf, n), cols)) for n, cols in _FEEDS}
    early = F.xxhash64("video_id") % 2 == 0
    halves = [sketches.median_sketches([(one[n].where(half), cols) for n, cols in _FEEDS])
              for half in (early, ~early)]
    found = written(sketches.sketched_medians(sketches.merged(*map(written, halves))))
    cells = None
    for n, cols in _FEEDS:
        part = one[n].select("snapshot_date", *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
            "snapshot_date", list(cols), "feature", "value")
        cells = part if cells is None else cells.unionByName(part)
    ranks = cells.where(N.finite(F.col("value"))).join(
        found.select("snapshot_date", "feature", "median"), ["snapshot_date", "feature"]).groupBy(
        "snapshot_date", "feature").agg(
        F.count_if(F.col("value") < F.col("median")).alias("below"),
        F.count_if(F.col("value") <= F.col("median")).alias("upto"))
    off = F.greatest(F.col("below") / F.col("n") - 0.5, 0.5 - F.col("upto") / F.col("n"))
    return found.join(ranks, ["snapshot_date", "feature"], "left").select(
        "snapshot_date", "feature", "n",
        F.coalesce(off <= sketches.RANK_ERROR, F.col("n") == 0).alias("within"))


@register("ocr_features", "SELECT * FROM features_ocr")
def ocr_features(spark, sf):
    return _side(spark, sf, "ocr", gold.ocr_features)


@register("asr_features", "SELECT * FROM features_asr")
def asr_features(spark, sf):
    return _side(spark, sf, "asr", gold.asr_features)


@register("metadata_features", "SELECT * FROM features_metadata")
def metadata_features(spark, sf):
    return _side(spark, sf, "metadata", gold.metadata_features)


@register("feature_store", "SELECT * FROM features")
def feature_store(spark, sf):
    return T.features(spark, sf)


@register("label_store", "SELECT * FROM labels_gold")
def label_store(spark, sf):
    return T.labels(spark, sf)


@register("modeling_frame", "SELECT * FROM frame")
def modeling_frame(spark, sf):
    return T.frame(spark, sf)


@register("finite_repair", """
    SELECT video_id, snapshot_date, CASE WHEN contrast_level IS NULL OR isnan(contrast_level)
        OR isinf(contrast_level) THEN 0 ELSE contrast_level::DOUBLE END AS contrast_level,
      coalesce(font_size, 0)::DOUBLE AS font_size FROM one_ocr""")
def finite_repair(spark, sf):
    one = gold.one_row_per_video(T.silver_feed(spark, sf, "ocr"))
    cols = ["contrast_level", "font_size"]
    return gold.repair_finite(one.select("video_id", "snapshot_date", *cols), cols)


# --- quality, split, reports ------------------------------------------------------------------

_MEDIUM_TEXTS = ("title_text", "ocr_text", "asr_text")


@register("readiness_checks", f"""
    SELECT 'not_empty' AS "check", '*' AS "column", (count(*) = 0)::BIGINT AS violations FROM frame
    UNION ALL SELECT 'unique_key', 'video_id', (count(*) - count(DISTINCT video_id)) FROM frame
    UNION ALL SELECT 'label_domain', 'label', count(*) FILTER (WHERE label NOT IN (0, 1)) FROM frame
    {" ".join(f"UNION ALL SELECT 'finite', '{c}', count(*) FILTER (WHERE {c} IS NULL OR isnan({c})"
              f" OR isinf({c})) FROM frame" for c in _NUM)}
    {" ".join(f"UNION ALL SELECT 'text_present', '{c}', count(*) FILTER (WHERE {c} IS NULL)"
              " FROM frame" for c in K.TEXT_COLUMNS)}""")
def readiness_checks(spark, sf):
    return quality.readiness_checks(_written_frame(spark, sf))


@register("raw_feed_checks", """
    SELECT 'not_empty' AS "check", '*' AS "column", (count(*) = 0)::BIGINT AS violations FROM one
    UNION ALL SELECT 'unique_key', 'video_id', count(*) - count(DISTINCT video_id) FROM one
    UNION ALL SELECT 'label_domain', 'label', count(*) FILTER (
        WHERE label IS NULL OR label NOT IN (0, 1)) FROM one
    UNION ALL SELECT 'finite', 'font_size', count(*) FILTER (WHERE font_size IS NULL) FROM one
    UNION ALL SELECT 'finite', 'contrast_level', count(*) FILTER (
        WHERE contrast_level IS NULL OR isnan(contrast_level)) FROM one
    UNION ALL SELECT 'column_exists', 'speech_pace', 1
    UNION ALL SELECT 'text_present', 'text_location', count(*) FILTER (
        WHERE text_location IS NULL) FROM one""".replace(
    "FROM one", "FROM (SELECT *, ingest_seq - 1 AS label FROM silver_ocr)"))
def raw_feed_checks(spark, sf):
    feed = T.silver_feed(spark, sf, "ocr").withColumn("label", F.col("ingest_seq") - 1)
    return quality.readiness_checks(
        feed, numeric=["font_size", "contrast_level", "speech_pace"], text=["text_location"])


@register("stratified_split", "SELECT video_id, label, split FROM splits")
def stratified_split(spark, sf):
    return split.stratified_split(T.labels(spark, sf)).select("video_id", "label", "split")


@register("class_counts", """
    SELECT split, label, count(*) AS n FROM splits GROUP BY ALL
    UNION ALL SELECT 'all', label, count(*) FROM splits GROUP BY ALL""")
def class_counts(spark, sf):
    return quality.class_counts(split.stratified_split(T.labels(spark, sf)))


@register("imputation_summary", " UNION ALL ".join(
    f"SELECT '{c.removesuffix('_was_missing')}' AS feature, sum({c})::BIGINT AS imputed_count, "
    f"{Q.rnd(f'avg({c})', 4)} AS imputed_rate FROM frame"
    for c in _NUM if c.endswith("_was_missing")))
def imputation_summary(spark, sf):
    return quality.imputation_summary(T.frame(spark, sf))


def _report_sql() -> str:
    flags = [c for c in _NUM if c.endswith("_was_missing")]
    parts = [
        "SELECT 'total_videos' AS metric, '' AS item, count(*)::DOUBLE AS value FROM split_frame",
        "SELECT 'split_size', split, count(*) FROM split_frame GROUP BY ALL",
        "SELECT 'label_overall', label::VARCHAR, count(*) FROM split_frame GROUP BY ALL",
        "SELECT 'label_per_split', split || ':' || label, count(*) FROM split_frame GROUP BY ALL",
        "SELECT 'snapshot', snapshot_date, count(*) FROM split_frame GROUP BY ALL",
        "SELECT 'n_features', '', 46", f"SELECT 'n_numeric_features', '', {len(_NUM)}",
    ]
    for m in ("ocr", "asr"):
        c = f"has_{m}_text"
        parts += [f"SELECT '{m}_text_rows', '', sum({c}) FROM split_frame",
                  f"SELECT '{c}_rate', '', {Q.rnd(f'avg({c})', 4)} FROM split_frame"]
    for c in flags:
        base = c.removesuffix("_was_missing")
        parts += [f"SELECT 'imputed_count', '{base}', sum({c}) FROM split_frame",
                  f"SELECT 'imputed_rate', '{base}', {Q.rnd(f'avg({c})', 4)} FROM split_frame"]
    return " UNION ALL ".join(parts)


@register("quality_report", _report_sql())
def quality_report(spark, sf):
    return quality.quality_report(T.split_frame(spark, sf))


@register("corpus_sample", f"""
    SELECT doc_id, substr(squeezed, 1, {K.SAMPLE_TEXT_LENGTH}) AS text, class FROM (
      SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS squeezed,
        CASE toxic WHEN 1 THEN 'harmful' WHEN 0 THEN 'clean' END AS class
      FROM documents JOIN labels USING (doc_id))
    WHERE squeezed <> '' AND class IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY class ORDER BY md5(doc_id || ':{K.SPLIT_SEED}'),
      doc_id) <= CASE class WHEN 'harmful' THEN 5 ELSE 8 END""")
def corpus_sample(spark, sf):
    labelled = T.documents(spark, sf).join(
        T.table(spark, sf, "labels").select("doc_id", "toxic"), on="doc_id")
    return split.corpus_sample(labelled, "text", "toxic", "doc_id", 5, 8)


# --- vectors and Layer 1 ----------------------------------------------------------------------

def _written_frame(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The modelling frame as jobs find it: written once, then scanned."""
    base = T.frame(spark, sf)
    return written(base.select(*columns) if columns else base)


_CHECKSUM = "list_sum(list_transform(vec, lambda x, i: x * (i % 7 + 1)))"


@register("text_vectors", f"""
    SELECT video_id, ord AS medium_ord, round({_CHECKSUM}, 6) AS checksum,
      len(list_filter(vec, lambda x: x > 0)) AS places
    FROM mediums JOIN text_vectors USING (text)""")
def text_vectors(spark, sf):
    texts = M.medium_texts(gold.text_features(
        gold.one_row_per_video(T.silver_feed(spark, sf, "label"))))
    vec = encode.embed(texts, "text")
    weighted = F.aggregate(
        F.transform("vector", lambda x, i: x.cast("double") * ((i + 1) % 7 + 1)),
        F.lit(0.0), lambda s, x: s + x)
    ord_ = F.array_position(F.array(*[F.lit(m) for m in K.MEDIUMS]), F.col("medium")) - 1
    return vec.select(
        "video_id", ord_.cast("int").alias("medium_ord"), F.round(weighted, 6).alias("checksum"),
        F.size(F.filter("vector", lambda x: x > 0)).cast("long").alias("places"))


_ITEM_TOKENS = f"""
      SELECT id, place, (n / sqrt(sum(n * n) OVER (PARTITION BY id))::DOUBLE)::FLOAT::DOUBLE AS w
      FROM (SELECT id, ('0x' || substr(md5(token), 1, 8))::BIGINT %% {K.VECTOR_DIM} AS place,
              count(*)::DOUBLE AS n
            FROM (SELECT id, unnest(string_split(text, ' ')) AS token FROM %s)
            WHERE token <> '' GROUP BY ALL)"""


def _gram_sql(source: str) -> str:
    """(id, place, n): places of the character n-grams of texts (id, text)."""
    codes = "list_transform(string_split(' ' || text || ' ', ''), lambda c: unicode(c)::BIGINT)"
    grams = [
        f"SELECT id, unnest(list_transform(range(1, len(c) - {n - 2}), lambda i: (("
        + " + ".join(f"c[i + {k}] * {encode.GRAM_BASE ** (n - 1 - k)}" for k in range(n))
        + f") % {encode.GRAM_PRIME}) * {encode.GRAM_FACTOR} % {encode.GRAM_PRIME} % {K.VECTOR_DIM}"
        + f")) AS place FROM (SELECT id, {codes} AS c FROM {source} WHERE text <> '')"
        for n in encode.GRAM_SIZES]
    return ("SELECT id, place, count(*)::DOUBLE AS n FROM (" + " UNION ALL ".join(grams)
            + ") GROUP BY ALL")


def _unit_sql(counts: str) -> str:
    return (f"SELECT id, place, (n / sqrt(sum(n * n) OVER (PARTITION BY id))::DOUBLE)::FLOAT::DOUBLE"
            f" AS w FROM ({counts})")


_CLEANED = f"(SELECT doc_id AS id, {Q.clean('text')} AS text FROM documents)"
_LEET_ITEM = (f"(SELECT item_id AS id, translate({Q.clean('text')}, '{Q.LEET_OLD}', '{Q.LEET_NEW}')"
              f" AS text FROM benchmark)")
_PLAIN_ITEM = f"(SELECT item_id AS id, {Q.clean('text')} AS text FROM benchmark)"


@register("ngram_vectors", f"""
    SELECT d.doc_id, coalesce(round(sum(w * ((place + 1) % 7 + 1)), 6), 0) AS checksum,
      count(place) AS places
    FROM documents d LEFT JOIN ({_unit_sql(_gram_sql(_CLEANED))}) ON id = d.doc_id
    GROUP BY d.doc_id""")
def ngram_vectors(spark, sf):
    docs = T.documents(spark, sf).select("doc_id", X.clean_or_empty(F.col("text")).alias("text"))
    vec = encode.embed(docs, "text", factory=encode.char_ngram_encoder())
    weighted = F.aggregate(
        F.transform("vector", lambda x, i: x.cast("double") * ((i + 1) % 7 + 1)),
        F.lit(0.0), lambda s, x: s + x)
    return vec.select("doc_id", F.round(weighted, 6).alias("checksum"), F.size(
        F.filter("vector", lambda x: x > 0)).cast("long").alias("places"))


@register("leetspeak_cosine", f"""
    SELECT i.item_id, round(least(coalesce(n.c, 0), 1), 6) AS by_ngrams,
      round(least(coalesce(t.c, 0), 1), 6) AS by_tokens
    FROM benchmark i
    LEFT JOIN (SELECT id, sum(a.w * b.w) AS c FROM ({_unit_sql(_gram_sql(_PLAIN_ITEM))}) a
      JOIN ({_unit_sql(_gram_sql(_LEET_ITEM))}) b USING (id, place) GROUP BY id) n ON n.id = item_id
    LEFT JOIN (SELECT id, sum(a.w * b.w) AS c FROM ({_ITEM_TOKENS % _PLAIN_ITEM}) a
      JOIN ({_ITEM_TOKENS % _LEET_ITEM}) b USING (id, place) GROUP BY id) t ON t.id = item_id""")
def leetspeak_cosine(spark, sf):
    text = X.clean_or_empty(F.col("text"))
    items = T.table(spark, sf, "benchmark").select(
        "item_id", text.alias("plain"), A.leetspeak(text, F.col("item_id")).alias("leet"))

    def cosine(factory) -> Column:
        made = encode.encode_column(factory)
        return F.round(V.cosine_of_units(made(F.col("plain")), made(F.col("leet"))), 6)

    return items.select("item_id", cosine(encode.char_ngram_encoder()).alias("by_ngrams"),
                        cosine(None).alias("by_tokens"))


@register("vector_shape_check", """
    SELECT count(*) AS rows, count(*) FILTER (WHERE len(embedding) <> 64 OR embedding IS NULL)
      AS violations FROM embeddings""")
def vector_shape_check(spark, sf):
    return encode.vector_shape_check(T.vectors(spark, sf), "embedding", 64)


@register("model_matrix", f"""
    SELECT video_id, ({K.VECTOR_DIM + len(_NUM)})::INTEGER AS width,
      round({" + ".join(f"{c}::FLOAT::DOUBLE" for c in _NUM)}, 4) AS tail_sum FROM features""")
def model_matrix(spark, sf):
    matrix = encode.model_matrix(encode.embed(T.features(spark, sf)))
    tail = F.slice("x", K.VECTOR_DIM + 1, len(_NUM))
    total = F.aggregate(tail, F.lit(0.0), lambda s, x: s + x.cast("double"))
    return matrix.select("video_id", F.size("x").alias("width"),
                         F.round(total, 4).alias("tail_sum"))


@register("scaler_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round({c}_m, 6) AS mean, round({c}_s::DOUBLE, 6) AS scale "
    "FROM scaler" for c in _NUM))
def scaler_stats(spark, sf):
    return rounded(classify.scaler_stats(T.frame(spark, sf), _NUM), 6, "mean", "scale")


@register("standardised_features", "SELECT video_id, " + ", ".join(
    f"round(({c} - {c}_m) / {c}_s, 6) + 0.0 AS {c}" for c in _NUM) + " FROM frame, scaler")
def standardised_features(spark, sf):
    base = _written_frame(spark, sf, "video_id", *_NUM)
    stats = classify.collected_stats(classify.scaler_stats(base, _NUM))
    # adding 0.0 turns a rounded -0.0 into 0.0
    return classify.standardise(base, stats).select(
        "video_id", *[(F.round(c, 6) + 0.0).alias(c) for c in _NUM])


def _linear(spark: SparkSession, sf: str) -> DataFrame:
    base = _written_frame(spark, sf, "video_id", "label", *T.WEIGHTS)
    stats = classify.collected_stats(classify.scaler_stats(base, list(T.WEIGHTS)))
    return classify.layer1(classify.linear_predict(base, T.INTERCEPT, T.WEIGHTS, stats))


@register("layer1_scores", """
    SELECT video_id, round(score, 6) AS score, pred, layer1_label, harmful_prob FROM layer1""")
def layer1_scores(spark, sf):
    return rounded(_linear(spark, sf), 6, "score").select(
        "video_id", "score", "pred", "layer1_label", "harmful_prob")


@register("layer1_accuracy", """
    SELECT round(avg((pred = label)::INTEGER), 6) AS accuracy FROM layer1""")
def layer1_accuracy(spark, sf):
    return rounded(evaluate.accuracy(_linear(spark, sf)), 6, "accuracy")


@register("attributions", f"""
    SELECT video_id, (row_number() OVER w)::INTEGER AS rank, feature,
      round(contribution, 6) + 0.0 AS contribution
    FROM ({" UNION ALL ".join(
        f"SELECT video_id, '{c}' AS feature, ({w})::DOUBLE * (({c} - {c}_m) / {c}_s)"
        " AS contribution FROM frame, scaler" for c, w in T.WEIGHTS.items())})
    WINDOW w AS (PARTITION BY video_id ORDER BY round(abs(contribution), 9) DESC, feature)
    QUALIFY row_number() OVER w <= {classify.TOP_FEATURES}""")
def attributions(spark, sf):
    base = _written_frame(spark, sf, "video_id", *T.WEIGHTS)
    stats = classify.collected_stats(classify.scaler_stats(base, list(T.WEIGHTS)))
    out = classify.attributions(base, T.WEIGHTS, stats)
    return out.withColumn("contribution", F.round("contribution", 6) + 0.0)


@register("train_layer1", None)
def train_layer1(spark, sf):
    matrix = written(encode.model_matrix(encode.embed(T.split_frame(spark, sf))).select(
        "video_id", "label", "split", "x"))
    model = classify.train(matrix.where(F.col("split") == "train"))
    return evaluate.metrics(classify.predict(model, matrix))


@register("train_certificate", f"""
    SELECT count(*) AS train_rows, {K.VECTOR_DIM + len(_NUM)}::BIGINT AS inputs, TRUE AS optimal
    FROM split_frame WHERE split = 'train'""")
def train_certificate(spark, sf):
    """Whether every derivative of the objective is below 1e-4 at the fitted weights."""
    rows = T.split_frame(spark, sf).where(F.col("split") == "train")
    matrix = written(encode.model_matrix(encode.embed(rows)).select("video_id", "label", "x"))
    model = classify.train(matrix)
    steepest = classify.objective_gradient(model, matrix).agg(
        (F.count(F.lit(1)) - 1).alias("inputs"), (F.max(F.abs("gradient")) < 1e-4).alias("optimal"))
    return matrix.agg(F.count(F.lit(1)).alias("train_rows")).crossJoin(steepest)


@register("model_attributions", None)
def model_attributions(spark, sf):
    """The largest contributions among all inputs of the fitted model, per upload."""
    matrix = written(encode.model_matrix(encode.embed(T.split_frame(spark, sf))).select(
        "video_id", "label", "split", "x"))
    model = classify.train(matrix.where(F.col("split") == "train"))
    names = [f"v{i}" for i in range(K.VECTOR_DIM)] + list(_NUM)
    return classify.explain(model, matrix, names)


# --- evaluation -------------------------------------------------------------------------------

@register("eval_metrics", "SELECT * FROM metrics")
def eval_metrics(spark, sf):
    return evaluate.metrics(T.evaluation(spark, sf))


@register("roc_auc", "SELECT * FROM auc")
def roc_auc(spark, sf):
    return evaluate.roc_auc(T.evaluation(spark, sf))


@register("confusion_matrix", """
    SELECT split, 0 AS label, 0 AS pred, tn AS n FROM confusion
    UNION ALL SELECT split, 0, 1, fp FROM confusion
    UNION ALL SELECT split, 1, 0, fn FROM confusion
    UNION ALL SELECT split, 1, 1, tp FROM confusion""")
def confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(T.evaluation(spark, sf))


def _class_report_sql() -> str:
    def scores(tp: str, fp: str, fn: str) -> list[str]:
        return [Q._ratio(tp, f"({tp} + {fp})"), Q._ratio(tp, f"({tp} + {fn})"),
                Q._ratio(f"2.0::DOUBLE * {tp}", f"(2 * {tp} + {fp} + {fn})")]

    clean, harmful = scores("tn", "fn", "fp"), scores("tp", "fp", "fn")
    n_clean, n_harmful, total = "(tn + fp)", "(tp + fn)", "(tp + fp + fn + tn)"
    acc = Q._ratio("tp + tn", total)
    rows = {
        "clean": (clean, n_clean), "harmful": (harmful, n_harmful), "accuracy": ([acc] * 3, total),
        "macro avg": ([f"(({a}) + ({b})) / 2.0::DOUBLE" for a, b in zip(clean, harmful)], total),
        "weighted avg": ([f"(({a}) * {n_clean} + ({b}) * {n_harmful}) / {total}::DOUBLE"
                          for a, b in zip(clean, harmful)], total),
    }
    return " UNION ALL ".join(
        f"SELECT split, '{name}' AS class, {Q.rnd(p, 4)} AS precision, {Q.rnd(r, 4)} AS recall, "
        f"{Q.rnd(f, 4)} AS f1, {n} AS support FROM confusion"
        for name, ((p, r, f), n) in rows.items())


@register("class_report", _class_report_sql())
def class_report(spark, sf):
    return evaluate.class_report(T.evaluation(spark, sf))


@register("overfit_gaps", f"""
    SELECT metric, train, val, {Q.rnd("train - val", 4)} AS gap,
      train - val > {K.OVERFIT_GAP}::DOUBLE AS overfit FROM (
      SELECT metric, max(value) FILTER (WHERE split = 'train') AS train,
        max(value) FILTER (WHERE split = 'val') AS val
      FROM (SELECT split, unnest(['accuracy', 'f1', 'recall', 'precision', 'roc_auc']) AS metric,
              unnest([accuracy, f1, recall, precision, roc_auc]) AS value FROM metrics)
      GROUP BY metric)""")
def overfit_gaps(spark, sf):
    return evaluate.overfit_gaps(evaluate.metrics(T.evaluation(spark, sf)))


@register("promotion_gate", f"""
    SELECT recall, precision, recall >= {K.MIN_RECALL}::DOUBLE AS passes_recall,
      precision >= {K.MIN_PRECISION}::DOUBLE AS passes_precision,
      recall >= {K.MIN_RECALL}::DOUBLE AND precision >= {K.MIN_PRECISION}::DOUBLE AS promote
    FROM metrics WHERE split = 'val'""")
def promotion_gate(spark, sf):
    return evaluate.promotion_gate(evaluate.metrics(T.evaluation(spark, sf)))


# --- matching on given vectors ----------------------------------------------------------------

@register("best_cell", f"""
    SELECT query_id, seed_id, text_score, q_ord, c_ord FROM grid_best
    WHERE text_score >= {K.TEXT_GATE}::DOUBLE""")
def best_cell(spark, sf):
    hits = M.tag_pairs(T.vector_hits(spark, sf))
    return hits.where(S.above_gate(F.col("text_score"))).select(
        "query_id", "seed_id", "text_score", "q_ord", "c_ord")


@register("ranked_seeds", f"""
    SELECT query_id, rank, seed_id, text_score FROM grid_best WHERE rank <= 5""")
def ranked_seeds(spark, sf):
    from pyspark.sql import Window

    hits = M.tag_pairs(M.match_hits(
        T.query_vectors(spark, sf), T.seed_vectors(spark, sf), top_n=5))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*M.rank_order()))
    return hits.select("query_id", rank.cast("long").alias("rank"), "seed_id", "text_score")


@register("top_k_search", f"""
    SELECT query_id, seed_id, {Q.rnd("score", 4)} AS text_score, q_ord, c_ord FROM (
      SELECT * FROM (SELECT * FROM grid_cells QUALIFY row_number() OVER (
          PARTITION BY query_id, q_ord ORDER BY score DESC, seed_id, c_ord) <= 4)
      QUALIFY row_number() OVER (PARTITION BY query_id, seed_id
        ORDER BY score DESC, q_ord, c_ord) = 1)""")
def top_k_search(spark, sf):
    hits = M.tag_pairs(M.search_top_k(
        T.query_vectors(spark, sf), T.seed_vectors(spark, sf), k=4))
    return hits.select("query_id", "seed_id", "text_score", "q_ord", "c_ord")


@register("grid_match", """
    SELECT query_id, seed_id, text_score, ['title','ocr','asr'][q_ord + 1] AS q_medium,
      ['title','ocr','asr'][c_ord + 1] AS c_medium, q_ord <> c_ord AS is_cross_medium,
      ['title','ocr','asr'][c_ord + 1] || '->' || ['title','ocr','asr'][q_ord + 1]
        AS medium_transition FROM grid_best WHERE rank = 1""")
def grid_match(spark, sf):
    return M.tag_pairs(M.best_per_query(T.vector_hits(spark, sf))).select(
        "query_id", "seed_id", "text_score", "q_medium", "c_medium", "is_cross_medium",
        "medium_transition")


@register("vector_cosine", """
    SELECT a.vec_id, round(least(greatest(list_dot_product(a.embedding::DOUBLE[],
      b.embedding::DOUBLE[]), 0), 1), 6) AS cosine
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def vector_cosine(spark, sf):
    v = T.vectors(spark, sf)
    after = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return v.join(after, on="vec_id").select("vec_id", F.round(V.cosine_of_units(
        F.col("embedding"), F.col("other")), 6).alias("cosine"))


_ITEMS = f"(SELECT 'b' || item_id AS id, {Q.clean('text')} AS text FROM benchmark)"
_TURNS = (f"(SELECT min('c' || conv_id || '-' || turn) AS id, text FROM (SELECT conv_id, turn, "
          f"{Q.clean('text')} AS text FROM conversations) WHERE text <> '' GROUP BY text)")


@register("sparse_threshold_match", f"""
    SELECT query_id, seed_id, {Q.rnd("score", 4)} AS text_score, rank = 1 AS is_best FROM (
      SELECT q.id AS query_id, s.id AS seed_id, coalesce(score, 0.0::DOUBLE) AS score,
        row_number() OVER (PARTITION BY q.id ORDER BY coalesce(score, 0) DESC, s.id) AS rank
      FROM {_ITEMS} q CROSS JOIN {_TURNS} s LEFT JOIN (
        SELECT a.id AS query_id, b.id AS seed_id, round(least(sum(a.w * b.w), 1), 10) AS score
        FROM ({_ITEM_TOKENS % _ITEMS}) a JOIN ({_ITEM_TOKENS % _TURNS}) b USING (place)
        GROUP BY ALL) p ON p.query_id = q.id AND p.seed_id = s.id
      WHERE q.text <> '')
    WHERE rank = 1 OR {Q.rnd("score", 4)} >= {K.TEXT_GATE}::DOUBLE""")
def sparse_threshold_match(spark, sf):
    none = F.lit(None).cast("string")
    blank = {"ocr_text": none, "asr_text": none}
    items = T.table(spark, sf, "benchmark").select(
        F.concat(F.lit("b"), "item_id").alias("query_id"), X.clean(F.col("text")).alias("title_text"))
    turns = T.table(spark, sf, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("seed_id"),
        X.clean(F.col("text")).alias("title_text")).where("title_text <> ''")
    seeds = turns.groupBy("title_text").agg(F.min("seed_id").alias("seed_id"))
    hits = written(M.match_hits(encode.embed_mediums(items.withColumns(blank)),
                                encode.embed_mediums(seeds.withColumns(blank)), kernel="inverted"))
    best = M.best_per_query(hits).select("query_id", "seed_id", F.lit(True).alias("is_best"))
    tagged = M.tag_pairs(hits).join(best, on=["query_id", "seed_id"], how="left").withColumn(
        "is_best", F.coalesce("is_best", F.lit(False)))
    return tagged.where(F.col("is_best") | S.above_gate(F.col("text_score"))).select(
        "query_id", "seed_id", "text_score", "is_best")


# --- matching on texts ------------------------------------------------------------------------

@register("seed_corpus", "SELECT video_id, snapshot_date, label FROM seeds")
def seed_corpus(spark, sf):
    labels = split.stratified_split(T.labels(spark, sf))
    return infer.seed_corpus(labels).select("video_id", "snapshot_date", "label")


@register("medium_texts", """
    SELECT video_id, ['title','ocr','asr'][ord + 1] AS medium, text FROM mediums""")
def medium_texts(spark, sf):
    return M.medium_texts(gold.text_features(
        gold.one_row_per_video(T.silver_feed(spark, sf, "label"))))


def _hits(spark: SparkSession, sf: str, listed: str):
    table, seeds = T.inference_inputs(spark, sf)
    harmful = table.where(F.col("layer1_label") == "harmful")
    hits, groups = infer.group_hits(harmful, seeds, listed=listed)
    return harmful, seeds, hits, groups


def _summary(spark: SparkSession, sf: str):
    """``_hits`` for queries that list no cluster: a row per query text."""
    table, seeds = T.inference_inputs(spark, sf)
    harmful = table.where(F.col("layer1_label") == "harmful")
    summary, groups = infer.group_summary(harmful, seeds)
    return harmful, seeds, summary, groups


@register("no_seed_match", """
    SELECT video_id FROM layer1 WHERE layer1_label = 'harmful'
      AND video_id NOT IN (SELECT video_id FROM ranked)""")
def no_seed_match(spark, sf):
    harmful, _, summary, _ = _summary(spark, sf)
    return infer.no_seed_match(harmful, summary).select("video_id")


@register("no_comparable_text", f"""
    SELECT video_id FROM layer1 WHERE layer1_label = 'harmful' AND video_id NOT IN (
      SELECT video_id FROM mediums WHERE {Q.uni("video_id", "'gap'", "ord")} >= 0.5::DOUBLE)""")
def no_comparable_text(spark, sf):
    """Harmful uploads left without a text after each medium was lost at a rate of one half."""
    table, seeds = T.inference_inputs(spark, sf)
    harmful = table.where(F.col("layer1_label") == "harmful").drop(infer.TEXT_KEY)
    gaps = {f"{m}_text": A.with_gaps(F.col(f"{m}_text"), F.col("video_id"), 0.5, i)
            for i, m in enumerate(K.MEDIUMS)}
    lost = written(infer.with_text_key(harmful.withColumns(gaps)))
    summary, _ = infer.group_summary(lost, seeds)
    return infer.no_seed_match(lost, summary).select("video_id")


@register("candidate_clusters", f"""
    SELECT video_id, rank, seed_id, text_score, 'q.' || q_medium || '<->c.' || c_medium AS pair,
      is_cross_medium, duplicate_type FROM (
        SELECT * EXCLUDE (rank), row_number() OVER (PARTITION BY video_id ORDER BY rank) AS rank
        FROM typed WHERE text_score >= {K.TEXT_GATE}::DOUBLE)""")
def candidate_clusters(spark, sf):
    harmful, seeds, hits, groups = _hits(spark, sf, "members")
    return infer.candidates(harmful, seeds, hits, groups)


_KEYS = """
      SELECT video_id, sha256(concat_ws(chr(10), length(a), length(b), length(c), a, b, c)) AS key
      FROM (SELECT video_id, coalesce(title_text, '') AS a, coalesce(ocr_text, '') AS b,
        coalesce(asr_text, '') AS c FROM split_frame)"""
_LINKS = f"""
      SELECT DISTINCT q.key AS cluster_id, s.rep AS seed_id, s.members, score, text_score, q_ord,
        c_ord, q_medium, c_medium, 'q.' || q_medium || '<->c.' || c_medium AS pair
      FROM ranked JOIN ({_KEYS}) q USING (video_id) JOIN ({_KEYS}) k ON k.video_id = seed_id
      JOIN (SELECT key, min(video_id) AS rep, count(*) AS members FROM seeds JOIN ({_KEYS})
            USING (video_id) GROUP BY key) s ON s.key = k.key
      WHERE text_score >= {K.TEXT_GATE}::DOUBLE"""


@register("cluster_links", f"""
    SELECT cluster_id, row_number() OVER (PARTITION BY cluster_id
        ORDER BY score DESC, q_ord, seed_id, c_ord) AS position, seed_id, members, text_score,
      q_medium, c_medium, pair, q_ord <> c_ord AS is_cross_medium FROM ({_LINKS})""")
def cluster_links(spark, sf):
    return infer.factored_clusters(*_hits(spark, sf, "texts")).links


@register("cluster_counts", f"""
    SELECT cluster_id, n_videos, coalesce(n_links, 0) AS n_links,
      coalesce(n_candidates, 0)::BIGINT AS n_candidates,
      (n_videos * coalesce(n_candidates, 0))::BIGINT AS n_pairs
    FROM (SELECT key AS cluster_id, count(*) AS n_videos FROM layer1 JOIN ({_KEYS}) USING (video_id)
          WHERE layer1_label = 'harmful' GROUP BY key)
      LEFT JOIN (SELECT cluster_id, count(*) AS n_links, sum(members) AS n_candidates
                 FROM ({_LINKS}) GROUP BY cluster_id) USING (cluster_id)""")
def cluster_counts(spark, sf):
    harmful, seeds, summary, groups = _summary(spark, sf)
    return infer.factored_clusters(harmful, seeds, None, groups, summary).counts


@register("cluster_members", f"""
    SELECT 'query' AS side, key AS class_id, video_id FROM layer1 JOIN ({_KEYS}) USING (video_id)
    WHERE layer1_label = 'harmful'
    UNION ALL SELECT 'seed', min(video_id) OVER (PARTITION BY key), video_id
    FROM seeds JOIN ({_KEYS}) USING (video_id)""")
def cluster_members(spark, sf):
    harmful, seeds, summary, groups = _summary(spark, sf)
    found = infer.factored_clusters(harmful, seeds, None, groups, summary)
    return found.queries.select(
        F.lit("query").alias("side"), F.col("cluster_id").alias("class_id"), "video_id").unionByName(
        found.seeds.select(F.lit("seed").alias("side"), F.col("seed_id").alias("class_id"),
                           F.col("member").alias("video_id")))


_RECORD = f"""
    SELECT l.video_id, layer1_label, harmful_prob, b.seed_id AS matched_seed_id,
      'q.' || q_medium || ' <-> c.' || c_medium AS best_pair, is_cross_medium,
      c_medium || '->' || q_medium AS medium_transition, text_score, feature_score,
      metadata_score, match_confidence, duplicate_type,
      CASE WHEN layer1_label = 'harmful' THEN CASE WHEN duplicate_type = 'same_asset' THEN 'fast'
        ELSE 'investigation' END END AS lane,
      CASE WHEN layer1_label = 'clean' THEN '{K.ALLOW}' WHEN b.video_id IS NULL THEN '{K.REVIEW}'
        WHEN match_confidence < {K.ALLOW_BELOW}::DOUBLE THEN '{K.ALLOW}'
        WHEN match_confidence < {K.REVIEW_BELOW}::DOUBLE THEN '{K.REVIEW}'
        WHEN verifier IS NULL OR verifier >= {K.VERIFIER_ALLOW_BELOW}::DOUBLE THEN '{K.REVIEW}'
        ELSE '{K.ALLOW}' END AS decision,
      CASE WHEN layer1_label = 'clean' THEN NULL WHEN b.video_id IS NULL THEN 'normal' ELSE
        coalesce(CASE WHEN match_confidence < {K.ALLOW_BELOW}::DOUBLE THEN NULL
          WHEN match_confidence < {K.REVIEW_BELOW}::DOUBLE OR verifier IS NULL THEN 'normal'
          WHEN verifier >= {K.VERIFIER_URGENT}::DOUBLE THEN 'urgent'
          WHEN verifier >= {K.VERIFIER_ALLOW_BELOW}::DOUBLE THEN 'normal' END,
        CASE WHEN duplicate_type IN ('cross_medium', 're_authored') THEN 'urgent'
          ELSE 'normal' END) END AS priority,
      CASE WHEN match_confidence >= {K.REVIEW_BELOW}::DOUBLE THEN {Q.rnd("verifier", 4)} END
        AS llm_score,
      CASE WHEN layer1_label = 'clean' THEN 'layer1 classified as clean'
        WHEN b.video_id IS NULL THEN 'harmful but no seed match'
        WHEN text_score >= {K.TEXT_GATE}::DOUBLE THEN 'text ' || {Q.dec(Q.rnd("text_score", 3), 3)}
          || ' + metadata lift ' || {Q.dec(Q.rnd(f"{K.METADATA_LIFT}::DOUBLE * metadata_score", 3), 3)}
          || ' -> ' || duplicate_type
        ELSE 'text ' || {Q.dec("text_score", 4)} || ' below gate {K.TEXT_GATE}; no duplicate' END
        AS reasoning,
      coalesce(n, 0) AS n_candidates, coalesce(list_json, '[]') AS candidate_matches
    FROM layer1 l LEFT JOIN (SELECT * FROM typed WHERE rank = 1) b USING (video_id)
      LEFT JOIN (SELECT video_id, count(*) AS n, '[' || string_agg(
          '{{"seed_id":"' || seed_id || '","text_score":' || text_score::VARCHAR || ',"pair":"q.'
          || q_medium || '<->c.' || c_medium || '","is_cross_medium":' || is_cross_medium::VARCHAR
          || ',"duplicate_type":"' || duplicate_type || '"}}', ',' ORDER BY rank) || ']' AS list_json
        FROM typed WHERE text_score >= {K.TEXT_GATE}::DOUBLE GROUP BY video_id) USING (video_id)
      LEFT JOIN (SELECT video_id, CASE doc_id % 5 WHEN 0 THEN 0.9::DOUBLE WHEN 1 THEN 0.6::DOUBLE
          WHEN 2 THEN 0.2::DOUBLE WHEN 3 THEN 0.5::DOUBLE END AS verifier
        FROM (SELECT doc_id, 'v' || doc_id AS video_id FROM documents)) USING (video_id)"""


def replies(spark: SparkSession, sf: str) -> DataFrame:
    """A verifier reply per upload: strong, middling, weak, without a number, unreadable."""
    texts = F.array(*[F.lit(t) for t in (
        '{"harmful_probability": 0.9, "reasoning": "same intent"}',
        '{"harmful_probability": 0.6}', '{"harmful_probability": "0.2", "reasoning": "parody"}',
        '{"reasoning": "unsure"}', "no answer")])
    return T.documents(spark, sf).select(
        F.concat(F.lit("v"), "doc_id").alias("video_id"),
        F.get(texts, (F.col("doc_id") % 5).cast("int")).alias("response"))


@register("factored_records", f"""
    SELECT * EXCLUDE (candidate_matches, key), CASE WHEN n_candidates > 0 THEN key END AS cluster_id
    FROM ({_RECORD}) JOIN ({_KEYS}) USING (video_id)""")
def factored_records(spark, sf):
    table, seeds = T.inference_inputs(spark, sf)
    return infer.inference_records(table, seeds, replies(spark, sf), factored=True)


@register("inference_records", _RECORD)
def inference_records(spark, sf):
    table, seeds = T.inference_inputs(spark, sf)
    return infer.inference_records(table, seeds, replies(spark, sf))


@register("result_distribution", f"""
    SELECT 'decision' AS field, decision AS value, count(*) AS n FROM predictions
    WHERE decision IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 'duplicate_type', duplicate_type, count(*) FROM predictions GROUP BY ALL
    UNION ALL SELECT 'lane', lane, count(*) FROM predictions GROUP BY ALL""")
def result_distribution(spark, sf):
    return review.distribution(T.predictions(spark, sf))


# --- pair scores and routing ------------------------------------------------------------------

_PAIR_KEYS = ("q_video_id", "s_video_id")


@register("ocr_similarity", "SELECT q_video_id, s_video_id, ocr_score FROM pair_scores")
def ocr_similarity(spark, sf):
    return P.with_ocr_similarity(T.pair_sides(spark, sf, "ocr")).select(*_PAIR_KEYS, "ocr_score")


@register("asr_similarity", "SELECT q_video_id, s_video_id, asr_score FROM pair_scores")
def asr_similarity(spark, sf):
    return P.with_asr_similarity(T.pair_sides(spark, sf, "asr")).select(*_PAIR_KEYS, "asr_score")


@register("metadata_similarity", """
    SELECT q_video_id, s_video_id, round(exact_mean, 6) AS exact_mean, temporal, metadata_score
    FROM pair_scores""")
def metadata_similarity(spark, sf):
    scored = P.with_metadata_similarity(T.pair_sides(spark, sf, "meta"), keep_parts=True)
    return rounded(scored, 6, "exact_mean").select(
        *_PAIR_KEYS, "exact_mean", "temporal", "metadata_score")


def _pair_scores(spark: SparkSession, sf: str) -> DataFrame:
    """All scores of the successor pairs, a stand-in text score included."""
    text = F.substring("q_video_id", 2, 20).cast("long") * 53 % 1001 / 1000.0
    pairs = T.pair_sides(spark, sf).withColumn("text_score", text)
    scored = P.with_metadata_similarity(P.with_asr_similarity(P.with_ocr_similarity(pairs)))
    return scored.select(
        *_PAIR_KEYS, "text_score", "ocr_score", "asr_score", "metadata_score",
        (F.col("text_score") * 1000 % 3 < 1).alias("is_cross_medium"))


_PAIR_TEXT = """(SELECT *, text_score * 1000 % 3 < 1 AS is_cross_medium FROM (
    SELECT q_video_id, s_video_id, ocr_score, asr_score, metadata_score,
      substr(q_video_id, 2)::BIGINT * 53 % 1001 / 1000.0::DOUBLE AS text_score FROM pair_scores))"""


def _composite_sql() -> str:
    w = {"text_score": 0.45, "ocr_score": 0.2, "asr_score": 0.2, "metadata_score": 0.15}
    total = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE {v}::DOUBLE END" for c, v in w.items())
    final = " + ".join(f"coalesce({v}::DOUBLE / total * {c}, 0)" for c, v in w.items())
    return f"""
      SELECT q_video_id, s_video_id, {Q.rnd(f"least(1, greatest(0, 0::DOUBLE + {final}))", 4)}
          AS final_score, round(0.45::DOUBLE / total, 6) AS text_weight,
        CASE WHEN concat_ws('; ', high, meta, miss) = '' THEN 'composite'
          ELSE concat_ws('; ', high, meta, miss) END AS reason
      FROM (SELECT *, 0::DOUBLE + {total} AS total,
          CASE WHEN text_score >= 0.9::DOUBLE THEN 'high text similarity' END AS high,
          CASE WHEN metadata_score >= 0.7::DOUBLE THEN 'metadata match' END AS meta,
          CASE WHEN ocr_score IS NULL OR asr_score IS NULL THEN 'missing: ' || concat_ws(', ',
            CASE WHEN ocr_score IS NULL THEN 'ocr' END,
            CASE WHEN asr_score IS NULL THEN 'asr' END) END AS miss FROM {_PAIR_TEXT})"""


@register("composite_score", _composite_sql())
def composite_score(spark, sf):
    return P.with_composite(_pair_scores(spark, sf)).select(
        *_PAIR_KEYS, "final_score", F.round("weights_used.text", 6).alias("text_weight"), "reason")


_SCORED = f"""(SELECT *, CASE WHEN text_score >= {K.TEXT_GATE}::DOUBLE THEN
      CASE WHEN is_cross_medium THEN 'cross_medium'
        WHEN ocr_score >= {K.FEATURE_HIGH}::DOUBLE THEN 'same_asset' ELSE 're_authored' END END
      AS duplicate_type,
    CASE WHEN text_score >= {K.TEXT_GATE}::DOUBLE THEN {Q.rnd(
        f"least(1, text_score + {K.METADATA_LIFT}::DOUBLE * coalesce(metadata_score, 0))", 4)}
      ELSE {Q.rnd("text_score", 4)} END AS match_confidence FROM {_PAIR_TEXT})"""


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return P.with_match_score(_pair_scores(spark, sf), feature="ocr_score")


@register("match_score", f"""
    SELECT q_video_id, s_video_id, match_confidence, duplicate_type,
      CASE WHEN duplicate_type IS NOT NULL THEN CASE duplicate_type WHEN 'same_asset' THEN 'fast'
        ELSE 'investigation' END END AS lane,
      CASE WHEN duplicate_type IS NULL THEN 'text ' || {Q.dec("text_score", 4)}
          || ' below gate {K.TEXT_GATE}; no duplicate'
        ELSE 'text ' || {Q.dec(Q.rnd("text_score", 3), 3)} || ' + metadata lift '
          || {Q.dec(Q.rnd(f"{K.METADATA_LIFT}::DOUBLE * metadata_score", 3), 3)} || ' -> '
          || duplicate_type END AS reasoning
    FROM {_SCORED}""")
def match_score(spark, sf):
    return _scored(spark, sf).select(
        *_PAIR_KEYS, "match_confidence", "duplicate_type", "lane",
        F.col("match_reason").alias("reasoning"))


@register("same_medium_feature", f"""
    SELECT q_video_id, s_video_id, CASE doc_id % 4 WHEN 1 THEN {Q.record(
        "q_ocr", "s_ocr", Q.mean(Q.ocr_terms("q_ocr", "s_ocr", False)))}
      WHEN 2 THEN asr_score END AS feature_score
    FROM (SELECT *, substr(q_video_id, 2)::BIGINT AS doc_id FROM pair_scores)""")
def same_medium_feature(spark, sf):
    which = F.substring("q_video_id", 2, 20).cast("long") % 4
    q_medium = F.when(which == 1, "ocr").when(which == 2, "asr").otherwise("title")
    c_medium = F.when(which == 3, "ocr").otherwise(q_medium)
    tagged = T.pair_sides(spark, sf, "ocr", "asr").withColumns({
        "q_medium": q_medium, "c_medium": c_medium})
    return P.with_feature_score(tagged).select(*_PAIR_KEYS, "feature_score")


@register("score_bands", """
    SELECT id, CASE WHEN match_confidence IS NULL THEN 'not applicable'
      WHEN match_confidence >= 0.6::DOUBLE THEN 'high'
      WHEN match_confidence >= 0.3::DOUBLE THEN 'medium' ELSE 'low' END AS band FROM predictions""")
def score_bands(spark, sf):
    return T.predictions(spark, sf).select(
        "id", S.score_band(F.col("match_confidence")).alias("band"))


_VERIFIER = ("(SELECT *, CASE WHEN id % 7 <> 6 THEN {} END AS verifier FROM predictions "
             "WHERE match_confidence IS NOT NULL)").format(
    "(id * 29 % 101) / 100.0::DOUBLE")


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    verifier = F.when(F.col("id") % 7 != 6, (F.col("id") * 29 % 101) / 100.0)
    return T.predictions(spark, sf).where(F.col("match_confidence").isNotNull()).withColumn(
        "verifier", verifier)


@register("decision_bands", f"""
    SELECT id, CASE WHEN match_confidence < 0.3::DOUBLE THEN 'ALLOW' ELSE 'HUMAN REVIEW' END
        AS decision,
      CASE WHEN match_confidence >= 0.3::DOUBLE THEN 'normal' END AS priority,
      CASE WHEN match_confidence < 0.3::DOUBLE THEN 'match_confidence '
          || printf('%.4f', {Q.rnd("match_confidence", 4)}) || ' below allow threshold 0.3'
        WHEN match_confidence < 0.6::DOUBLE THEN 'match_confidence '
          || printf('%.4f', {Q.rnd("match_confidence", 4)}) || ' in review band'
        ELSE 'verifier unavailable; defaulting to review' END AS note
    FROM predictions WHERE match_confidence IS NOT NULL""")
def decision_bands(spark, sf):
    c, none = F.col("match_confidence"), F.lit(None).cast("double")
    rows = T.predictions(spark, sf).where(c.isNotNull())
    return rows.select(
        "id", R.decision(c, none).alias("decision"), R.verifier_priority(c, none).alias("priority"),
        R.decision_note(c, none, F.lit(None).cast("string")).alias("note"))


@register("verified_decisions", f"""
    SELECT id, CASE WHEN match_confidence < 0.3::DOUBLE THEN 'ALLOW'
        WHEN match_confidence < 0.6::DOUBLE OR verifier IS NULL OR verifier >= 0.5::DOUBLE
        THEN 'HUMAN REVIEW' ELSE 'ALLOW' END AS decision,
      CASE WHEN match_confidence >= 0.6::DOUBLE THEN verifier END AS llm_score,
      coalesce(CASE WHEN match_confidence < 0.3::DOUBLE THEN NULL
          WHEN match_confidence < 0.6::DOUBLE OR verifier IS NULL THEN 'normal'
          WHEN verifier >= 0.7::DOUBLE THEN 'urgent'
          WHEN verifier >= 0.5::DOUBLE THEN 'normal' END,
        CASE WHEN duplicate_type = 'same_asset' THEN 'normal' ELSE 'urgent' END) AS priority
    FROM {_VERIFIER}""")
def verified_decisions(spark, sf):
    c, v = F.col("match_confidence"), F.col("verifier")
    return _judged(spark, sf).select(
        "id", R.decision(c, v).alias("decision"), R.verifier_score(c, v).alias("llm_score"),
        R.final_priority(R.verifier_priority(c, v), F.col("duplicate_type")).alias("priority"))


@register("verifier_prompts", f"""
    SELECT q_video_id, s_video_id, replace(replace(replace('{R._PROMPT.format(
        score="@score@", video="@video@", seed="@seed@").replace("'", "''")}', '@score@',
      printf('%.2f', {Q.rnd("match_confidence", 2)})), '@video@', coalesce(q.text, '')), '@seed@',
      coalesce(s.text, '')) AS prompt
    FROM {_SCORED} p JOIN (SELECT 'v' || doc_id AS q_video_id, text FROM documents) q
      USING (q_video_id) JOIN (SELECT 'v' || doc_id AS s_video_id, text FROM documents) s
      USING (s_video_id) WHERE match_confidence >= {K.REVIEW_BELOW}::DOUBLE""")
def verifier_prompts(spark, sf):
    docs = T.documents(spark, sf).select(F.concat(F.lit("v"), "doc_id").alias("k"), "text")
    # written first: a filter on a computed score would be pushed through all its steps
    rows = written(_scored(spark, sf)).where(R.needs_verifier(F.col("match_confidence")))
    joined = rows.join(docs.toDF("q_video_id", "q_text"), on="q_video_id").join(
        docs.toDF("s_video_id", "s_text"), on="s_video_id")
    return joined.select(*_PAIR_KEYS, R.verifier_prompt(
        F.col("q_text"), F.col("s_text"), F.col("match_confidence")).alias("prompt"))


@register("verifier_replies", """
    SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 0.9::DOUBLE WHEN 1 THEN 0.6::DOUBLE
        WHEN 2 THEN 0.2::DOUBLE WHEN 3 THEN 0.5::DOUBLE END AS score,
      CASE doc_id % 5 WHEN 0 THEN 'same intent' WHEN 1 THEN '' WHEN 2 THEN 'parody'
        WHEN 3 THEN 'unsure' END AS reasoning FROM documents""")
def verifier_replies(spark, sf):
    return replies(spark, sf).select(
        F.substring("video_id", 2, 20).cast("long").alias("doc_id"),
        R.verifier_reply(F.col("response")).alias("r")).select("doc_id", "r.score", "r.reasoning")


# --- log, review, drift -----------------------------------------------------------------------

@register("reviewed_predictions", """
    SELECT id, video_id, reviewer_verdict, reviewed_by,
      strftime(reviewed_at, '%Y-%m-%d %H:%M:%S') AS reviewed_at FROM reviewed""")
def reviewed_predictions(spark, sf):
    rows = review.with_verdicts(T.predictions(spark, sf), T.verdicts(spark, sf))
    return rows.select("id", "video_id", "reviewer_verdict", "reviewed_by",
                       F.date_format("reviewed_at", "yyyy-MM-dd HH:mm:ss").alias("reviewed_at"))


def _own_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("verdict_log", """
    SELECT id, video_id, verdict, reviewed_by, strftime(reviewed_at, '%Y-%m-%d %H:%M:%S')
      AS reviewed_at FROM verdicts""")
def verdict_log(spark, sf):
    """Verdicts after a round through the log; ids are the log's own, so the given one is looked up."""
    given, path = T.verdicts(spark, sf), _own_path(spark, "verdicts")
    journal.append_verdicts(given, path)
    keys = ["video_id", "verdict", "reviewed_by", "reviewed_at"]
    logged = journal.read_verdicts(spark, path).drop("id")
    return given.select("id", *keys).join(logged.distinct(), on=keys).select(
        "id", "video_id", "verdict", "reviewed_by",
        F.date_format("reviewed_at", "yyyy-MM-dd HH:mm:ss").alias("reviewed_at"))


@register("snapshot_round_trip", """
    SELECT video_id, snapshot_date, speech_pace, has_silence FROM silver_asr
    WHERE snapshot_date IN ('2025-02-01', '2025-05-01')""")
def snapshot_round_trip(spark, sf):
    """Silver snapshots written, two of them read back by directory."""
    path = _own_path(spark, "silver-asr")
    store.write_snapshots(T.silver_feed(spark, sf, "asr"), path)
    back = store.read_snapshots(spark, path)
    return back.where(F.col("snapshot_date").isin("2025-02-01", "2025-05-01")).select(
        "video_id", "snapshot_date", "speech_pace", "has_silence")


@register("snapshots_written_and_read", """
    SELECT * REPLACE (speech_volume::DOUBLE AS speech_volume,
      avg_confidence::DOUBLE AS avg_confidence) FROM silver_asr""")
def snapshots_written_and_read(spark, sf):
    """All snapshots and columns of a silver feed, written by directory and read back."""
    path = _own_path(spark, "silver-asr-all")
    feed = T.silver_feed(spark, sf, "asr")
    store.write_snapshots(feed, path)
    back = store.read_snapshots(spark, path, feed.schema)
    return back.withColumns({c: F.col(c).cast("double") for c in ("speech_volume", "avg_confidence")})


@register("incremental_feature_store", "SELECT * FROM features")
def incremental_feature_store(spark, sf):
    """The feature store after a first state from other feeds and an update to the given ones."""
    state = incremental.SnapshotState(spark, _own_path(spark, "incremental"))
    feeds_now = {n: raw(spark, sf) for n, raw in T.RAW.items()}
    turned = F.col("snapshot_date") == "2025-03-01"
    first = {n: df.withColumn("video_id", F.when(turned, F.reverse("video_id")).otherwise(
        F.col("video_id"))) if n in ("label", "asr") else df for n, df in feeds_now.items()}
    state.update(first)
    state.update(feeds_now)
    return state.read(incremental.FEATURES)


@register("review_queue", f"""
    SELECT id, video_id, decision, priority FROM predictions WHERE decision = '{K.REVIEW}'""")
def review_queue(spark, sf):
    return review.review_queue(T.predictions(spark, sf)).select(
        "id", "video_id", "decision", "priority")


@register("review_queue_size", f"""
    SELECT count(*) AS videos_in_queue FROM predictions WHERE decision = '{K.REVIEW}'""")
def review_queue_size(spark, sf):
    return review.queue_size(T.predictions(spark, sf))


def _stored_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Records whose candidate JSON names the next two uploads, one pair string malformed."""
    doc = F.col("doc_id")

    def entry(step: int, pair: Column) -> Column:
        return F.struct(
            F.concat(F.lit("v"), doc + step).alias("seed_id"),
            ((doc * 53 + step) % 1001 / 1000.0).alias("text_score"), pair.alias("pair"),
            (doc % 2 == 0).alias("is_cross_medium"), F.lit("re_authored").alias("duplicate_type"))

    good = F.when(doc % 2 == 0, "q.asr<->c.title").otherwise("q.ocr<->c.ocr")
    broken = F.when(doc % 3 == 0, "asr to title").otherwise("q.title<->c.asr")
    return T.documents(spark, sf).select(
        F.concat(F.lit("v"), doc).alias("video_id"),
        F.to_json(F.array(entry(1, good), entry(2, broken))).alias("candidate_matches"))


_LISTED = """
    SELECT 'v' || doc_id AS video_id, r.rank::INTEGER AS rank, 'v' || (doc_id + rank) AS seed_id,
      (doc_id * 53 + rank) % 1001 / 1000.0::DOUBLE AS text_score,
      CASE WHEN rank = 1 THEN CASE WHEN doc_id % 2 = 0 THEN 'asr' ELSE 'ocr' END ELSE 'title' END
        AS q_medium,
      CASE WHEN rank = 1 THEN CASE WHEN doc_id % 2 = 0 THEN 'title' ELSE 'ocr' END
        ELSE CASE WHEN doc_id % 3 = 0 THEN 'title' ELSE 'asr' END END AS c_medium
    FROM documents, range(1, 3) r(rank)"""


@register("candidate_rows", _LISTED)
def candidate_rows(spark, sf):
    return review.candidate_rows(_stored_candidates(spark, sf)).select(
        "video_id", "rank", "seed_id", "text_score", "q_medium", "c_medium")


def _shown_sql(prefix: str, medium: str) -> str:
    chosen = (f"CASE {medium} WHEN 'title' THEN {prefix}.title_text "
              f"WHEN 'ocr' THEN {prefix}.ocr_text ELSE {prefix}.asr_text END")
    return f"CASE WHEN trim({chosen}) <> '' THEN {chosen} ELSE '—' END"


@register("matched_texts", f"""
    SELECT c.video_id, c.rank, c.seed_id, {_shown_sql("q", "q_medium")} AS query_shown,
      {_shown_sql("s", "c_medium")} AS seed_shown
    FROM ({_LISTED}) c LEFT JOIN silver_label q ON q.video_id = c.video_id
      LEFT JOIN silver_label s ON s.video_id = c.seed_id""")
def matched_texts(spark, sf):
    texts = review.split_texts(T.silver_feed(spark, sf, "label"))
    rows = review.candidate_rows(_stored_candidates(spark, sf))
    return review.matched_texts(rows, texts).select(
        "video_id", "rank", "seed_id", "query_shown", "seed_shown")


@register("split_texts", """
    SELECT video_id, title_text, ocr_text, asr_text FROM silver_label""")
def split_texts(spark, sf):
    rows = gold.text_features(gold.one_row_per_video(T.silver_feed(spark, sf, "label")))
    labels = split.stratified_split(T.labels(spark, sf)).select("video_id", "split")
    table = rows.join(labels, on="video_id")
    train = table.where(F.col("split") == "train")
    # the last part repeats rows of the first, as overlapping split files would
    return review.split_texts(train, table.where(F.col("split") == "val"),
                              table.where(F.col("split") == "test"), train)


@register("text_difference_runs", f"""
    SELECT conv_id, turn, levenshtein(a, b) AS edit_distance, CASE WHEN greatest(length(a),
        length(b)) > 0 THEN {Q.rnd("levenshtein(a, b) / greatest(length(a), length(b))::DOUBLE", 4)}
        ELSE 0 END AS divergence, TRUE AS replayed
    FROM (SELECT x.conv_id, x.turn, {Q.clean("coalesce(x.text, '')")} AS a,
            {Q.clean("coalesce(y.text, '')")} AS b
          FROM conversations x JOIN conversations y
            ON y.conv_id = x.conv_id AND y.turn = x.turn + 1)""")
def text_difference_runs(spark, sf):
    turns = T.spread(T.table(spark, sf, "conversations")).select(
        "conv_id", "turn", X.clean_or_empty(F.col("text")).alias("a"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b"))
    out = review.differences(turns.join(after, on=["conv_id", "turn"]), "a", "b")
    same = review.replayed(F.col("a"), F.col("b"), F.col("runs")) == F.col("b")
    return out.select("conv_id", "turn", "edit_distance", "divergence", same.alias("replayed"))


@register("text_divergence", f"""
    SELECT conv_id, turn, levenshtein(a, b) AS edit_distance, CASE WHEN greatest(length(a),
        length(b)) > 0 THEN {Q.rnd("levenshtein(a, b) / greatest(length(a), length(b))::DOUBLE", 4)}
        ELSE 0 END AS divergence
    FROM (SELECT x.conv_id, x.turn, {Q.clean("coalesce(x.text, '')")} AS a,
            {Q.clean("coalesce(y.text, '')")} AS b
          FROM conversations x JOIN conversations y
            ON y.conv_id = x.conv_id AND y.turn = x.turn + 1)""")
def text_divergence(spark, sf):
    turns = T.spread(T.table(spark, sf, "conversations")).select(
        "conv_id", "turn", X.clean_or_empty(F.col("text")).alias("a"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b"))
    out = review.divergence(turns.join(after, on=["conv_id", "turn"]), "a", "b")
    return out.select("conv_id", "turn", F.col("edit_distance").cast("long").alias("edit_distance"),
                      "divergence")


@register("recent_predictions", f"""
    SELECT id, video_id FROM predictions ORDER BY created_at DESC, id DESC
    LIMIT {K.RECENT_LIMIT}""")
def recent_predictions(spark, sf):
    return drift.recent(T.predictions(spark, sf)).select("id", "video_id")


@register("newest_of_log", f"""
    SELECT id, video_id FROM predictions ORDER BY created_at DESC, id DESC
    LIMIT {K.RECENT_LIMIT}""")
def newest_of_log(spark, sf):
    """The newest predictions of a log written by day, read from its last runs only."""
    path = _own_path(spark, "log-by-day")
    rows = T.predictions(spark, sf).select(
        "id", "video_id", "created_at", F.date_format("created_at", "yyyyMMdd").alias("run_id"))
    journal.append_runs(rows, path)
    newest = journal.read_newest(spark, path, K.RECENT_LIMIT, rows.schema)
    return drift.recent(newest).select("id", "video_id")


def _reviewed(spark: SparkSession, sf: str) -> DataFrame:
    newest = drift.recent(T.predictions(spark, sf))
    return review.with_verdicts(newest, T.verdicts(spark, sf))


@register("drift_windows", 'SELECT id, win AS "window" FROM windowed')
def drift_windows(spark, sf):
    return drift.windows(_reviewed(spark, sf)).select("id", "window")


@register("window_metrics", "SELECT * FROM window_metrics")
def window_metrics(spark, sf):
    return drift.window_metrics(drift.windows(_reviewed(spark, sf)))


@register("score_psi", "SELECT psi FROM psi")
def score_psi(spark, sf):
    return drift.psi(drift.windows(_reviewed(spark, sf)))


@register("drift_alerts", "SELECT * FROM alerts")
def drift_alerts(spark, sf):
    return drift.drift_report(_reviewed(spark, sf))[2]


_METRIC_NAMES = ("n", "harmful_rate", "review_rate", "allow_rate", "urgent_rate",
                 "cross_medium_rate", "mean_match_confidence", "std_match_confidence",
                 "feature_missing_rate", "override_rate")


@register("drift_report", " UNION ALL ".join(
    f"SELECT \"window\" AS section, '{m}' AS item, {m}::DOUBLE AS value FROM window_metrics"
    for m in _METRIC_NAMES) + """
    UNION ALL SELECT 'drift', 'psi', psi FROM psi
    UNION ALL SELECT 'alerts', 'alert_count', count(*) FROM alerts
    UNION ALL SELECT 'alerts', type, value FROM alerts""")
def drift_report(spark, sf):
    return drift.report_rows(*drift.drift_report(_reviewed(spark, sf)))


# --- text augmentation ------------------------------------------------------------------------

def _docs_text(spark: SparkSession, sf: str, **columns: Column) -> DataFrame:
    return T.spread(T.documents(spark, sf)).select(
        "doc_id", *[c.alias(n) for n, c in columns.items()])



def _gated_sql(tag: str, old: str, new: str, rate: float) -> str:
    h = Q.hsh("doc_id", f"'{tag}'", "'0'")
    x = f"(({h} + (i - 1)::BIGINT * 1103515245) % 2147483648)"
    draw = (f"list_transform([{x}], lambda y: xor(y >> 15, y) * 739982445 % 2147483648 "
            "/ 2147483648::DOUBLE)[1]")
    return (f"array_to_string(list_transform(string_split(text, ''), lambda c, i: CASE WHEN {draw} "
            f"< {rate}::DOUBLE THEN translate(c, '{old}', '{new}') ELSE c END), '')")


@register("leetspeak", f"""
    SELECT doc_id, translate(text, '{Q.LEET_OLD}', '{Q.LEET_NEW}') AS every,
      {_gated_sql("leet", Q.LEET_OLD, Q.LEET_NEW, 0.3)} AS some FROM documents""")
def leetspeak(spark, sf):
    text, key = F.col("text"), F.col("doc_id")
    return _docs_text(spark, sf, every=A.leetspeak(text, key), some=A.leetspeak(text, key, 0.3))


_MARKS = "['.', '*', '-', '_', ' ']"


@register("symbol_injection", f"""
    SELECT doc_id, regexp_replace(text, '([^ ])', '\\1' || {_MARKS}[{Q.hsh("doc_id", "'symbol'",
        "'0'")} % 5 + 1], 'g') AS marked FROM documents""".replace(
    "regexp_replace(text, '([^ ])', '\\1' || ", "replace(regexp_replace(text, '([^ ])', "
    "'\\1' || chr(1), 'g'), chr(1), ").replace("% 5 + 1], 'g') AS", "% 5 + 1]) AS"))
def symbol_injection(spark, sf):
    return _docs_text(spark, sf, marked=A.symbol_injection(F.col("text"), F.col("doc_id")))


def _first_sql(expr: str, old: str, new: str) -> str:
    return (f"list_transform([{expr}], lambda t: CASE WHEN instr(t, '{old}') > 0 THEN "
            f"substr(t, 1, instr(t, '{old}') - 1) || '{new}' || substr(t, instr(t, '{old}') + "
            f"{len(old)}) ELSE t END)[1]")


def _misread_sql() -> str:
    expr = "text"
    for old, new in K.MISREAD_PAIRS:
        expr = _first_sql(expr, old, new)
    return f"translate({expr}, '{Q.MISREAD_OLD}', '{Q.MISREAD_NEW}')"


@register("ocr_misread", f"SELECT doc_id, {_misread_sql()} AS misread FROM documents")
def ocr_misread(spark, sf):
    return _docs_text(spark, sf, misread=A.ocr_misread(F.col("text"), F.col("doc_id")))


def _homophone_sql() -> str:
    table = "MAP {" + ", ".join(
        f"{Q.quoted([k])}: {Q.quoted([v])}" for k, v in K.HOMOPHONES.items()) + "}"
    expr = ("array_to_string(list_transform(list_filter(regexp_split_to_array(trim(text), '\\s+'), "
            f"lambda w: w <> ''), lambda w: coalesce(({table})[trim(lower(w), "
            f"'{K.WORD_PUNCTUATION}')], w)), ' ')")
    for n, (old, new) in enumerate(K.PHONETIC_PAIRS):
        gate = Q.uni("doc_id", f"'phonetic{n}'", "'0'")
        expr = (f"list_transform([{expr}], lambda u: CASE WHEN {gate} < 0.5::DOUBLE THEN "
                f"{_first_sql('u', old, new)} ELSE u END)[1]")
    return expr


@register("homophones", f"SELECT doc_id, {_homophone_sql()} AS heard FROM documents")
def homophones(spark, sf):
    return _docs_text(spark, sf, heard=A.homophones(F.col("text"), F.col("doc_id")))


@register("near_duplicates", f"""
    SELECT doc_id, CASE {Q.hsh("doc_id", "'near'", "'0'")} % 4 WHEN 0 THEN text || '!!!'
      WHEN 1 THEN text || ' ...' WHEN 2 THEN upper(replace(text, 'ß', 'SS')) ELSE lower(text) END AS near
    FROM documents""")
def near_duplicates(spark, sf):
    return _docs_text(spark, sf, near=A.near_duplicate(F.col("text"), F.col("doc_id")))


@register("structural_shuffle", """
    SELECT doc_id, array_to_string(CASE WHEN len(w) > 4
      THEN list_concat(w[len(w) // 2 + 1:], w[:len(w) // 2]) ELSE list_reverse(w) END, ' ')
      AS shuffled
    FROM (SELECT doc_id, list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: x <> '')
            AS w FROM documents)""")
def structural_shuffle(spark, sf):
    return _docs_text(spark, sf, shuffled=A.structural(F.col("text")))


def _ladder_sql(medium: str, ladder: tuple, key: str = "doc_id") -> str:
    steps = " ".join(f"WHEN {Q.uni(key, repr(medium), repr('0'))} < {bound}::DOUBLE "
                     f"THEN '{name}'" for bound, name in ladder)
    return f"CASE {steps} ELSE '{K.LADDER_LAST}' END"


@register("variant_choice", f"""
    SELECT doc_id, {_ladder_sql("title", K.TITLE_LADDER)} AS title_variant,
      {_ladder_sql("ocr", K.OCR_LADDER)} AS ocr_variant,
      {_ladder_sql("asr", K.ASR_LADDER)} AS asr_variant FROM documents""")
def variant_choice(spark, sf):
    ladders = {"title": K.TITLE_LADDER, "ocr": K.OCR_LADDER, "asr": K.ASR_LADDER}
    return _docs_text(spark, sf, **{
        f"{m}_variant": A.variant_type(ladder, F.col("doc_id"), m) for m, ladder in ladders.items()})


@register("medium_variants", None)
def medium_variants(spark, sf):
    text, key = F.col("text"), F.col("doc_id")
    return _docs_text(spark, sf, **{m: A.variant(text, key, m)["text"] for m in K.MEDIUMS})


@register("missing_injection", f"""
    SELECT doc_id, CASE WHEN {Q.uni("doc_id", "'gap'", "'0'")} >= 0.12::DOUBLE THEN source END
      AS source FROM documents""")
def missing_injection(spark, sf):
    return _docs_text(spark, sf, source=A.with_gaps(F.col("source"), F.col("doc_id"), 0.12))


@register("repost_types", f"""
    SELECT item_id || '-' || k AS video_id, 's' || item_id AS seed_id,
      {_ladder_sql("title", K.TITLE_LADDER, "item_id || '-' || k")} AS variant_type
    FROM benchmark, range(1, {K.REPOSTS_PER_SEED + 1}) r(k)""")
def repost_types(spark, sf):
    from ..operators import reposts

    return reposts.reposts(T.table(spark, sf, "benchmark"), "item_id").select(
        "video_id", "seed_id", "variant_type")


@register("repost_texts", None)
def repost_texts(spark, sf):
    """Every copy with its variant type and its three evaded texts."""
    from ..operators import reposts

    return reposts.reposts(T.table(spark, sf, "benchmark"), "item_id")


@register("repost_expansion", f"""
    SELECT video_id, seed_id, length(text) AS text_length FROM (
      SELECT item_id || '-' || k AS video_id, 's' || item_id AS seed_id, text
      FROM benchmark, range(1, {K.REPOSTS_PER_SEED + 1}) r(k))""")
def repost_expansion(spark, sf):
    from ..operators import reposts

    rows = reposts.expand(T.table(spark, sf, "benchmark"), "item_id")
    return rows.select("video_id", "seed_id", F.length("text").cast("long").alias("text_length"))
