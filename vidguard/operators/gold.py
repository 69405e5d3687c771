"""Feature store and label store: de-duplicate, impute, encode, assemble, repair."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import numeric as N
from ..functions import text as X
from .skew import latest_of_few, latest_per_key, small_table

SNAPSHOT = "snapshot_date"
GRAIN = ("video_id", SNAPSHOT)


INGEST_ORDER = "ingest_seq"


def one_row_per_video(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Latest copy of each video within a snapshot, reduced to ``columns`` when given.

    With an ingest order only the wanted columns are carried through the shuffle. Without one the
    whole row decides, so all columns have to be compared first.
    """
    order = [c for c in df.columns if c == INGEST_ORDER]
    wanted = [*GRAIN, *(columns or [c for c in df.columns if c not in (*GRAIN, *order)])]
    source = df.select(*wanted, *order) if order else df
    return latest_per_key(source, GRAIN, order).select(*wanted)


def one_row_per_written_video(df: DataFrame) -> DataFrame:
    """``one_row_per_video`` of a written feed without an ingest order; wide rows of one copy stay put."""
    wanted = [*GRAIN, *(c for c in df.columns if c not in GRAIN)]
    return latest_of_few(df.select(*wanted), GRAIN)


def snapshot_medians(feeds: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Lower median of the finite values per snapshot and column, one row per snapshot.

    Counts per distinct value are combined before the shuffle; the running count then goes bucket
    by bucket, so neither the rows nor the distinct values of a snapshot meet in one task.
    """
    cells, names = None, []
    for df, columns in feeds:
        names += columns
        part = df.select(
            SNAPSHOT, *[F.col(c).cast("double").alias(c) for c in columns]
        ).unpivot(SNAPSHOT, list(columns), "feature", "value")
        cells = part if cells is None else cells.unionByName(part)
    keys = [SNAPSHOT, "feature"]
    bucket = N.order_bucket(F.col("value")).alias("bucket")
    counts = cells.where(N.finite(F.col("value"))).groupBy(*keys, bucket, "value").agg(
        F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    along = Window.partitionBy(*keys).orderBy("bucket")
    upto, half = F.col("upto"), F.col("half")
    middle = totals.select(
        *keys, "bucket", "n", F.sum("n").over(along).alias("upto"),
        (F.sum("n").over(Window.partitionBy(*keys)) / 2.0).alias("half"),
    ).where((upto >= half) & (upto - F.col("n") < half)).select(
        *keys, "bucket", (upto - F.col("n")).alias("start"), "half")
    # one bucket per snapshot and column is left
    within = Window.partitionBy(*keys).orderBy("value")
    # (few rows now; by snapshot they need one exchange for both the window and the result)
    reached = counts.join(middle, on=[*keys, "bucket"]).repartition(SNAPSHOT).withColumn(
        "upto", F.col("start") + F.sum("n").over(within)).where(upto >= half)
    return reached.groupBy(SNAPSHOT).agg(*[
        F.min(F.when(F.col("feature") == c, F.col("value"))).alias(f"{c}_median") for c in names
    ])


def impute_median(df: DataFrame, columns: Sequence[str], medians: DataFrame) -> DataFrame:
    """Replace values that are not finite by the snapshot median (0.0 if none) and flag them."""
    fills = medians.select(SNAPSHOT, *[f"{c}_median" for c in columns])
    joined = df.join(fills, on=SNAPSHOT, how="left")
    out = []
    for c in df.columns:
        if c not in columns:
            out.append(F.col(c))
            continue
        x = F.col(c).cast("double")
        known = N.finite(x)
        out += [
            F.when(known, x).otherwise(F.coalesce(f"{c}_median", F.lit(0.0))).alias(c),
            F.when(known, 0).otherwise(1).alias(f"{c}_was_missing"),
        ]
    return joined.select(*out)


COMBINED = "combined_text"


def text_features(label: DataFrame) -> DataFrame:
    """Without a combined text, what is made of it is left out too; see ``with_combined_text``."""
    whole = COMBINED in label.columns
    return label.select(
        *GRAIN, "seed_id", *[c for c in K.TEXT_COLUMNS if whole or c != COMBINED],
        X.token_count(F.col("title_text")).alias("title_len"),
        *([X.token_count(F.col(COMBINED)).alias("combined_len")] if whole else []),
        X.present_flag(F.col("ocr_missing")).alias("has_ocr_text"),
        X.present_flag(F.col("asr_missing")).alias("has_asr_text"),
    )


def with_combined_text(features: DataFrame) -> DataFrame:
    """The combined text as silver makes it, and its length, where they are not there."""
    if COMBINED in features.columns:
        return features
    made = X.combined(*[F.col(f"{m}_text") for m in K.MEDIUMS])
    return features.withColumn(COMBINED, made).withColumn("combined_len", X.token_count(F.col(COMBINED)))


def _flags(columns: Sequence[str]) -> list[str]:
    return [f"{c}_was_missing" for c in columns]


def ocr_features(ocr: DataFrame, medians: DataFrame) -> DataFrame:
    return impute_median(ocr, K.OCR_NUMERIC, medians).select(
        *GRAIN, *K.OCR_NUMERIC, *_flags(K.OCR_NUMERIC),
        *[N.bool_to_int(F.col(c)).alias(c) for c in K.OCR_BOOL],
        *[N.one_hot(F.col("text_location"), v).alias(f"loc_{v}") for v in K.LOCATIONS],
    )


def asr_features(asr: DataFrame, medians: DataFrame) -> DataFrame:
    return impute_median(asr, K.ASR_NUMERIC, medians).select(
        *GRAIN, *K.ASR_NUMERIC, *_flags(K.ASR_NUMERIC),
        *[N.bool_to_int(F.col(c)).alias(c) for c in K.ASR_BOOL],
    )


def metadata_features(meta: DataFrame, medians: DataFrame) -> DataFrame:
    return impute_median(meta, K.META_NUMERIC, medians).select(
        *GRAIN, "user_id", "device_id", "audio_id",
        F.coalesce("region", F.lit("unknown")).alias("region"),
        *K.META_NUMERIC, *_flags(K.META_NUMERIC),
        *[N.one_hot(F.col("region"), v).alias(f"reg_{v.lower()}") for v in K.REGIONS],
    )


def repair_finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    fixed = set(columns)
    return df.select(
        *[N.finite_or_zero(F.col(c)).alias(c) if c in fixed else F.col(c) for c in df.columns]
    )


def feature_store(
    label: DataFrame, ocr: DataFrame, asr: DataFrame, metadata: DataFrame
) -> DataFrame:
    """All snapshots in one job: three left joins on (video_id, snapshot_date).

    Every side is already partitioned by the join keys after de-duplication, so the joins add no
    shuffle of their own.
    """
    return assemble_features(*(one_row_per_video(f) for f in (label, ocr, asr, metadata)))


def assemble_features(
    label: DataFrame, ocr: DataFrame, asr: DataFrame, metadata: DataFrame
) -> DataFrame:
    """The feature store of feeds that have one row per video and snapshot.

    Medians and features both read the three numeric feeds: a job that owns them writes the
    de-duplicated feeds first, so that neither repeats the work. The label feed is read once; without
    ``combined_text`` that is made after the joins, so only the texts it is made of are shuffled.
    """
    medians = small_table(snapshot_medians(
        [(ocr, K.OCR_NUMERIC), (asr, K.ASR_NUMERIC), (metadata, K.META_NUMERIC)]))
    wide = text_features(label)
    for side in (
        ocr_features(ocr, medians), asr_features(asr, medians), metadata_features(metadata, medians)
    ):
        wide = wide.join(side, on=list(GRAIN), how="left")
    wide = with_combined_text(wide)
    ids = ["video_id", SNAPSHOT, "seed_id", *K.TEXT_COLUMNS,
           "user_id", "device_id", "audio_id", "region"]
    return repair_finite(wide, K.numeric_features()).select(*ids, *K.numeric_features())


def label_store(label: DataFrame) -> DataFrame:
    """1 only for the exact positive value; anything else, NULL included, is 0."""
    return labels_of(one_row_per_video(label, ["label"]))


def labels_of(latest: DataFrame) -> DataFrame:
    """The label store of a label feed with one row per video and snapshot."""
    return latest.select(
        *GRAIN,
        F.when(F.col("label") == K.POSITIVE, 1).otherwise(0).alias("label"),
        F.lit(K.LABEL_DEF).alias("label_def"),
    )


def modeling_frame(features: DataFrame, labels: DataFrame) -> DataFrame:
    return features.join(labels, on=list(GRAIN), how="inner")
