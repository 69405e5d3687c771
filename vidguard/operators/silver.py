"""Typing and cleaning of the four landed feeds; one projection each."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as X

_KEYS = ("video_id", "snapshot_date")


def _keys(df: DataFrame) -> list:
    """Keys as text, plus any ingest order column the landing step added."""
    extra = [F.col(c) for c in df.columns if c == "ingest_seq"]
    return [F.col(c).cast("string").alias(c) for c in _KEYS] + extra


def silver_label(df: DataFrame) -> DataFrame:
    texts = {m: X.clean_or_empty(F.col(f"{m}_text")) for m in ("title", "ocr", "asr")}
    typed = df.select(
        *_keys(df),
        F.col("seed_id").cast("string").alias("seed_id"),
        F.col("variant_type").cast("string").alias("variant_type"),
        *[c.alias(f"{m}_text") for m, c in texts.items()],
        F.lower(F.trim("label")).alias("label"),
        X.missing_flag(F.col("ocr_text")).alias("ocr_missing"),
        X.missing_flag(F.col("asr_text")).alias("asr_missing"),
    )
    joined = X.combined(*[F.col(f"{m}_text") for m in texts])
    return typed.withColumn("combined_text", joined)


def silver_ocr(df: DataFrame) -> DataFrame:
    return df.select(
        *_keys(df),
        N.to_int(F.col("font_size")).alias("font_size"),
        F.lower(F.trim("text_location")).alias("text_location"),
        *[N.to_float(F.col(c)).alias(c)
          for c in ("contrast_level", "text_density", "ocr_confidence")],
        N.to_bool(F.col("is_animated")).alias("is_animated"),
    )


def silver_asr(df: DataFrame) -> DataFrame:
    return df.select(
        *_keys(df),
        N.to_int(F.col("speech_pace")).alias("speech_pace"),
        *[N.to_float(F.col(c)).alias(c) for c in ("speech_volume", "avg_confidence")],
        *[N.to_bool(F.col(c)).alias(c) for c in ("has_silence", "has_overlap", "is_distorted")],
    )


def silver_metadata(df: DataFrame) -> DataFrame:
    typed = df.select(
        *_keys(df),
        *[F.col(c).cast("string").alias(c) for c in ("user_id", "device_id", "audio_id")],
        F.upper(F.trim("region")).alias("region"),
        N.to_timestamp(F.col("uploaded_at")).alias("uploaded_at"),
    )
    return typed.withColumns({
        "upload_hour": F.hour("uploaded_at"),
        "upload_dayofweek": F.dayofweek("uploaded_at"),
    })


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "label": silver_label,
    "ocr": silver_ocr,
    "asr": silver_asr,
    "metadata": silver_metadata,
}


def clean_feed(name: str, df: DataFrame) -> DataFrame:
    return df.transform(CLEANERS[name])
