"""Terms of the pair scores. ``q`` and ``s`` are struct columns (query side, seed side); a NULL
field is an absent value, and a term with an absent side is NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from .rounding import decimal_text, round_exact


def _number(c: Column) -> Column:
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def _closeness(gap: Column) -> Column:
    """1 - gap, not below 0; NULL stays NULL."""
    return F.when(gap > 1, 0.0).otherwise(1.0 - gap)


def _relative(a: Column, b: Column) -> Column:
    a, b = _number(a), _number(b)
    return _closeness(F.abs(a - b) / F.when(F.abs(b) < 1, 1.0).otherwise(F.abs(b)))


def _absolute(a: Column, b: Column) -> Column:
    return _closeness(F.abs(_number(a) - _number(b)))


def _equal(a: Column, b: Column) -> Column:
    return (a == b).cast("double")


def mean_present(terms: list[Column]) -> Column:
    """Mean of the terms that are not NULL, 0.0 when there are none."""
    total, present = F.lit(0.0), F.lit(0)
    for t in terms:
        total = total + F.coalesce(t, F.lit(0.0))
        present = present + t.isNotNull().cast("int")
    return F.coalesce(F.try_divide(total, present), F.lit(0.0))


def ocr_terms(q: Column, s: Column, with_location: bool = True) -> list[Column]:
    terms = [_relative(q["font_size"], s["font_size"])]
    terms += [_absolute(q[c], s[c]) for c in ("contrast_level", "ocr_confidence", "text_density")]
    terms += [_equal(q["is_animated"], s["is_animated"])]
    return terms + ([_equal(q["text_location"], s["text_location"])] if with_location else [])


def asr_terms(q: Column, s: Column) -> list[Column]:
    terms = [_relative(q["speech_pace"], s["speech_pace"])]
    terms += [_absolute(q[c], s[c]) for c in ("speech_volume", "avg_confidence")]
    return terms + [_equal(q[c], s[c]) for c in K.ASR_BOOL]


def exact_terms(q: Column, s: Column) -> list[Column]:
    return [_equal(q[c].cast("string"), s[c].cast("string")) for c in K.EXACT_FIELDS]


def upload_time(c: Column) -> Column:
    """Upload time text to timestamp, NULL when it does not have the expected form."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss"))


def temporal_decay(a: Column, b: Column) -> Column:
    """exp(-hours/24) between two timestamps, before rounding."""
    hours = F.abs(F.unix_timestamp(a) - F.unix_timestamp(b)) / 3600.0
    return F.exp(-hours / K.DECAY_HOURS)


def above_gate(text_score: Column) -> Column:
    return F.coalesce(text_score >= K.TEXT_GATE, F.lit(False))


def duplicate_type(is_cross_medium: Column, feature_score: Column) -> Column:
    return (
        F.when(is_cross_medium, "cross_medium")
        .when(feature_score >= K.FEATURE_HIGH, "same_asset")
        .otherwise("re_authored")
    )


def lane(kind: Column) -> Column:
    return F.when(kind == "same_asset", "fast").otherwise("investigation")


def match_reason(text: Column, lift: Column, kind: Column) -> Column:
    hit = F.concat(
        F.lit("text "), decimal_text(round_exact(text, 3), 3),
        F.lit(" + metadata lift "), decimal_text(round_exact(lift, 3), 3),
        F.lit(" -> "), kind,
    )
    miss = F.concat(
        F.lit("text "), F.coalesce(decimal_text(text, 4), F.lit("None")),
        F.lit(f" below gate {K.TEXT_GATE}; no duplicate"),
    )
    return F.when(above_gate(text), hit).otherwise(miss)


def score_band(c: Column) -> Column:
    return (
        F.when(c.isNull(), "not applicable")
        .when(c >= K.REVIEW_BELOW, "high")
        .when(c >= K.ALLOW_BELOW, "medium")
        .otherwise("low")
    )
