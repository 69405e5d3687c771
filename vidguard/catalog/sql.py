"""DuckDB side of the registered queries: common table expressions and a builder."""

from .. import constants as K
from . import tables as T


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def rnd(expr: str, digits: int) -> str:
    """Decimal rounding with ties decided on the exact binary value."""
    p = f"{10**digits}::DOUBLE"
    gap = f"(x::FLOAT::DOUBLE * {p} - (floor(x * {p}) + 0.5)) + (x - x::FLOAT::DOUBLE) * {p}"
    return (
        f"list_transform([({expr})::DOUBLE], lambda x: CASE WHEN x IS NULL THEN NULL "
        f"ELSE (floor(x * {p}) + CASE WHEN {gap} > 0 OR ({gap} = 0 AND "
        f"floor(x * {p})::BIGINT % 2 <> 0) THEN 1 ELSE 0 END) / {p} END)[1]"
    )


def dec(expr: str, digits: int) -> str:
    return (f"regexp_replace(({expr})::DECIMAL(18,{digits})::VARCHAR, "
            r"'(\.\d+?)0+$', '\1')")


def clean(expr: str) -> str:
    return f"trim(regexp_replace(lower({expr}), '[^a-z0-9]+', ' ', 'g'))"


def uni(*parts: str) -> str:
    return f"({hsh(*parts)})::DOUBLE / 2147483648"


def hsh(*parts: str) -> str:
    text = " || ':' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % 2147483648)"


LEET_OLD = "".join(K.LEET) + "".join(K.LEET).upper()
LEET_NEW = "".join(K.LEET.values()) * 2
MISREAD_OLD, MISREAD_NEW = "".join(K.MISREAD_CHARS), "".join(K.MISREAD_CHARS.values())

_KEYS = "'v' || doc_id AS video_id, '2025-0' || (doc_id % 6 + 1) || '-01' AS snapshot_date"


def _pct(k: int) -> str:
    return f"((doc_id * {k} % 101) / 100.0::DOUBLE)::VARCHAR"


def _flag(k: int) -> str:
    return f"CASE WHEN doc_id % {k} = 0 THEN 'True' ELSE 'False' END"


def _finite(c: str) -> str:
    return f"({c} IS NOT NULL AND NOT isnan({c}::DOUBLE) AND NOT isinf({c}::DOUBLE))"


def _imputed(cols) -> str:
    return ", ".join(
        f"CASE WHEN {_finite('f.' + c)} THEN f.{c}::DOUBLE ELSE coalesce(m.{c}, 0) END AS {c}, "
        f"(NOT {_finite('f.' + c)})::INTEGER AS {c}_was_missing" for c in cols)


def _medians(cols, feed: str) -> str:
    return "SELECT snapshot_date, " + ", ".join(
        f"quantile_disc({c}::DOUBLE, 0.5) FILTER (WHERE {_finite(c)}) AS {c}" for c in cols
    ) + f" FROM {feed} GROUP BY snapshot_date"


def _hot(c: str, values, prefix: str) -> str:
    return ", ".join(f"(coalesce({c}, 'unknown') = '{v}')::INTEGER AS {prefix}{v.lower()}"
                     for v in values)


def _ints(cols) -> str:
    return ", ".join(f"coalesce({c}::INTEGER, 0) AS {c}" for c in cols)


_NUM = K.numeric_features()
_SPARSE = [c for c in _NUM if c not in K.TEXT_NUMERIC]


def _struct(cols, src: str) -> str:
    return "{" + ", ".join(f"'{c}': {src}.{c}" for c in cols) + "}"


# name -> SQL of one common table expression; each may use those above it
CTE: dict[str, str] = {
    "raw_label": f"""
        SELECT {_KEYS}, 1 AS ingest_seq, source AS seed_id,
          CASE WHEN source IN ({quoted(T.LEET_TITLE)}) THEN 'leetspeak' ELSE 'exact' END
            AS variant_type,
          CASE WHEN source IN ({quoted(T.LEET_TITLE)})
                 THEN translate(text, '{LEET_OLD}', '{LEET_NEW}')
               WHEN source IN ({quoted(T.PLAIN_TITLE)}) THEN 'Upload from ' || source
               ELSE text END AS title_text,
          CASE WHEN source IN ({quoted(T.NO_OCR_TEXT)}) THEN NULL
               WHEN source IN ({quoted(T.MISREAD_OCR)})
                 THEN translate(text, '{MISREAD_OLD}', '{MISREAD_NEW}')
               ELSE text END AS ocr_text,
          CASE WHEN source IN ({quoted(T.NO_ASR_TEXT)}) THEN NULL
               WHEN source IN ({quoted(T.NOISE_ASR)}) THEN '!!!'
               WHEN source IN ({quoted(T.LEET_ASR)})
                 THEN translate(text, '{LEET_OLD}', '{LEET_NEW}')
               ELSE text END AS asr_text,
          CASE toxic WHEN 1 THEN ' Harmful' WHEN 0 THEN 'clean' END AS label
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "raw_ocr": f"""
        SELECT {_KEYS}, ingest_seq::INTEGER AS ingest_seq,
          CASE WHEN n_chars % 25 = 0 THEN NULL WHEN n_chars % 25 = 1 THEN 'n/a'
               ELSE (8 + doc_id * 7 % 30 + ingest_seq - 1) || '.9' END AS font_size,
          CASE doc_id % 7 {" ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(T.PLACES))}
            END AS text_location,
          CASE WHEN n_chars % 20 = 3 THEN NULL WHEN n_chars % 37 = 5 THEN 'NaN'
               ELSE {_pct(13)} END AS contrast_level,
          {_pct(17)} AS text_density,
          CASE WHEN n_chars % 19 <> 0 THEN {_flag(2)} END AS is_animated,
          CASE WHEN n_chars % 20 <> 7 THEN {_pct(29)} END AS ocr_confidence
        FROM documents, range(1, 3) r(ingest_seq)
        WHERE lang <> '{T.NO_OCR_LANG}' AND (lang = '{T.TWICE_LANG}' OR ingest_seq = 1)""",
    "raw_asr": f"""
        SELECT {_KEYS},
          CASE WHEN n_chars % 25 <> 4 THEN (60 + doc_id * 11 % 140)::VARCHAR END AS speech_pace,
          {_pct(19)} AS speech_volume,
          CASE WHEN n_chars % 20 <> 11 THEN {_pct(31)} END AS avg_confidence,
          {_flag(2)} AS has_silence, {_flag(3)} AS has_overlap,
          CASE WHEN n_chars % 23 = 0 THEN 'unsure' ELSE {_flag(5)} END AS is_distorted
        FROM documents WHERE source <> '{T.NO_ASR_SOURCE}'""",
    "raw_metadata": f"""
        SELECT {_KEYS}, 'user_' || (user_id % 9) AS user_id, 'device_' || (doc_id % 8) AS device_id,
          'audio_' || (doc_id % 5) AS audio_id,
          CASE WHEN n_chars % 11 = 0 THEN 'XX' WHEN n_chars % 13 = 0 THEN NULL ELSE
            CASE lang {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in T.HOME.items())} END END
            AS region,
          CASE WHEN event_type = 'signup' THEN 'not a time' WHEN event_type <> 'error'
               THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS uploaded_at
        FROM documents LEFT JOIN events ON event_id = doc_id
        WHERE source <> '{T.NO_META_SOURCE}'""",
    "silver_label": f"""
        SELECT *, trim(concat_ws(' ', title_text, ocr_text, asr_text)) AS combined_text FROM (
          SELECT video_id, snapshot_date, ingest_seq, seed_id, variant_type,
            {clean("coalesce(title_text, '')")} AS title_text,
            {clean("coalesce(ocr_text, '')")} AS ocr_text,
            {clean("coalesce(asr_text, '')")} AS asr_text,
            lower(trim(label)) AS label, (ocr_text IS NULL)::INTEGER AS ocr_missing,
            (asr_text IS NULL)::INTEGER AS asr_missing
          FROM raw_label)""",
    "silver_ocr": """
        SELECT video_id, snapshot_date, ingest_seq,
          try_cast(trunc(try_cast(font_size AS DOUBLE)) AS INTEGER) AS font_size,
          lower(trim(text_location)) AS text_location,
          try_cast(contrast_level AS FLOAT) AS contrast_level,
          try_cast(text_density AS FLOAT) AS text_density,
          try_cast(ocr_confidence AS FLOAT) AS ocr_confidence,
          try_cast(is_animated AS BOOLEAN) AS is_animated
        FROM raw_ocr""",
    "silver_asr": """
        SELECT video_id, snapshot_date,
          try_cast(trunc(try_cast(speech_pace AS DOUBLE)) AS INTEGER) AS speech_pace,
          try_cast(speech_volume AS FLOAT) AS speech_volume,
          try_cast(avg_confidence AS FLOAT) AS avg_confidence,
          try_cast(has_silence AS BOOLEAN) AS has_silence,
          try_cast(has_overlap AS BOOLEAN) AS has_overlap,
          try_cast(is_distorted AS BOOLEAN) AS is_distorted
        FROM raw_asr""",
    "silver_metadata": """
        SELECT *, hour(uploaded_at)::INTEGER AS upload_hour,
          (dayofweek(uploaded_at) + 1)::INTEGER AS upload_dayofweek FROM (
          SELECT video_id, snapshot_date, user_id, device_id, audio_id,
            upper(trim(region)) AS region, try_cast(uploaded_at AS TIMESTAMP) AS uploaded_at
          FROM raw_metadata)""",
    "one_ocr": """
        SELECT * EXCLUDE (ingest_seq) FROM silver_ocr
        QUALIFY row_number() OVER (PARTITION BY video_id, snapshot_date
                                   ORDER BY ingest_seq DESC) = 1""",
    "medians_ocr": _medians(K.OCR_NUMERIC, "one_ocr"),
    "medians_asr": _medians(K.ASR_NUMERIC, "silver_asr"),
    "medians_metadata": _medians(K.META_NUMERIC, "silver_metadata"),
    "features_text": """
        SELECT video_id, snapshot_date, seed_id, combined_text, title_text, ocr_text, asr_text,
          len(string_split(title_text, ' '))::INTEGER AS title_len,
          len(string_split(combined_text, ' '))::INTEGER AS combined_len,
          (ocr_missing = 0)::INTEGER AS has_ocr_text, (asr_missing = 0)::INTEGER AS has_asr_text
        FROM silver_label""",
    "features_ocr": f"""
        SELECT f.video_id, f.snapshot_date, {_imputed(K.OCR_NUMERIC)}, {_ints(K.OCR_BOOL)},
          {_hot("text_location", K.LOCATIONS, "loc_")}
        FROM one_ocr f LEFT JOIN medians_ocr m USING (snapshot_date)""",
    "features_asr": f"""
        SELECT f.video_id, f.snapshot_date, {_imputed(K.ASR_NUMERIC)}, {_ints(K.ASR_BOOL)}
        FROM silver_asr f LEFT JOIN medians_asr m USING (snapshot_date)""",
    "features_metadata": f"""
        SELECT f.video_id, f.snapshot_date, user_id, device_id, audio_id,
          coalesce(region, 'unknown') AS region, {_imputed(K.META_NUMERIC)},
          {_hot("region", K.REGIONS, "reg_")}
        FROM silver_metadata f LEFT JOIN medians_metadata m USING (snapshot_date)""",
    "features": f"""
        SELECT video_id, snapshot_date, seed_id, combined_text, title_text, ocr_text, asr_text,
          user_id, device_id, audio_id, region,
          {", ".join(f"{c}::DOUBLE AS {c}" for c in K.TEXT_NUMERIC)},
          {", ".join(f"CASE WHEN {_finite(c)} THEN {c}::DOUBLE ELSE 0 END AS {c}" for c in _SPARSE)}
        FROM features_text LEFT JOIN features_ocr USING (video_id, snapshot_date)
          LEFT JOIN features_asr USING (video_id, snapshot_date)
          LEFT JOIN features_metadata USING (video_id, snapshot_date)""",
    "labels_gold": f"""
        SELECT video_id, snapshot_date,
          CASE WHEN label = '{K.POSITIVE}' THEN 1 ELSE 0 END AS label,
          '{K.LABEL_DEF}' AS label_def FROM silver_label""",
    "frame": "SELECT * FROM features JOIN labels_gold USING (video_id, snapshot_date)",
    "quota_train": f"""
        SELECT label, n, total, held, (lo + (row_number() OVER (ORDER BY exact - lo DESC, label)
            <= total - held - sum(lo) OVER ())::INTEGER)::BIGINT AS train FROM (
          SELECT *, n * (total - held) / total::DOUBLE AS exact,
            floor(n * (total - held) / total::DOUBLE) AS lo FROM (
            SELECT *, ceil({K.HOLDOUT_SHARE}::DOUBLE * total)::BIGINT AS held FROM (
              SELECT label, count(*) AS n, (sum(count(*)) OVER ())::BIGINT AS total
              FROM labels_gold GROUP BY label)))""",
    "quota": f"""
        SELECT label, train, (lo + (row_number() OVER (ORDER BY exact - lo DESC, label)
            <= take - sum(lo) OVER ())::INTEGER)::BIGINT AS val FROM (
          SELECT *, (n - train) * take / held::DOUBLE AS exact,
            floor((n - train) * take / held::DOUBLE) AS lo FROM (
            SELECT *, held - ceil({K.TEST_SHARE_OF_HOLDOUT}::DOUBLE * held)::BIGINT AS take
            FROM quota_train))""",
    "splits": f"""
        SELECT video_id, label, CASE WHEN place <= train THEN 'train'
          WHEN place <= train + val THEN 'val' ELSE 'test' END AS split FROM (
          SELECT video_id, label, row_number() OVER (PARTITION BY label
            ORDER BY md5(video_id || ':{K.SPLIT_SEED}')) AS place FROM labels_gold)
        JOIN quota USING (label)""",
    "split_frame": "SELECT frame.*, split FROM frame JOIN splits USING (video_id)",
    # text vectors
    "mediums": """
        SELECT video_id, 0 AS ord, title_text AS text FROM features WHERE trim(title_text) <> ''
        UNION ALL SELECT video_id, 1, ocr_text FROM features WHERE trim(ocr_text) <> ''
        UNION ALL SELECT video_id, 2, asr_text FROM features WHERE trim(asr_text) <> ''""",
    "token_counts": f"""
        SELECT text, ('0x' || substr(md5(token), 1, 8))::BIGINT % {K.VECTOR_DIM} AS place,
          count(*) AS n
        FROM (SELECT text, unnest(string_split(text, ' ')) AS token
              FROM (SELECT DISTINCT text FROM mediums)) WHERE token <> '' GROUP BY ALL""",
    "text_vectors": f"""
        SELECT text, list_transform(list(coalesce(n, 0)::DOUBLE ORDER BY place),
            lambda c: (c / sqrt(sum(n * n)::DOUBLE))::FLOAT::DOUBLE) AS vec
        FROM (SELECT text, r.place, n FROM (SELECT DISTINCT text FROM token_counts) t
              CROSS JOIN range({K.VECTOR_DIM}) r(place)
              LEFT JOIN token_counts USING (text, place))
        GROUP BY text""",
    # Layer 1 with fixed coefficients
    "scaler": "SELECT " + ", ".join(
        f"avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS {c}_s"
        for c in _NUM) + " FROM frame",
    "layer1": f"""
        SELECT f.*, score, (score > 0.5)::INTEGER AS pred,
          CASE WHEN score > 0.5 THEN 'harmful' ELSE 'clean' END AS layer1_label,
          {rnd("score", 4)} AS harmful_prob
        FROM (SELECT *, 1 / (1 + exp(-({T.INTERCEPT}::DOUBLE + {" + ".join(
            f"({w})::DOUBLE * (({c} - {c}_m) / {c}_s)" for c, w in T.WEIGHTS.items())}))) AS score
              FROM split_frame, scaler) f""",
    "seeds": "SELECT * FROM split_frame WHERE split = 'train' AND label = 1",
    "text_scores": f"""
        SELECT q.text AS q_text, s.text AS s_text, round(least(greatest(
            list_dot_product(qv.vec, sv.vec), 0), 1), 10) AS score
        FROM (SELECT DISTINCT text FROM mediums JOIN layer1 USING (video_id)
              WHERE layer1_label = 'harmful') q
        CROSS JOIN (SELECT DISTINCT text FROM mediums JOIN seeds USING (video_id)) s
        JOIN text_vectors qv ON qv.text = q.text JOIN text_vectors sv ON sv.text = s.text""",
    "cells": """
        SELECT q.video_id, s.video_id AS seed_id, text_scores.score, q.ord AS q_ord, s.ord AS c_ord
        FROM text_scores JOIN mediums q ON q.text = q_text
          JOIN layer1 l ON l.video_id = q.video_id AND layer1_label = 'harmful'
          JOIN mediums s ON s.text = s_text
          JOIN seeds d ON d.video_id = s.video_id""",
    "ranked": f"""
        SELECT *, {rnd("score", 4)} AS text_score,
          ['title','ocr','asr'][q_ord + 1] AS q_medium, ['title','ocr','asr'][c_ord + 1] AS c_medium,
          row_number() OVER (PARTITION BY video_id ORDER BY score DESC, q_ord, seed_id, c_ord)
            AS rank
        FROM (SELECT * FROM cells QUALIFY row_number() OVER (PARTITION BY video_id, seed_id
              ORDER BY score DESC, q_ord, c_ord) = 1)""",
}


def ocr_terms(q: str, s: str, with_location: bool) -> list[str]:
    terms = [_rel(f"{q}.font_size", f"{s}.font_size")]
    terms += [_abs(f"{q}.{c}", f"{s}.{c}")
              for c in ("contrast_level", "ocr_confidence", "text_density")]
    terms += [_eq(f"{q}.is_animated", f"{s}.is_animated")]
    return terms + ([_eq(f"{q}.text_location", f"{s}.text_location")] if with_location else [])


def asr_terms(q: str, s: str) -> list[str]:
    terms = [_rel(f"{q}.speech_pace", f"{s}.speech_pace")]
    terms += [_abs(f"{q}.{c}", f"{s}.{c}") for c in ("speech_volume", "avg_confidence")]
    return terms + [_eq(f"{q}.{c}", f"{s}.{c}") for c in K.ASR_BOOL]


def exact_terms(q: str, s: str) -> list[str]:
    return [_eq(f"{q}.{c}", f"{s}.{c}") for c in K.EXACT_FIELDS]


def _known(c: str) -> str:
    return f"CASE WHEN NOT isnan({c}::DOUBLE) THEN {c}::DOUBLE END"


def _rel(a: str, b: str) -> str:
    a, b = _known(a), _known(b)
    return (f"CASE WHEN ({a}) IS NOT NULL AND ({b}) IS NOT NULL THEN "
            f"greatest(0, 1 - abs(({a}) - ({b})) / greatest(abs({b}), 1)) END")


def _abs(a: str, b: str) -> str:
    a, b = _known(a), _known(b)
    return (f"CASE WHEN ({a}) IS NOT NULL AND ({b}) IS NOT NULL THEN "
            f"greatest(0, 1 - abs(({a}) - ({b}))) END")


def _eq(a: str, b: str) -> str:
    return f"({a} = {b})::INTEGER::DOUBLE"


def mean(terms: list[str]) -> str:
    total = " + ".join(f"coalesce({t}, 0::DOUBLE)" for t in terms)
    n = " + ".join(f"(({t}) IS NOT NULL)::INTEGER" for t in terms)
    return f"(CASE WHEN ({n}) > 0 THEN (0::DOUBLE + {total}) / ({n}) ELSE 0 END)"


CTE["best"] = f"""
    SELECT r.video_id, r.seed_id, text_score, q_medium, c_medium, q_ord, c_ord,
      CASE WHEN text_score >= {K.TEXT_GATE}::DOUBLE AND q_ord = c_ord THEN CASE q_ord
        WHEN 1 THEN {rnd(mean(ocr_terms("q", "s", False)), 4)}
        WHEN 2 THEN {rnd(mean(asr_terms("q", "s")), 4)} END END AS feature_score,
      CASE WHEN text_score >= {K.TEXT_GATE}::DOUBLE THEN
        {rnd(f"{K.EXACT_SHARE}::DOUBLE * {mean(exact_terms('q', 's'))} + {K.TEMPORAL_SHARE}::DOUBLE"
             " * 0", 4)} END AS metadata_score,
      rank
    FROM ranked r JOIN layer1 q USING (video_id) JOIN seeds s ON s.video_id = r.seed_id"""
CTE["typed"] = f"""
    SELECT *, q_ord <> c_ord AS is_cross_medium,
      CASE WHEN text_score >= {K.TEXT_GATE}::DOUBLE THEN CASE WHEN q_ord <> c_ord
        THEN 'cross_medium' WHEN feature_score >= {K.FEATURE_HIGH}::DOUBLE THEN 'same_asset'
        ELSE 're_authored' END END AS duplicate_type,
      CASE WHEN text_score >= {K.TEXT_GATE}::DOUBLE THEN {rnd(
          f"least(1, text_score + {K.METADATA_LIFT}::DOUBLE * coalesce(metadata_score, 0))", 4)}
        ELSE {rnd("text_score", 4)} END AS match_confidence
    FROM best"""
# vector tables
CTE["grid_seeds"] = """
    SELECT 's' || (vec_id // 3) AS seed_id, (vec_id + (vec_id // 3) % 2) % 3 AS c_ord,
      embedding::DOUBLE[] AS vec FROM embeddings"""
CTE["mixed"] = """
    SELECT v.vec_id, list_transform(list_zip(v.embedding, coalesce(o.embedding, v.embedding)),
      lambda p: (v.vec_id * 7 % 13) / 13.0::DOUBLE * p[1]::DOUBLE
                + (1 - (v.vec_id * 7 % 13) / 13.0::DOUBLE) * p[2]::DOUBLE) AS mix
    FROM embeddings v LEFT JOIN embeddings o ON o.vec_id = v.vec_id + 1"""
CTE["grid_queries"] = """
    SELECT 'q' || (vec_id // 3) AS query_id, vec_id % 3 AS q_ord, list_transform(mix,
      lambda x: (x / sqrt(list_dot_product(mix, mix)))::FLOAT::DOUBLE) AS vec FROM mixed"""
CTE["grid_cells"] = """
    SELECT query_id, seed_id, q_ord::INTEGER AS q_ord, c_ord::INTEGER AS c_ord, round(least(greatest(
      list_dot_product(q.vec, s.vec), 0), 1), 10) AS score
    FROM grid_queries q CROSS JOIN grid_seeds s"""
CTE["grid_best"] = f"""
    SELECT *, {rnd("score", 4)} AS text_score, row_number() OVER (PARTITION BY query_id
      ORDER BY score DESC, q_ord, seed_id, c_ord) AS rank
    FROM (SELECT * FROM grid_cells QUALIFY row_number() OVER (PARTITION BY query_id, seed_id
          ORDER BY score DESC, q_ord, c_ord) = 1)"""
# pairs of successive uploads
CTE["side"] = f"""
    SELECT d.doc_id, 'v' || d.doc_id AS video_id,
      CASE WHEN o.video_id IS NOT NULL THEN
        {_struct([*K.OCR_NUMERIC, *K.OCR_BOOL, "text_location"], "o")} END AS ocr,
      CASE WHEN a.video_id IS NOT NULL THEN {_struct([*K.ASR_NUMERIC, *K.ASR_BOOL], "a")} END
        AS asr,
      CASE WHEN m.video_id IS NOT NULL THEN {_struct([*K.EXACT_FIELDS, "uploaded_at"], "m")} END
        AS meta
    FROM documents d LEFT JOIN one_ocr o ON o.video_id = 'v' || d.doc_id
      LEFT JOIN silver_asr a ON a.video_id = 'v' || d.doc_id
      LEFT JOIN silver_metadata m ON m.video_id = 'v' || d.doc_id"""
CTE["pairs"] = """
    SELECT q.video_id AS q_video_id, s.video_id AS s_video_id, q.ocr AS q_ocr, s.ocr AS s_ocr,
      q.asr AS q_asr, s.asr AS s_asr, q.meta AS q_meta, s.meta AS s_meta
    FROM side q JOIN side s ON s.doc_id = q.doc_id + 1"""


def record(q: str, s: str, expr: str) -> str:
    return (f"CASE WHEN {q} IS NULL AND {s} IS NULL THEN NULL WHEN {q} IS NULL OR {s} IS NULL "
            f"THEN 0 ELSE {rnd(expr, 4)} END")


_NEAR = rnd("exp(-(abs(epoch(q_meta.uploaded_at) - epoch(s_meta.uploaded_at)) / 3600.0::DOUBLE)"
            f" / {K.DECAY_HOURS}::DOUBLE)", 4)
CTE["pair_scores"] = f"""
    SELECT *, CASE WHEN q_meta IS NULL OR s_meta IS NULL THEN 0 ELSE
        {rnd(f"{K.EXACT_SHARE}::DOUBLE * exact_mean + {K.TEMPORAL_SHARE}::DOUBLE * temporal", 4)}
        END AS metadata_score FROM (
      SELECT *, {record("q_ocr", "s_ocr", mean(ocr_terms("q_ocr", "s_ocr", True)))} AS ocr_score,
        {record("q_asr", "s_asr", mean(asr_terms("q_asr", "s_asr")))} AS asr_score,
        {mean(exact_terms("q_meta", "s_meta"))} AS exact_mean,
        coalesce({_NEAR}, 0) AS temporal
      FROM pairs)"""
# prediction log
_K = "(event_id * 37 % 1001)"
CTE["predictions"] = f"""
    SELECT *, CASE WHEN layer1_label = 'harmful' THEN CASE WHEN duplicate_type = 'same_asset'
        THEN 'fast' ELSE 'investigation' END END AS lane FROM (
      SELECT event_id AS id, 'v' || user_id AS video_id,
        CASE WHEN h THEN 'harmful' ELSE 'clean' END AS layer1_label,
        CASE WHEN h THEN event_id % 2 = 0 END AS is_cross_medium,
        CASE WHEN h AND event_id % 3 = 0 THEN {_K} / 1000.0::DOUBLE END AS feature_score,
        CASE WHEN h THEN CASE WHEN (event_id // 500) % 2 = 0 THEN {_K} / 1000.0::DOUBLE
          ELSE {_K} * {_K} / 1000000.0::DOUBLE END END AS match_confidence,
        CASE WHEN h THEN '{K.REVIEW}' ELSE '{K.ALLOW}' END AS decision,
        CASE WHEN event_type = 'purchase' THEN 'urgent' WHEN h THEN 'normal' END AS priority,
        CASE WHEN h THEN CASE WHEN event_id % 2 = 0 THEN 'cross_medium'
          WHEN event_id % 3 = 0 THEN 'same_asset' ELSE 're_authored' END END AS duplicate_type,
        ts AS created_at
      FROM (SELECT *, event_type NOT IN ('error', 'signup') AS h FROM events))"""
CTE["verdicts"] = """
    SELECT event_id AS id, 'v' || user_id AS video_id,
      ['REMOVE', 'ALLOW', 'ESCALATE'][event_id % 3 + 1] AS verdict,
      'analyst_' || (event_id % 4) AS reviewed_by, ts AS reviewed_at
    FROM events WHERE event_type = 'signup'"""
CTE["reviewed"] = """
    SELECT p.*, v.verdict AS reviewer_verdict, v.reviewed_by, v.reviewed_at
    FROM predictions p LEFT JOIN verdicts v
      ON v.video_id = p.video_id AND p.created_at <= v.reviewed_at
    QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY v.reviewed_at DESC, v.id DESC) = 1"""
CTE["windowed"] = f"""
    SELECT *, CASE WHEN place <= floor(total / 2.0) THEN 'current' ELSE 'reference' END AS win FROM (
      SELECT *, row_number() OVER (ORDER BY created_at DESC, id DESC) AS place,
        count(*) OVER () AS total
      FROM (SELECT * FROM reviewed ORDER BY created_at DESC, id DESC LIMIT {K.RECENT_LIMIT}))"""


def _rate(cond: str) -> str:
    return rnd(f"count(*) FILTER (WHERE {cond}) / count(*)::DOUBLE", 4)


CTE["window_metrics"] = f"""
    SELECT win AS "window", count(*) AS n, {_rate("layer1_label = 'harmful'")} AS harmful_rate,
      {_rate(f"decision = '{K.REVIEW}'")} AS review_rate,
      {_rate(f"decision = '{K.ALLOW}'")} AS allow_rate,
      {_rate("priority = 'urgent'")} AS urgent_rate,
      {_rate("is_cross_medium")} AS cross_medium_rate,
      {rnd("avg(match_confidence)", 4)} AS mean_match_confidence,
      {rnd("stddev_pop(match_confidence)", 4)} AS std_match_confidence,
      {_rate("feature_score IS NULL")} AS feature_missing_rate,
      {_rate("reviewer_verdict IS NOT NULL")} AS override_rate
    FROM windowed GROUP BY win"""
_EDGES = "[" + ", ".join(f"{i} * 0.1::DOUBLE" for i in range(10)) + ", 1.0::DOUBLE]"
CTE["psi"] = f"""
    SELECT CASE WHEN max(cn) > 0 AND max(rn) > 0 THEN {rnd("sum((c - r) * ln(c / r))", 4)} END
      AS psi FROM (
      SELECT bin, cn, rn, (count(*) FILTER (WHERE win = 'current' AND b = bin) + 1e-6::DOUBLE)
          / (cn + 1e-6::DOUBLE * 10) AS c,
        (count(*) FILTER (WHERE win = 'reference' AND b = bin) + 1e-6::DOUBLE)
          / (rn + 1e-6::DOUBLE * 10) AS r
      FROM (SELECT *, CASE WHEN match_confidence BETWEEN 0 AND 1 THEN least(9, len(list_filter(
              {_EDGES}, lambda e: e <= match_confidence)) - 1) END AS b,
              count(match_confidence) FILTER (WHERE win = 'current') OVER () AS cn,
              count(match_confidence) FILTER (WHERE win = 'reference') OVER () AS rn
            FROM windowed), range(10) bins(bin)
      GROUP BY bin, cn, rn)"""


def _pct_text(expr: str) -> str:
    return f"printf('%.2f%%', {rnd(f'({expr}) * 100', 2)})"


CTE["cur"] = "SELECT * FROM window_metrics WHERE \"window\" = 'current'"
CTE["ref"] = "SELECT * FROM window_metrics WHERE \"window\" = 'reference'"
_CHANGE = "abs(coalesce(cur.harmful_rate, 0) - coalesce(ref.harmful_rate, 0))"
CTE["alerts"] = f"""
    SELECT type, severity, value, message FROM (
      SELECT 'harmful_rate_drift' AS type, 'high' AS severity, {_CHANGE} AS value,
        'Harmful rate changed by ' || {_pct_text(_CHANGE)} AS message,
        {K.HARMFUL_ALERT}::DOUBLE AS bound FROM cur, ref
      UNION ALL SELECT 'high_override_rate', 'medium', override_rate, 'Analysts overriding '
          || {_pct_text("override_rate")} || ' of decisions', {K.OVERRIDE_ALERT}::DOUBLE FROM cur
      UNION ALL SELECT 'feature_score_missing_high', 'low', feature_missing_rate,
        'Feature score unavailable (cross-medium/title) in '
          || {_pct_text("feature_missing_rate")} || ' of matches', {K.MISSING_ALERT}::DOUBLE
        FROM cur
      UNION ALL SELECT 'score_distribution_drift', 'high', psi, 'PSI on match_confidence = '
          || printf('%.3f', {rnd("psi", 3)}) || ' (threshold {K.PSI_ALERT})',
        {K.PSI_ALERT}::DOUBLE FROM psi) WHERE value > bound"""
CTE["evaluation"] = """
    SELECT ['train', 'val', 'test'][doc_id % 3 + 1] AS split, toxic AS label, score,
      (score > 0.5)::INTEGER AS pred
    FROM (SELECT *, (doc_id * 41 % 101) / 100.0::DOUBLE + 0.2::DOUBLE * toxic AS score FROM labels)"""
CTE["confusion"] = """
    SELECT split, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
      count(*) FILTER (WHERE label <> 1 AND pred = 1) AS fp,
      count(*) FILTER (WHERE label = 1 AND pred <> 1) AS fn,
      count(*) FILTER (WHERE label <> 1 AND pred <> 1) AS tn FROM evaluation GROUP BY split"""
CTE["auc"] = f"""
    SELECT split, {rnd("(sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2.0) / (p * n::DOUBLE)", 4)}
      AS roc_auc FROM (
      SELECT split, label, rank() OVER (PARTITION BY split ORDER BY score)
          + (count(*) OVER (PARTITION BY split, score) - 1) / 2.0::DOUBLE AS r,
        sum(label) OVER (PARTITION BY split) AS p,
        sum(1 - label) OVER (PARTITION BY split) AS n FROM evaluation)
    GROUP BY split, p, n"""


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0 ELSE ({a}) / ({b})::DOUBLE END"


CTE["metrics"] = f"""
    SELECT split, {rnd(_ratio("tp + tn", "tp + fp + fn + tn"), 4)} AS accuracy,
      {rnd(_ratio("2.0::DOUBLE * tp", "2 * tp + fp + fn"), 4)} AS f1,
      {rnd(_ratio("tp", "tp + fn"), 4)} AS recall, {rnd(_ratio("tp", "tp + fp"), 4)} AS precision,
      tp + fp + fn + tn AS n_samples, tp + fn AS n_positive, fp + tn AS n_negative, roc_auc
    FROM confusion JOIN auc USING (split)"""


def query(body: str) -> str:
    """``body`` with the table expressions it needs in front, in dependency order."""
    import re

    def used(text: str) -> set[str]:
        words = set(re.findall(r"(?:FROM|JOIN|,)\s+([a-z_0-9]+)", text))
        return {w for w in words if w in CTE}

    needed: set[str] = set()
    stack = list(used(body))
    while stack:
        name = stack.pop()
        if name not in needed:
            needed.add(name)
            stack += used(CTE[name])
    # some tables are used many times over; compute each once
    parts = [f"{n} AS MATERIALIZED ({CTE[n]})" for n in CTE if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
