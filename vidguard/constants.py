"""Fixed values every module shares. They must stay as they are for results to be right."""

# fixed values: the three text mediums, in tie-break order
MEDIUMS = ("title", "ocr", "asr")

# fixed values: one-hot vocabularies (regions are upper case after cleaning)
LOCATIONS = ("top", "center", "bottom", "left", "right")
REGIONS = ("SG", "MY", "US", "ID")

# fixed values: feature columns by feed
OCR_NUMERIC = ("font_size", "contrast_level", "ocr_confidence", "text_density")
ASR_NUMERIC = ("speech_pace", "speech_volume", "avg_confidence")
META_NUMERIC = ("upload_hour", "upload_dayofweek")
OCR_BOOL = ("is_animated",)
ASR_BOOL = ("has_silence", "has_overlap", "is_distorted")
TEXT_NUMERIC = ("title_len", "combined_len", "has_ocr_text", "has_asr_text")

# fixed values: the label contract
LABEL_DEF = "harmful_vs_clean"
POSITIVE = "harmful"

# fixed values: columns that may never reach a model, text columns, target
ID_COLUMNS = ("video_id", "snapshot_date", "seed_id", "user_id", "device_id", "audio_id",
              "region", "label_def")
TEXT_COLUMNS = ("combined_text", "title_text", "ocr_text", "asr_text")
TARGET = "label"

# fixed values: split
SPLIT_SEED = 42
HOLDOUT_SHARE = 0.20
TEST_SHARE_OF_HOLDOUT = 0.50

# fixed values: encoder width, regularisation, iteration bound
VECTOR_DIM = 384
INVERSE_REGULARISATION = 1.0
MAX_ITERATIONS = 1000

# fixed values: promotion gate and overfit flag
MIN_RECALL = 0.90
MIN_PRECISION = 0.85
OVERFIT_GAP = 0.10

# fixed values: scoring
TEXT_GATE = 0.55
METADATA_LIFT = 0.15
FEATURE_HIGH = 0.80
COMPOSITE_WEIGHTS = {"text": 0.45, "ocr": 0.20, "asr": 0.20, "metadata": 0.15}
EXACT_SHARE = 0.70
TEMPORAL_SHARE = 0.30
DECAY_HOURS = 24.0
EXACT_FIELDS = ("user_id", "device_id", "audio_id", "region")

# fixed values: routing
ALLOW = "ALLOW"
REVIEW = "HUMAN REVIEW"
ALLOW_BELOW = 0.30
REVIEW_BELOW = 0.60
VERIFIER_URGENT = 0.70
VERIFIER_ALLOW_BELOW = 0.50
VERDICTS = ("REMOVE", "ALLOW", "ESCALATE")

# fixed values: drift report
RECENT_LIMIT = 1000
PSI_BINS = 10
PSI_SMOOTHING = 1e-6
PSI_ALERT = 0.20
HARMFUL_ALERT = 0.30
OVERRIDE_ALERT = 0.20
MISSING_ALERT = 0.50

# fixed values: text augmentation maps
LEET = {"a": "4", "e": "3", "i": "1", "o": "0", "s": "5", "t": "7", "b": "8", "l": "|"}
SEPARATORS = (".", "*", "-", "_", " ")
MISREAD_PAIRS = (("rn", "m"), ("cl", "d"), ("vv", "w"), ("nn", "m"))
MISREAD_CHARS = {"l": "1", "I": "l", "O": "0", "o": "0", "S": "5", "B": "8", "g": "9", "e": "c"}
HOMOPHONES = {
    "to": "too", "too": "to", "two": "to", "there": "their", "their": "there",
    "your": "you're", "you're": "your", "its": "it's", "for": "four", "no": "know",
    "know": "no", "right": "write", "by": "buy", "hear": "here", "here": "hear",
    "one": "won", "new": "knew", "be": "bee", "see": "sea", "i": "eye",
}
PHONETIC_PAIRS = (("ph", "f"), ("ck", "k"))
WORD_PUNCTUATION = ".,!?;:"
# fixed values: cumulative thresholds of the variant ladders
TITLE_LADDER = ((0.30, "exact"), (0.55, "leetspeak"), (0.75, "symbol_injection"),
                (0.90, "near_duplicate"))
OCR_LADDER = ((0.30, "exact"), (0.65, "ocr_misread"), (0.85, "near_duplicate"))
ASR_LADDER = ((0.30, "exact"), (0.65, "asr_homophone"), (0.85, "near_duplicate"))
LADDER_LAST = "structural"
# fixed values: range of the per-row rate of each style
RATE_RANGES = {"leetspeak": (0.15, 0.45), "symbol_injection": (0.10, 0.30),
               "ocr_misread": (0.15, 0.45), "asr_homophone": (0.30, 0.70)}
REPOSTS_PER_SEED = 40
SAMPLE_TEXT_LENGTH = 280
HARMFUL_VALUES = ("1", "suicide")
CLEAN_VALUES = ("0", "non-suicide", "nonsuicide", "non_suicide")


def numeric_features() -> list[str]:
    """The 35 model inputs in their stable order."""
    def flags(cols):
        return [f"{c}_was_missing" for c in cols]

    return [
        *TEXT_NUMERIC,
        *OCR_NUMERIC, *flags(OCR_NUMERIC), *OCR_BOOL, *[f"loc_{v}" for v in LOCATIONS],
        *ASR_NUMERIC, *flags(ASR_NUMERIC), *ASR_BOOL,
        *META_NUMERIC, *flags(META_NUMERIC), *[f"reg_{v.lower()}" for v in REGIONS],
    ]
